"""Hashes of words, of runs of words and of byte strings, for many texts at once in numpy.

Texts are joined to one byte array.  A hash of any stretch of it is a difference of two prefix sums, so
all words, or all windows of a text, cost one pass.  Arithmetic is modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np

#: Words are runs of bytes other than these.
SPACES = b" \t\n\x0b\x0c\r"
SHINGLE = 5
#: Bytes of text that are worked on at once; a longer text is worked on alone.
CHUNK = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_LETTERS = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ...: ``n`` of them at least."""
    held = _POWERS.get(base)
    if held is None or len(held) < n:
        grown = np.full(max(n, CHUNK + (CHUNK >> 2)), base, np.uint64)
        grown[0] = 1
        _POWERS[base] = held = np.cumprod(grown)
    return held


def mix(h: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``h``."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """P such that the hash of ``data[a:b]`` is ``(P[b] - P[a]) * base**-a``; see ``spans``."""
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum(_LETTERS[data] * _powers(_BASE, len(data))[:len(data)], out=out[1:])
    return out


def spans(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the byte strings from ``starts`` to ``ends``; equal strings have equal hashes."""
    return mix((sums[ends] - sums[starts]) * _powers(_INVERSE, len(sums))[starts])


def chunks(texts: Iterable[bytes], size: int = CHUNK) -> Iterator[list[bytes]]:
    """The texts in lists of about ``size`` bytes."""
    held: list[bytes] = []
    total = 0
    for text in texts:
        if held and total + len(text) > size:
            yield held
            held, total = [], 0
        held.append(text)
        total += len(text)
    if held:
        yield held


class Words:
    """The words of some texts: ``starts`` and ``ends`` in ``data``, and per text the first and last word."""

    def __init__(self, texts: Sequence[bytes]):
        self.data = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.at = np.cumsum(lengths + 1) - lengths  # where each text begins
        self.to = self.at + lengths
        edge = np.flatnonzero(np.diff(_IS_SPACE[self.data].view(np.int8)))
        self.starts, self.ends = edge[0::2] + 1, edge[1::2] + 1
        self.first = np.searchsorted(self.starts, self.at)
        self.last = np.searchsorted(self.starts, self.to)

    def hashes(self) -> np.ndarray:
        return spans(prefix_sums(self.data), self.starts, self.ends)

    def shingles(self, width: int = SHINGLE) -> list[np.ndarray]:
        """Per text the sorted distinct hashes of its runs of ``width`` words.

        A text of fewer words has one shingle of all of them; one without words has none.
        """
        words = self.hashes()
        n = len(words)
        run = np.zeros(n, np.uint64)
        for k in range(width):
            part = words[k:] * np.uint64(pow(_BASE, 2 * k + 3, 1 << 64))
            run[:len(part)] += part ^ (part >> np.uint64(29))
        run = mix(run)
        out = []
        for a, b in zip(self.first.tolist(), self.last.tolist()):
            if b - a >= width:
                out.append(np.unique(run[a:b - width + 1]))
            elif b > a:
                few = sum(int(h) * pow(_BASE, 2 * k + 4, 1 << 64) for k, h in enumerate(words[a:b]))
                out.append(mix(np.array([(few + b - a) % (1 << 64)], np.uint64)))
            else:
                out.append(run[:0])
        return out


def shingle_sets(texts: Iterable[str | None], width: int = SHINGLE) -> Iterator[np.ndarray]:
    """``Words.shingles`` of any number of texts, in order; null counts as empty."""
    for group in chunks((t or "").encode() if not isinstance(t, bytes) else t for t in texts):
        yield from Words(group).shingles(width)
