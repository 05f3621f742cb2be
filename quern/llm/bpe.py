"""Exact byte-pair encoding by dynamic programming over prefixes, and decoding.

For every prefix of a word there is exactly one last token.  An Aho-Corasick automaton over the vocabulary, whose
suffix links report every token that ends at a place, gives the candidates; a candidate is the last token if the
token before it, which the shorter prefix has stored, may stand next to it.  Following the stored tokens
back from the end of the word gives the ids.  No merge queue is run.

Whole texts are cut at white space, where no token can cross; pieces that come again are looked up.  ``PairEncoder``
takes many texts at once and merges the pairs of all their new words together, in arrays.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator, Sequence
from functools import cached_property
from itertools import islice

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame

#: Pieces, words and pair tests that a worker remembers, and the letters of the longest of them; both bound memory (some
#: 160 MB), never the result.
KEPT = 800_000
KEPT_LETTERS = 64
END = "\n"  # stands for the word end in the automaton; the byte alphabet has no control characters
SEPARATORS = re.compile(r"[\x1c-\x1f]")  # white space for str.split, but not for the tokenizer


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself, or one from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def cut_at_space(text: str) -> list[str]:
    return text.split() if not SEPARATORS.search(text) else [p for p in regex.split(r"\s+", text) if p]


class PrefixEncoder:
    """Encodes and decodes as the tokenizer in ``path`` does (special tokens only where the text has them).

    Without ``with_text`` it remembers ids only, which takes half the memory; ``digests`` needs the text.
    """

    def __init__(self, path: str, with_text: bool = True, kept: int = KEPT):
        self.with_text, self.kept = with_text, kept
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.strings = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        self.letters = byte_alphabet()
        #: Left token, right token and what they merge to, first merge first.
        self.pairs = np.array([(self.ids[a], self.ids[b], self.ids[a + b]) for a, b in model["merges"]], np.int64).reshape(-1, 3)
        self.edges: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        self.fits: dict[int, bool] = {}
        self.long: list[str] = []
        self.piece_ids: dict[str, bytes] = {}
        self.piece_text: dict[str, bytes] = {}
        self.known: dict[str, tuple[bytes, bytes]] = {}

    @cached_property
    def rank(self) -> dict[tuple[int, int], int]:
        return {(a, b): at for at, (a, b, _) in enumerate(self.pairs.tolist())}

    @cached_property
    def made(self) -> dict[int, tuple[int, int, int]]:
        """Token: the pair it is made of, and when."""
        return {whole: (a, b, at) for at, (a, b, whole) in reversed([*enumerate(self.pairs.tolist())])}

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        out = ahocorasick.Automaton()
        for token, i in self.ids.items():
            ends = bool(self.suffix) and token.endswith(self.suffix) and len(token) > len(self.suffix)
            body = token.removesuffix(self.suffix) if ends else token
            out.add_word(body + END if ends else body, (i, len(body), ends))
        out.make_automaton()
        return out

    def edge(self, token: int, side: int) -> list[tuple[int, int, int]]:
        """What stands at the right (1) or left (0) edge of ``token`` while it is built: piece, from when, until."""
        key = (token, side)
        if key not in self.edges:
            out, until = [], sys.maxsize
            while token in self.made:
                pair = self.made[token]
                out.append((token, pair[2], until))
                token, until = pair[side], pair[2]
            out.append((token, -1, until))
            self.edges[key] = out
        return self.edges[key]

    def compatible(self, a: int, b: int) -> bool:
        """Whether ``a`` then ``b`` is what their joined string encodes to: no merge ever crosses the border.

        A pair of edge pieces merges at its rank if both exist then.  At equal ranks the left merge goes first.
        """
        key = a << 20 | b
        known = self.fits.get(key)
        if known is None:
            rank, known = self.rank, True
            for x, since, until in self.edge(a, 1):
                for y, start, stop in self.edge(b, 0):
                    at = rank.get((x, y))
                    if at is not None and since < at < until and start < at <= stop:
                        known = False
            if len(self.fits) > self.kept:
                self.fits.clear()
            self.fits[key] = known
        return known

    def word_ids(self, word: str) -> list[int]:
        """Ids of one pre-token, given in the byte alphabet."""
        n = len(word)
        last, size = [-1] * (n + 1), [0] * (n + 1)  # the last token of each prefix
        if n > 1 << 16:
            last, size = array("i", last), array("i", size)
        fits, compatible = self.fits, self.compatible
        for end, (token, length, ends) in self.automaton.iter(word + END if self.suffix else word):
            i = end if ends else end + 1
            if last[i] >= 0 or (i == n and not ends and self.suffix):
                continue
            start = i - length
            if start:
                before = last[start]
                if before < 0:
                    continue
                ok = fits.get(before << 20 | token)
                if not (compatible(before, token) if ok is None else ok):
                    continue
            last[i], size[i] = token, length
        out, i = [], n
        while i > 0:
            if last[i] < 0:
                raise ValueError(f"the vocabulary lacks a character of {word!r}")
            out.append(last[i])
            i -= size[i]
        out.reverse()
        return out

    def spelled(self, word: str) -> str:
        return word if word.isascii() and word.isprintable() else "".join([self.letters[b] for b in word.encode()])

    def word(self, word: str) -> tuple[bytes, bytes]:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= self.kept:
                self.known.clear()
            ids = self.word_ids(self.spelled(word))
            found = (array("I", ids).tobytes(), " ".join([self.strings[i] for i in ids]).encode() if self.with_text else b"")
            if len(word) <= KEPT_LETTERS:
                self.known[word] = found
        return found

    def words_of(self, piece: str) -> list[str]:
        """The words of a piece: in lower case, character by character, after composition."""
        if piece.isascii():
            piece = piece.lower()
        else:
            if not unicodedata.is_normalized("NFC", piece):
                piece = unicodedata.normalize("NFC", piece)
            piece = piece.lower() if "\u03a3" not in piece else "".join([c.lower() for c in piece])
        if piece.isalpha():
            return [piece]
        if piece[:-1].isalpha() and piece[-1] in ".,;:!?":
            return [piece[:-1], piece[-1]]
        return self.words.findall(piece)

    def plain(self, piece: str) -> list[tuple[bytes, bytes]]:
        return [self.word(w) for w in self.words_of(piece)]

    def add_piece(self, piece: str) -> None:
        """Look up or work out the ids and the decoded text of a piece without white space."""
        if "<|" in piece:
            parts = []
            for part in self.special_cut.split(piece):
                if part in self.special:
                    parts.append((array("I", [self.special[part]]).tobytes(), part.encode()))
                elif part:
                    parts += self.plain(part)
        else:
            parts = self.plain(piece)
        self.piece_ids[piece] = parts[0][0] if len(parts) == 1 else b"".join([p[0] for p in parts])
        if self.with_text:
            self.piece_text[piece] = parts[0][1] if len(parts) == 1 else b" ".join([p[1] for p in parts])

    def pieces(self, text: str) -> list[str]:
        """The text cut at white space; afterwards every piece is known."""
        for p in self.long:
            del self.piece_ids[p]
            self.piece_text.pop(p, None)
        cut = cut_at_space(text)
        missing = set(cut).difference(self.piece_ids)
        if len(self.piece_ids) + len(missing) > self.kept:
            self.piece_ids.clear()
            self.piece_text.clear()
            missing = set(cut)
        for p in missing:
            self.add_piece(p)
        # long pieces are forgotten with the next text
        self.long = [p for p in missing if len(p) > KEPT_LETTERS]
        return cut

    def ids_bytes(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        return b"".join(map(self.piece_ids.__getitem__, self.pieces(text or "")))

    def digests(self, text: str | None) -> tuple[int, str, str]:
        """How many ids, sha256 of the ids, sha256 of the decoded text."""
        cut = self.pieces(text or "")
        ids = b"".join(map(self.piece_ids.__getitem__, cut))
        back = b" ".join(map(self.piece_text.__getitem__, cut))
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest()

    def encode(self, text: str | None) -> list[int]:
        return array("I", self.ids_bytes(text)).tolist()

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.strings[i] for i in ids])


class PairEncoder(PrefixEncoder):
    """Ids of many texts at once: all words that are not remembered are merged together, a pair of each at a time.

    It has no text of its ids.  Words of more than ``KEPT_LETTERS`` bytes are encoded by prefixes, in linear time.
    """

    #: Rank of two tokens that do not merge.
    NEVER = (1 << 31) - 1

    def __init__(self, path: str, kept: int = KEPT):
        super().__init__(path, with_text=False, kept=kept)
        keys = self.pairs[:, 0] << 32 | self.pairs[:, 1]
        self.order = np.argsort(keys, kind="stable")
        last = np.append(np.diff(keys[self.order]) > 0, True)  # a pair that is listed twice counts where it is last
        self.order = self.order[last].astype(np.int32)
        self.keys = keys[self.order]
        byte = [self.ids.get(c, -1) for c in self.letters]
        self.inner, self.final = np.array(byte), np.array([self.ids.get(c + self.suffix, -1) for c in self.letters])

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(left), self.NEVER, np.int32)
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.order[at], np.int32(self.NEVER))

    def merged(self, words: Sequence[bytes]) -> list[bytes]:
        """Ids of every word, which has at least one byte."""
        if not words:
            return []
        data, size = np.frombuffer(b"".join(words), np.uint8), np.fromiter(map(len, words), np.int64, len(words))
        end = size.cumsum()
        token = self.inner[data]
        token[end - 1] = self.final[data[end - 1]]
        if len(token) and token.min() < 0:
            raise ValueError(f"the vocabulary lacks a character of {words[np.searchsorted(end, token.argmin(), 'right')]!r}")
        word = np.repeat(np.arange(len(words)), size)
        rank = np.append(self.ranks(token[:-1], token[1:]), np.int32(self.NEVER))
        rank[end - 1] = self.NEVER
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(token):
            # the pair of lowest rank of every word, the leftmost of equal ones
            best = np.minimum.reduceat(rank.astype(np.int64) << 32 | np.arange(len(token)), size.cumsum() - size)
            live = best >> 32 < self.NEVER
            keep = np.repeat(live, size)
            if not live.all():
                done.append((word[~keep], token[~keep]))
            at = best[live] & (1 << 32) - 1
            token[at] = self.pairs[rank[at], 2]
            keep[at + 1] = False
            at = at - (~keep).cumsum()[at]
            token, word, rank, size = token[keep], word[keep], rank[keep], size[live] - 1
            inside = at + 1 < len(token)
            inside[inside] = word[at[inside] + 1] == word[at[inside]]
            rank[at] = self.NEVER
            rank[at[inside]] = self.ranks(token[at[inside]], token[at[inside] + 1])
            at = at[at > 0]
            at = at[word[at - 1] == word[at]]
            rank[at - 1] = self.ranks(token[at - 1], token[at])
        word, token = (np.concatenate(x) for x in zip(*done))
        ids = token[np.argsort(word, kind="stable")].astype("<u4").tobytes()
        ends = (np.bincount(word, minlength=len(words)).cumsum() * 4).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def add_pieces(self, pieces: Sequence[str]) -> None:
        """Work out the ids of pieces without white space."""
        number: dict[str, int] = {}  # of every new word
        names: list[str] = []  # pieces and how many words they have
        counts: list[int] = []
        flat: list[int] = []
        for piece in pieces:
            if "<|" in piece:
                self.add_marked(piece)
                continue
            words = self.words_of(piece)
            names.append(piece)
            counts.append(len(words))
            for w in words:
                flat.append(number.setdefault(w, len(number)))
        spelled = [w.encode() for w in number]
        ids = self.merged([w if len(w) <= KEPT_LETTERS else b"!" for w in spelled])
        for i, (word, letters) in enumerate(zip(number, spelled)):
            if len(letters) > KEPT_LETTERS:
                ids[i] = array("I", self.word_ids(self.spelled(word))).tobytes()
        parts = map(ids.__getitem__, flat)
        self.piece_ids.update(zip(names, [next(parts) if n == 1 else b"".join(islice(parts, n)) for n in counts]))

    def add_marked(self, piece: str) -> None:
        """The same for a piece that may hold special tokens."""
        ids = []
        for part in self.special_cut.split(piece):
            if part in self.special:
                ids.append(self.special[part])
            elif part:
                for word in self.words_of(part):
                    ids += self.word_ids(self.spelled(word))
        self.piece_ids[piece] = array("I", ids).tobytes()

    def ids_of_texts(self, texts: Sequence[str | None]) -> Iterator[bytes]:
        """Ids of every text as little-endian unsigned 32-bit numbers."""
        cuts = [cut_at_space(t or "") for t in texts]
        every = set().union(*cuts)
        missing = every.difference(self.piece_ids)
        if len(self.piece_ids) + len(missing) > self.kept:
            self.piece_ids.clear()
            missing = every
        self.add_pieces(list(missing))
        known = self.piece_ids.__getitem__
        for cut in cuts:
            yield b"".join(map(known, cut))
        # long pieces are forgotten at once, and the rest of texts that have too many pieces
        if len(self.piece_ids) > self.kept:
            self.piece_ids.clear()
        for piece in missing:
            if len(piece) > KEPT_LETTERS:
                self.piece_ids.pop(piece, None)


_ENCODERS: dict[tuple, PrefixEncoder] = {}


def encoder(path: str, kind: type = PrefixEncoder, kept: int = KEPT) -> PrefixEncoder:
    """One encoder per worker process, file, kind and memory."""
    key = (path, kind.__name__, kept)
    if key not in _ENCODERS:
        _ENCODERS[key] = kind(path, kept=kept)
    return _ENCODERS[key]


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                  with_ids: bool = True) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, ``with_ids``, ``ids`` and ``decoded``, per row.

    A null text counts as empty: no ids, and the digests of nothing.  Null ids, repeated rows and very long
    texts are rows like any other; other columns are not looked at.  Nothing is shuffled.
    """
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            texts = batch.column(1)
            rows = [coder.digests(t.as_py()) for t in texts]
            columns = [batch.column(0), pa.array([r[0] for r in rows], pa.int64()),
                       pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                ids = [coder.encode(t.as_py()) for t in texts]
                columns += [pa.array(ids, pa.list_(pa.int32())), pa.array([coder.decode(i) for i in ids], pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(
        run, schema + (", ids array<int>, decoded string" if with_ids else ""))
