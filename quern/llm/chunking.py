"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of a text.  A chunk ends before a word at which some bits of the hash are
zero, so chunks after an insertion are the same as before it.  Chunks are compared by digest; of equal
chunks the first (by document id, then place) stays.  Only runs of repeated chunks of some length are cut,
so that a common phrase stays everywhere.  Digests have 64 bits and stand for the bytes; a chunk that is taken
for another by chance is cut only if its neighbours in the run are, too, or if it has ``MIN_RUN`` bytes itself.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.spans import cut_out, keyed
from quern.llm.words import SPACES, chunks
from quern.session import ensure_checkpoint_dir

#: A word starts a chunk if these bits of the hash before it are zero.  They depend on the last 22 bytes.
BITS, SHIFT = 2, 20
WINDOW = 32
LEAST, MOST = 16, 1024
#: Bytes of neighbouring repeated chunks from which they are cut.
MIN_RUN = 100

_GEAR = np.random.default_rng(77).integers(0, 1 << 32, 256, dtype=np.uint32)
_GEAR[0] = 0
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True


def gear(data: np.ndarray) -> np.ndarray:
    """h[i] = sum of gear[data[i - j]] << j over the last 32 bytes: every step shifts by one and adds one."""
    h = _GEAR[data]
    step = 1
    while step < WINDOW:
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
        step *= 2
    return h


def boundaries(texts: list[bytes]) -> list[list[int]]:
    """Per text the offsets at which its chunks start, and its length; an empty text has no chunk."""
    gap = bytes(WINDOW)
    data = np.frombuffer(gap + gap.join(texts) + gap, np.uint8)
    space = _IS_SPACE[data]
    word = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    h = gear(data)[word - 1]
    word = word[(h >> np.uint32(SHIFT)) & np.uint32((1 << BITS) - 1) == 0]
    out, at = [], WINDOW
    for text in texts:
        lo, hi = np.searchsorted(word, (at, at + len(text)))
        places = (word[lo:hi] - at).tolist()
        cuts, last = [0] if text else [], 0
        for c in [*places, len(text)]:
            while c - last > MOST:
                last += MOST
                while text[last] & 0xC0 == 0x80:
                    last -= 1
                cuts.append(last)
            if c - last >= LEAST and c < len(text):
                cuts.append(c)
                last = c
        cuts.append(len(text))
        out.append(cuts)
        at += len(text) + WINDOW
    return out


def chunk_digests(rows: DataFrame) -> DataFrame:
    """``digest, doc_id, mark, start`` per chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for group in chunks(t.encode() for t in batch.column(2).to_pylist()):
                digests, starts, counts = [], [], []
                for text, cuts in zip(group, boundaries(group)):
                    digests += [xxhash.xxh3_64_intdigest(text[a:b]) for a, b in zip(cuts, cuts[1:])]
                    starts += cuts[:-1]
                    counts.append(len(cuts) - 1)
                which = pa.array(np.repeat(np.arange(at, at + len(group)), counts))
                at += len(group)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(digests, np.uint64).view(np.int64)), batch.column(0).take(which),
                     batch.column(1).take(which), pa.array(starts, pa.int64())], ["digest", "doc_id", "mark", "start"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"digest bigint, doc_id {kind}, mark bigint, start bigint")


def repeated_runs(data: bytes, starts: list[int], min_run: int = MIN_RUN) -> list[tuple[int, int]]:
    """Runs of neighbouring chunks that start at ``starts`` and have ``min_run`` bytes together."""
    cuts, wanted = boundaries([data])[0], sorted(starts)
    out: list[tuple[int, int]] = []
    for a in wanted:
        b = cuts[bisect.bisect_right(cuts, a)]
        if out and out[-1][1] == a:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return [(a, b) for a, b in out if b - a >= min_run]


def dedup_chunks(docs: DataFrame, min_run: int = MIN_RUN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, row, text, n_bytes, n_removed, n_spans, kept_sha256``: every row without repeated chunks.

    Rows with the same id and text are one document.  A null text counts as empty; a null id comes before all
    others.  A text shorter than ``min_run`` is never cut.  An empty table gives an empty table.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    rows = keyed(docs, id_col, text_col)
    found = chunk_digests(rows)
    # chunks are worked out twice, which is cheaper than storing them all; the narrow sides of the joins are
    # stored, so that a digest with very many chunks is split in the join
    often = found.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest").checkpoint()
    again = found.join(often, "digest").checkpoint()
    firsts = again.groupBy("digest").agg(F.min(F.struct("doc_id", "mark", "start")).alias("first")).checkpoint()
    later = again.join(firsts, "digest").where(~(
        F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("mark") == F.col("first.mark")) & (F.col("start") == F.col("first.start"))))
    spots = later.groupBy("doc_id", "mark").agg(F.collect_set("start").alias("spots"))
    return cut_out(rows, spots, lambda data, starts: repeated_runs(data, starts, min_run), "array<bigint>")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars",
                    min_run: int = MIN_RUN) -> DataFrame:
    """``docs`` with the repeated chunks cut out of their texts, and ``chars_col``, if there, counted anew."""
    done = dedup_chunks(docs, min_run, id_col, text_col)
    new = {id_col: F.col("doc_id"), text_col: F.col("text")}
    if chars_col in docs.columns:
        new[chars_col] = F.length("text").cast(docs.schema[chars_col].dataType)
    return done.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
