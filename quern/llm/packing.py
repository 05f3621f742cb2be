"""Harmonic packing of token sequences.

A length in ``(C/(j+1), C/j]`` belongs to class ``j``, whose bins take exactly ``j`` pieces.  Every worker
fills bins of its own, so nothing is shuffled and a bin never spans workers.  Documents may be cut, so a
length that would leave its bin too empty is first cut at the largest power of two in it, a length that
fills its class without a gap; the pieces that are left over when a worker ends are cut the same way and
closed in sequences whose length is a power of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from quern.llm.bpe import KEPT, PairEncoder, encoder

CAPACITY = 2048
END_ID = 1
#: Tokens that a full bin may lack.
SLACK = 16


#: Bytes of text that are encoded together, apart from the last text of them.
TOGETHER = 1 << 21


def parts_of(batch: pa.RecordBatch, size: int = TOGETHER) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with some ``size`` bytes of the second column each."""
    length = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64)
    cuts = np.flatnonzero(np.diff((length.cumsum() - length) // size, prepend=-1)).tolist() + [batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


class Bins:
    """The open bins of one worker; closed ones come out as lists of pieces ``(document, start, length)``.

    ``keep(document, start, length)`` is what a piece that waits remembers of its document, by default all of it.
    """

    def __init__(self, capacity: int = CAPACITY, slack: int = SLACK, keep: Callable = lambda doc, start, length: doc):
        self.capacity, self.slack, self.keep = capacity, slack, keep
        self.open: dict[int, list[tuple]] = {}

    def add(self, piece: tuple) -> Iterator[list[tuple]]:
        doc, start, length = piece
        while length > 0:
            size = min(length, self.capacity)
            held = self.capacity // size
            if self.capacity - held * size > self.slack:
                size = 1 << size.bit_length() - 1
                held = self.capacity // size
            waiting = self.open.setdefault(held, [])
            waiting.append((self.keep(doc, start, size), start, size))
            if len(waiting) == held:
                yield self.open.pop(held)
            start, length = start + size, length - size

    def close(self) -> Iterator[list[tuple]]:
        """Everything that still waits, in sequences that are full or as long as a power of two."""
        waiting = [p for held in sorted(self.open) for p in self.open[held]]
        self.open = {}
        by_size: dict[int, list[tuple]] = {}
        for doc, start, length in waiting:
            while length > 0:
                size = 1 << length.bit_length() - 1
                by_size.setdefault(size, []).append((doc, start, size))
                start, length = start + size, length - size
        for size, pieces in sorted(by_size.items()):
            while pieces:
                take = min(1 << len(pieces).bit_length() - 1, self.capacity // size)
                yield pieces[:take]
                del pieces[:take]


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, slack: int = SLACK, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, kept: int = KEPT,
         remember: bool = True) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``with_ids`` adds the piece's ids.  ``kept`` is how many pieces of text a worker remembers: fewer take less memory
    and more time.  Without ``remember`` the worker gives them back at the end of a task.  ``capacity`` is a power of two.  Every document ends with ``end_id``,
    so a null or empty text is one piece of one token.  Every row of ``docs`` is packed, repeated ones and
    those with a null id too; other columns are not looked at.  An empty table gives an empty table.
    """
    if capacity & capacity - 1:
        raise ValueError("the capacity must be a power of two")
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        # a document is its id, ids from some token on, that token, and how many it has in all
        own = lambda doc, start, length: (doc[0], doc[1][4 * start:4 * (start + length)], start, doc[3])
        coder, bins = encoder(path, PairEncoder, kept) if remember else PairEncoder(path, kept), Bins(capacity, slack, own)
        at = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []

        def put(sequence: list[tuple]) -> None:
            nonlocal at
            offset = 0
            for (doc, ids, first, tokens), start, length in sequence:
                part = ids[4 * (start - first):4 * (start - first + length)]
                row = (doc, start, length, zlib.crc32(part), tokens, at, offset)
                rows.append(row + (memoryview(part).cast("I").tolist(),) if with_ids else row)
                offset += length
            at += 1

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        schema = None
        for batch in batches:
            if schema is None:
                fields = [("doc_id", batch.schema.field(0).type)] + [(n, pa.int64()) for n in NAMES[1:]]
                schema = pa.schema(fields + [("ids", pa.list_(pa.int32()))] * with_ids)
            for part in parts_of(batch):
                for doc, ids in zip(part.column(0).to_pylist(), coder.ids_of_texts(part.column(1).to_pylist())):
                    ids += end
                    for sequence in bins.add(((doc, ids, 0, len(ids) // 4), 0, len(ids) // 4)):
                        put(sequence)
                    if len(rows) >= 10_000:
                        yield batch_of(rows)
                        rows.clear()
        for sequence in bins.close():
            put(sequence)
        if rows:
            yield batch_of(rows)

    kind = docs.schema[id_col].dataType.simpleString()
    out = f"doc_id {kind}, " + ", ".join(f"{n} bigint" for n in NAMES[1:]) + (", ids array<int>" if with_ids else "")
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, out)


NAMES = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
