"""Byte spans of documents: identity of rows, and cutting spans out of texts."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, mark, text, row``: ``mark`` (64 bits of the text's hash) tells rows with one id apart.

    A null text is empty.  ``row`` has the other columns.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rest = [docs[c] for c in docs.columns if c not in (id_col, text_col)] or [F.lit(None).cast("int").alias("none")]
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"), F.struct(*rest).alias("row"))


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans joined."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def cut(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for a, b in spans:
        kept.append(data[at:a])
        at = b
    kept.append(data[at:])
    return b"".join(kept)


def cut_out(rows: DataFrame, spots: DataFrame, spans_of: Callable[[bytes, list], list[tuple[int, int]]],
            spot_type: str) -> DataFrame:
    """``doc_id, row, text, n_bytes, n_removed, n_spans, kept_sha256`` for ``rows`` without their spans.

    ``rows`` are those of ``keyed``; ``spots`` has ``doc_id, mark, spots``, at most one row per document; ``spans_of(data, spots)`` gives
    the spans of one text, apart and in order.  ``text`` is null where the rest is not UTF-8.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, size, gone, count, sums = [], [], [], [], []
            for t, s in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                data = t.encode()
                spans = spans_of(data, s) if s else []
                kept = cut(data, spans) if spans else data
                try:
                    text.append(kept.decode() if spans else t)
                except UnicodeDecodeError:
                    text.append(None)
                size.append(len(data))
                gone.append(len(data) - len(kept))
                count.append(len(spans))
                sums.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(text, pa.string()), *(pa.array(v, pa.int64()) for v in (size, gone, count)),
                 pa.array(sums, pa.string())], ["doc_id", "row", "text", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rest = rows.schema["row"].dataType
    other = spots.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "spots")
    both = rows.join(other, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")), "left")
    schema = StructType().add("doc_id", rows.schema["doc_id"].dataType).add("row", rest)
    for name, kind in (("text", "string"), ("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"),
                       ("kept_sha256", "string")):
        schema = schema.add(name, kind)
    return both.select("doc_id", "row", "text", F.col("spots").cast(spot_type)).mapInArrow(run, schema)
