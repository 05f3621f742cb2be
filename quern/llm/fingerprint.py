"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch is the ``k`` smallest distinct hashes of a document's shingles, in order.  The sketch of a union
is the ``k`` smallest of both sketches, so parts of a text, of a shard or of a source are sketched apart
and merged in any order.  Two sketches estimate resemblance, containment and distinct shingle counts.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.words import SHINGLE, shingle_sets

K = 256
SPACE = float(2 ** 64)


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    return np.union1d(a, b)[:k]


def distinct_count(sketch: np.ndarray, k: int = K) -> float:
    """Estimated distinct shingles: exact below ``k``, else from the k-th smallest hash."""
    if len(sketch) < k:
        return float(len(sketch))
    return (k - 1) / ((float(sketch[k - 1]) + 1.0) / SPACE)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard likeness: of the ``k`` smallest hashes of the union, the share in both.

    Exact if both sketches hold whole sets.  Two empty sets are alike, an empty and another are not.
    """
    union = merge(a, b, k)
    if not len(union):
        return 1.0
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.count_nonzero(both <= union[-1])) / len(union)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has; 1 for an empty ``a``."""
    if not len(a):
        return 1.0
    near = resemblance(a, b, k)
    both = near * distinct_count(merge(a, b, k), k)
    return min(1.0, both / distinct_count(a, k))


def to_text(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype("<u8").tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), "<u8").astype(np.uint64)


def sketches(texts: Sequence[str | None], k: int = K, width: int = SHINGLE) -> list[np.ndarray]:
    return [s[:k] for s in shingle_sets(texts, width)]


def fingerprint(docs: DataFrame, k: int = K, width: int = SHINGLE, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, n_shingles`` (estimated distinct shingles) per row; nothing is shuffled."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = sketches([t.as_py() for t in batch.column(1)], k, width)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([to_text(s) for s in found], pa.string()),
                 pa.array([distinct_count(s, k) for s in found], pa.float64())],
                ["doc_id", "fingerprint", "n_shingles"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(
        run, f"doc_id {kind}, fingerprint string, n_shingles double")


def merge_by(prints: DataFrame, group: str, k: int = K, print_col: str = "fingerprint") -> DataFrame:
    """One sketch for each value of ``group``, from the sketches of its parts: ``group, hashes``.

    Hashes of all parts are made distinct and cut to the ``k`` smallest before they are shuffled, so a hot
    group sends ``k`` hashes per task.  Hashes are unsigned and shown as 16 hex digits, which sort alike.
    """
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, hashes = [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = from_text(text or "")
                keys += [key] * len(own)
                hashes += [f"{h:016x}" for h in own.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(keys, batch.schema.field(0).type), pa.array(hashes, pa.string())],
                                             ["key", "hash"])

    kind = prints.schema[group].dataType.simpleString()
    flat = prints.select(prints[group].alias("key"), prints[print_col].alias("p")).mapInArrow(
        run, f"key {kind}, hash string").distinct()
    least = flat.withColumn("_rn", F.row_number().over(Window.partitionBy("key").orderBy("hash"))).where(f"_rn <= {k}")
    return least.groupBy("key").agg(F.array_sort(F.collect_list("hash")).alias("hashes")).withColumnRenamed("key", group)


def edit(text: str, following: str) -> str:
    """``text`` with its last half replaced by as many first characters of ``following``, or all of them."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def id_ranges(docs: DataFrame, id_col: str, parts: int | None = None) -> list:
    """The least id of each of about ``parts`` ranges with about equally many rows; null comes first.

    One number per range comes to the driver.
    """
    ids = docs.select(docs[id_col].alias("doc_id"))
    least = (ids.repartitionByRange(parts or max(2, docs.rdd.getNumPartitions()), "doc_id")
             .groupBy(F.spark_partition_id().alias("part")).agg(F.min("doc_id").alias("low")).select("low").collect())
    return sorted({r["low"] for r in least if r["low"] is not None})


def near_edited(docs: DataFrame, k: int = K, width: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text",
                parts: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they and the next text's are.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_shingles,
    kept_share`` (containment of the document in its edited text).  The next document is that of the next
    id, after the last the first.  A null text counts as empty, and empty texts are alike.  A null id comes
    before all others.  Rows that share an id follow each other in the order of their texts.

    Ids are cut into ranges, and each range is walked in order by one task.  The rows with the first id of a
    range are also sent to the range before, so texts move once.
    """
    import pyarrow as pa

    lows = id_ranges(docs, id_col, parts)
    n = max(len(lows), 1)
    edges = np.array(lows if lows else [0])

    @F.pandas_udf("struct<part int, head boolean>")
    def place(ids: pd.Series) -> pd.DataFrame:
        missing = ids.isna().to_numpy()
        values = ids.fillna(edges[0]).to_numpy().astype(edges.dtype)
        part = np.maximum(np.searchsorted(edges, values, "right") - 1, 0)
        return pd.DataFrame({"part": part.astype("int32"), "head": (edges[part] == values) | missing})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None  # part, id, text, sketch of the row that waits for its next
        for batch in batches:
            part_of, copy_of, ids, texts = (batch.column(i).to_pylist() for i in range(4))
            texts = [t or "" for t in texts]
            own = sketches(texts, k, width)
            pairs = []
            for row in zip(part_of, ids, texts, own, copy_of):
                if last is not None and last[0] == row[0]:
                    pairs.append((last, row))
                last = None if row[4] else row
            if not pairs:
                continue
            edited = [edit(a[2], b[2]).encode() for a, b in pairs]
            new = sketches(edited, k, width)
            yield pa.RecordBatch.from_arrays([
                pa.array([a[1] for a, _ in pairs], batch.schema.field(2).type),
                pa.array([len(a[2]) for a, _ in pairs], pa.int64()),
                pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()),
                pa.array([to_text(a[3]) for a, _ in pairs], pa.string()),
                pa.array([to_text(s) for s in new], pa.string()),
                pa.array([resemblance(a[3], s, k) for (a, _), s in zip(pairs, new)], pa.float64()),
                pa.array([resemblance(a[3], b[3], k) for a, b in pairs], pa.float64()),
                pa.array([distinct_count(a[3], k) for a, _ in pairs], pa.float64()),
                pa.array([containment(a[3], s, k) for (a, _), s in zip(pairs, new)], pa.float64())], NAMES)

    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    spot = rows.withColumn("_at", place("doc_id"))
    at = F.col("_at.part")
    places = F.when(F.col("_at.head"), F.array(
        F.struct(at.alias("part"), F.lit(False).alias("copy")),
        F.struct(F.pmod(at - 1, F.lit(n)).cast("int").alias("part"), F.lit(True).alias("copy")),
    )).otherwise(F.array(F.struct(at.alias("part"), F.lit(False).alias("copy"))))
    dealt = (spot.select(F.inline(places), "doc_id", "text").repartition(n, "part")
             .sortWithinPartitions("part", "copy", "doc_id", "text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return dealt.mapInArrow(run, f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, "
                                 "edited_fingerprint string, near_edited double, near_next double, n_shingles double, "
                                 "kept_share double")


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
         "n_shingles", "kept_share"]
