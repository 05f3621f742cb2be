"""Join helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Types whose equal values have equal hashes.
HASHED = ("string", "tinyint", "smallint", "int", "bigint", "date", "timestamp", "boolean")


def hash_first(left: DataFrame, right: DataFrame, keys: Sequence[str], right_keys: Sequence[str]) -> Column:
    """The hashes of ``keys`` are equal, which rows that match on all of them fulfil.

    Put before the keys themselves it makes a merge join sort by a number that decides nearly every comparison, where a
    first key of few values decides few.
    """
    kinds = [[f.dataType for f in df.select(*names).schema] for df, names in ((left, keys), (right, right_keys))]
    some = [(a, b) for a, b, x, y in zip(keys, right_keys, *kinds) if x == y and x.simpleString() in HASHED]
    if len(some) < 2:
        return F.lit(True)
    return F.xxhash64(*[F.col(a) for a, _ in some]) == F.xxhash64(*[F.col(b) for _, b in some])


def match_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` with null equal to null; the left keys are kept."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = hash_first(left, renamed, keys, [f"_r_{k}" for k in keys])
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(renamed, same, how).drop(*[f"_r_{k}" for k in keys])


def stored(df: DataFrame, beside: Sequence[str] = ()) -> tuple[DataFrame, int]:
    """``df`` kept for repeated passes, and its rows.

    It is evened out if it has fewer partitions than there are cores.  Large inputs have far more
    partitions than that and are left where they are.  The columns ``beside`` are dropped when it is evened
    out, because where a row goes then depends on all its columns.  The caller unpersists it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    kept = df.persist()
    rows = kept.count()
    if kept.rdd.getNumPartitions() >= cores:
        return kept, rows
    even = kept.drop(*beside).repartition(cores).persist()
    even.count()
    kept.unpersist()
    return even, rows
