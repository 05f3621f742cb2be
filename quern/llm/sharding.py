"""Sharding by proportional stratified interleaving, in DataFrame operations only.

Rows are put in a seeded random order within their source, ranked, and sorted by fractional rank
``(rank - 1/2) / rows of the source``.  Cutting that sequence into equal pieces gives shards whose row
counts differ by one at most and whose mixture of sources is that of the whole table.

No source and no stretch of the sequence is ever in one task: ranks and positions are row numbers inside
small buckets (of the random key, then of the fractional rank) plus the counts of the buckets before.  Rows
with one id have one key; they are told apart by cells of their checksums, and equal rows are one row with a count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.joins import match_keys
from quern.session import ensure_checkpoint_dir

SHARDS = 40
SEED = 17
#: Buckets of the random key within a source, and of the fractional rank.  A power of two.
BUCKETS = 4096
#: Bits of the checksum that do not tell the cells of an id apart.
CELL_SHIFT = 20
OVERHEAD = 16


def seeded_key(seed: int, *values: Column) -> Column:
    """60 random bits that depend on the seed and the values only."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(v.cast("string"), F.lit("null")) for v in values]))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def interleave(rows: DataFrame, source: str, key: str, cell: list[str], ties: list[str], out: str = "position",
               buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame]:
    """``rows`` with their place (from 0) in the interleaved sequence, and a frame of the total.

    ``source`` holds no nulls; ``key`` has 60 random bits.  Rows are ordered by ``key``, ``cell`` and
    ``ties``; those with equal ``cell`` and ``key`` are ordered in one task, equal rows only as their count.
    """
    bits = buckets.bit_length() - 1
    names = rows.columns
    rows = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_copies"))
    rows = rows.withColumn("_b", F.shiftrightunsigned(key, 60 - bits).cast("int")).checkpoint()
    cells = rows.groupBy(source, "_b", key, *cell).agg(F.sum("_copies").alias("_n"))
    counts = cells.groupBy(source, "_b").agg(F.sum("_n").alias("_n"))
    own = Window.partitionBy(source)
    starts = counts.select(
        source, "_b", F.sum("_n").over(own).alias("_of"),
        (F.sum("_n").over(own.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_start"))
    earlier = Window.partitionBy(source, "_b").orderBy(key, *cell).rowsBetween(Window.unboundedPreceding, 0)
    cells = (cells.withColumn("_first", F.sum("_n").over(earlier) - F.col("_n")).join(starts, [source, "_b"])
             .select(source, key, *cell, "_of", (F.col("_start") + F.col("_first")).alias("_start")))
    inside = Window.partitionBy(source, key, *cell).orderBy(*ties).rowsBetween(Window.unboundedPreceding, 0)
    numbered = match_keys(rows.withColumn("_last", F.sum("_copies").over(inside)), cells, [source, key, *cell])
    share = (F.col("_start") + F.col("_rn") - 0.5) / F.col("_of")
    ranked = (numbered.select(*names, "_of", "_start", F.explode(F.sequence(F.col("_last") - F.col("_copies") + 1, "_last")).alias("_rn"))
              .withColumn("_share", share)
              .withColumn("_slice", F.floor(F.col("_share") * buckets).cast("int"))
              .drop("_of", "_start", "_rn")).checkpoint()
    slices = ranked.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)  # at most one row per bucket
    begins = slices.select("_slice", (F.sum("_n").over(before) - F.col("_n")).alias("_begin"))
    within = Window.partitionBy("_slice").orderBy("_share", key, source, *cell, *ties)
    placed = (ranked.withColumn("_at", F.row_number().over(within)).join(begins, "_slice")
              .withColumn(out, F.col("_begin") + F.col("_at") - 1).drop("_share", "_slice", "_at", "_begin"))
    return placed, slices.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total"))


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, size, text_crc32, source, shard, slot``: every row of ``docs`` in one of ``shards`` shards.

    ``size`` is the UTF-8 length of the text plus 16.  A null text counts as empty, a null source is a
    source of its own, a null id is an id like any other.  Repeated rows are kept and placed next to each
    other.  An empty table gives an empty table.  Other columns of ``docs`` are not looked at.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        (F.octet_length(text).cast("long") + OVERHEAD).alias("size"), F.crc32(text).alias("text_crc32"),
        F.when(F.col(source_col).isNull(), "0").otherwise(F.concat(F.lit("1"), F.col(source_col))).alias("_source"),
        seeded_key(seed, F.col(id_col)).alias("_key"))
    narrow = narrow.withColumn("_cell", F.shiftrightunsigned("text_crc32", CELL_SHIFT))
    placed, total = interleave(narrow, "_source", "_key", ["doc_id", "_cell"], ["text_crc32", "size"], buckets=buckets)
    n = total.first()["total"]
    cut = placed.withColumn("shard", F.expr(f"cast(position * {shards} div {max(n, 1)} as int)"))
    first = F.expr(f"(shard * {n}L + {shards - 1}) div {shards}")
    return cut.select("doc_id", "size", "text_crc32", "source", "shard", (F.col("position") - first).alias("slot"))
