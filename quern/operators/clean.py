"""Cleaning: trimming, markers, duplicates, keys, domains, profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions import columns, ordering


def trim_strings(df: DataFrame, missing: str | None = None) -> DataFrame:
    """Trim every string column; with ``missing`` that marker becomes null.  One projection."""

    def cleaned(name: str) -> Column:
        value = F.trim(F.col(name))
        return (F.nullif(value, F.lit(missing)) if missing is not None else value).alias(name)

    return df.select(*[cleaned(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
                       for f in df.schema.fields])


def fill_missing(df: DataFrame, default: float, names: Sequence[str]) -> DataFrame:
    return df.withColumns({c: columns.fill_missing(c, default) for c in names})


def parse_dates(df: DataFrame, name: str, fmt: str = "yyyy-MM-dd") -> DataFrame:
    return df.withColumn(name, F.to_date(F.col(name), fmt))


def dedup_by_key(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row per key in ``order``.

    ``row_number() = 1`` is planned with a limit on both sides of the exchange: each task sends at most
    one row per key, so a key that holds a third of the table does not reach one task.
    """
    window = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def add_key(df: DataFrame, name: str = "id", cols: Sequence[str] | None = None) -> DataFrame:
    """A key from the row's values, equal on every run; ``cols=[]`` asks for a random uuid instead.

    Nulls are written as the two characters backslash N, so they differ from empty strings.
    """
    if cols is not None and not cols:
        return df.withColumn(name, F.expr("uuid()"))
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in (cols or df.columns)]
    return df.withColumn(name, F.md5(F.concat_ws("|", *parts)))


def domains(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Distinct non-null values of each column as rows ``column, value``; one pass for all columns."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in names]).unpivot([], list(names), "column", "value")
    return long.where(F.col("value").isNotNull()).distinct()


def profile(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """count, mean, sample stddev, min, exact quartiles and max per numeric column."""
    quartiles = ordering.exact_quantiles(df, names, [0.25, 0.5, 0.75])
    held = {c: F.col(c).cast("double") for c in names}
    moments = df.agg(*[F.struct(F.lit(c).alias("column"), F.count(v).alias("count"), F.avg(v).alias("mean"),
                                F.stddev(v).alias("stddev"), F.min(v).alias("min"), F.max(v).alias("max")).alias(c)
                       for c, v in held.items()])
    stats = moments.select(F.inline(F.array(*[F.col(c) for c in names])))
    return stats.join(F.broadcast(quartiles.select(  # one row per named column
        "column", F.col("q_0").alias("p25"), F.col("q_1").alias("p50"), F.col("q_2").alias("p75"))), "column", "left")


def append(real: DataFrame, synthetic: DataFrame) -> DataFrame:
    """Union by column name."""
    return real.unionByName(synthetic)
