"""Readers, writers and catalog calls."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions import joins

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_csv(spark: SparkSession, path: str | list[str], ddl: str) -> DataFrame:
    """CSV without a header, read with a fixed schema."""
    return spark.read.schema(ddl).csv(path)


def read_csv_typed(spark: SparkSession, path: str | list[str], types: Mapping[str, str] | None = None) -> DataFrame:
    """CSV with a header; columns are strings except those named in ``types`` (bad values become null)."""
    raw = spark.read.option("header", True).csv(path)
    types = types or {}
    return raw.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in raw.columns])


def read_binary(spark: SparkSession, folders: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """Files of one or many folders as ``path, modificationTime, length, content``."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load([folders] if isinstance(folders, str) else list(folders))


def list_files(spark: SparkSession, folders: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """Metadata of the files of a folder; file contents are not read."""
    listed = read_binary(spark, folders, glob).drop("content")
    return listed.select("path", F.element_at(F.split("path", "/"), -1).alias("name"),
                         F.col("length").alias("size"), "modificationTime",
                         F.regexp_replace("path", "^[A-Za-z][A-Za-z0-9+.-]*:/*", "/").alias("file_path"))


def empty_like(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """No rows, given columns; the start value of a fold over frames."""
    return spark.createDataFrame([], schema)


def append_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column missing from one frame is null there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def ensure_namespace(spark: SparkSession, name: str, use: bool = False) -> None:
    spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:name)", args={"name": name})
    if use:
        spark.catalog.setCurrentDatabase(name)


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": table})


def sql(spark: SparkSession, text: str, **params) -> DataFrame:
    """SQL with ``:name`` parameters; write ``IDENTIFIER(:name)`` for a table or column name."""
    return spark.sql(text, args=params)


def save_table(df: DataFrame, table: str, mode: str = "overwrite", merge_schema: bool = False,
               partition_by: Sequence[str] = (), key: str | None = None) -> None:
    """Write a parquet table.

    ``overwrite`` replaces rows and schema; ``append`` adds rows, with ``merge_schema`` also columns;
    ``merge`` replaces the rows whose ``key`` arrives again.  A table that is also an input of ``df`` is
    replaced through a staging table, so its old files stay readable until the new ones are complete.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(table)
    if mode == "merge" and not key:
        raise ValueError("mode 'merge' needs a key")
    if mode == "merge" and exists:
        _replace(upsert(spark.table(table), df, key), table, partition_by)
    elif mode == "append" and exists and merge_schema and set(df.columns) - set(spark.table(table).columns):
        _replace(append_all([spark.table(table), df]), table, partition_by)
    elif mode == "append" and exists:
        spark.createDataFrame([], spark.table(table).schema).unionByName(
            df, allowMissingColumns=merge_schema).write.mode("append").saveAsTable(table)
    else:
        _writer(df, partition_by).mode("overwrite" if mode == "merge" else mode).saveAsTable(table)


def _writer(df: DataFrame, partition_by: Sequence[str]):
    writer = df.write.format("parquet")
    return writer.partitionBy(*partition_by) if partition_by else writer


def _replace(df: DataFrame, table: str, partition_by: Sequence[str]) -> None:
    spark = df.sparkSession
    staging = f"{table}__staging"
    _writer(df, partition_by).mode("overwrite").saveAsTable(staging)
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": table})
    spark.sql(f"ALTER TABLE {staging} RENAME TO {table}")


def merge_partitions(table: str, changes: DataFrame, key: str) -> None:
    """``merge`` into a partitioned table that rewrites only the partitions an arriving key is in or goes to.

    ``changes`` has the table's columns and unique keys. Files of the other partitions are neither read past their
    keys nor written. Spark writes beside the table and moves the new partitions in when all tasks are done; partitions
    that lost all of their rows are dropped after that, so a stop in between leaves a moved row twice until the merge
    is repeated.
    """
    spark = changes.sparkSession
    current = spark.table(table)
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if not parts:
        raise ValueError(f"table {table} has no partitions")
    arriving = changes.select(key)
    places = current.select(key, *parts)
    touched = places.join(arriving, key, "left_semi").select(*parts).union(changes.select(*parts)).distinct()
    filled = joins.match_keys(places.join(arriving, key, "left_anti"), touched, parts).select(*parts).union(changes.select(*parts))
    # One row per partition at most, which the catalog holds in the driver anyway.
    emptied = touched.exceptAll(filled.distinct()).collect()
    rows = upsert(joins.match_keys(current, touched, parts), changes, key)
    mode = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")  # the writer of a catalog table has no option for it
    try:
        rows.select(*current.columns).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(OVERWRITE_MODE, mode)
    for row in emptied:
        gone = ", ".join(f"{name} = {sql_literal(row[name])}" for name in parts)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({gone})")


def sql_literal(value) -> str:
    """A partition value as SQL text."""
    if value is None:
        return "NULL"
    return str(value) if isinstance(value, (int, float)) else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def upsert(base: DataFrame, changes: DataFrame, key: str, order: Sequence[Column] | None = None) -> DataFrame:
    """Base rows whose key does not arrive, plus one row per arriving key.

    With ``order`` the first row per key in that order wins; without it keys must be unique.  The
    row_number filter is applied before the exchange too, so a hot key sends one row per task.
    """
    if order is not None:
        window = Window.partitionBy(key).orderBy(*order)
        changes = changes.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")
    kept = base.join(changes.select(key), key, "left_anti")
    return kept.unionByName(changes, allowMissingColumns=True)


def check_key(df: DataFrame, *key: str) -> None:
    """Raise unless ``key`` is non-null and unique."""
    bad = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    null = F.lit(False)
    for c in key:
        null = null | F.col(c).isNull()
    if bad.where((F.col("_n") > 1) | null).limit(1).count():
        raise ValueError(f"key {key} has nulls or duplicates")


def create_feature_table(df: DataFrame, table: str, *key: str) -> None:
    """A keyed table; an existing table of that name is an error, not a silent skip."""
    if df.sparkSession.catalog.tableExists(table):
        raise ValueError(f"table {table} already exists")
    check_key(df, *key)
    save_table(df, table, mode="error")
