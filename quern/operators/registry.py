"""A model registry as a table, and saved pipelines."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SCHEMA = "name string, version int, alias string, path string, features string, run_id string, created timestamp"


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def register(spark: SparkSession, table: str, name: str, path: str, features: str = "", run_id: str = "",
             alias: str | None = None) -> int:
    """Append the next version of ``name`` and return its number."""
    version = 1
    if spark.catalog.tableExists(table):
        last = spark.table(table).where(F.col("name") == name).agg(F.max("version")).first()[0]
        version = (last or 0) + 1
    row = spark.createDataFrame([(name, version, alias, path, features, run_id)],
                                "name string, version int, alias string, path string, features string, run_id string")
    row.withColumn("created", F.current_timestamp()).write.mode("append").saveAsTable(table)
    return version


def latest(models: DataFrame, *extra_order: str) -> DataFrame:
    """The highest version per name."""
    window = Window.partitionBy("name").orderBy(F.col("version").desc(), *extra_order)
    return models.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def resolve(models: DataFrame, name: str | None = None, alias: str | None = None, version: int | None = None) -> DataFrame:
    """By alias if given (its newest holder), else by version, else version 1."""
    found = models if name is None else models.where(F.col("name") == name)
    if alias is not None:
        return latest(found.where(F.col("alias") == alias))
    return found.where(F.col("version") == F.coalesce(F.lit(version).cast("int"), F.lit(1)))
