"""Incremental ingest of files that keep arriving in a folder."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from quern.sources.tables import BINARY_FILE_SCHEMA


def ingest_files(spark: SparkSession, folder: str, target: str, checkpoint: str,
                 glob: str | None = None, max_files: int = 1000) -> StreamingQuery:
    """Append the files not seen by earlier runs to a parquet folder, then stop.

    The checkpoint remembers what was taken, so a run after a failure neither loses nor repeats files.
    """
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("recursiveFileLookup", True).option("maxFilesPerTrigger", max_files))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return (reader.load(folder).writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target))
