"""Documents to packed training sequences: toxicity, quality, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quern.llm import chunking, jaccard, packing, quality, toxicity
from quern.session import ensure_checkpoint_dir

TOKENIZER = "word_bpe_49k.json"


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_harmless(docs, toxicity.fit(docs, labels(spark, sf_dir)))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, labels(spark, sf_dir).where("quality = 1"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_firsts(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return chunking.without_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # workers of the stages before hold memory, too, and those of this one may go on with another
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), kept=200_000, remember=False)


STAGES = [("toxicity", drop_toxic), ("quality", drop_poor), ("near_copies", drop_near_copies),
          ("repeats", cut_repeats), ("packing", pack)]

#: Trained networks and tokenizers are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).checkpoint()
    return STAGES[-1][1](spark, docs, sf_dir)
