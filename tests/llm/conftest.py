import pytest
from pyspark.sql import types as T

#: Nulls, empty and blank texts, a very long one, ties, repeated rows, and columns whose names operators use.
WORDS = [f"word{k % 97}x{k % 13}" for k in range(400)]
LONG = " ".join(f"t{k % 1009}q{k % 31}" for k in range(30_000))
TEXTS = [
    (1, " ".join(WORDS)), (2, " ".join(WORDS)), (3, " ".join(WORDS[:200] + ["other"] + WORDS[201:])), (4, ""), (5, None),
    (6, "one two"), (7, "one two"), (8, " \n\t "), (9, LONG), (10, "Ünïcode Größe 中文字 😀 «q» naïve ΣΑΣ " * 3),
    (11, "a b c\na b c\na b c\nd"), (12, "x" * 3000), (None, "no id here"), (None, None), (13, "same row"), (13, "same row"),
    (14, " ".join(WORDS[100:180]) + " and then something else entirely " + " ".join(f"u{k}" for k in range(80))),
]
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    T.StructField("shard", T.IntegerType()), T.StructField("words", T.ArrayType(T.StringType())), T.StructField("row", T.StringType()),
    T.StructField("node", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("mark", T.LongType())])


def row(doc_id, text):
    source = None if doc_id is None or doc_id == 4 else "hot" if doc_id < 12 else f"s{doc_id % 3}"
    return (doc_id, text, "en", source, None if text is None else len(text), 7, ["w"], "r", None, 0.5, 3)


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame([row(*t) for t in TEXTS], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def given(spark, tiny):
    """The given documents as (id, text)."""
    return sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").collect())
