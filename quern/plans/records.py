"""Record pipelines: tiles, batch scoring, redaction."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from quern.operators import inference, redact
from quern.plans.registry import query
from quern.sources.tables import load

SIZES_SQL = "sizes AS (SELECT p_partkey, 200 + (p_partkey * 37) % 1800 AS width, 150 + (p_size * 71) % 1500 AS height FROM part)"


def _sizes(spark, sf):
    return load(spark, sf, "part").select("p_partkey", (200 + F.col("p_partkey") * 37 % 1800).alias("width"),
                                          (150 + F.col("p_size") * 71 % 1500).alias("height"))


TILES_SQL = f"""
WITH {SIZES_SQL}, grids AS (SELECT i, j, row_number() OVER (ORDER BY i * j, i) AS pos
  FROM range(1, 7) a(i), range(1, 7) b(j) WHERE i * j <= 6),
gaps AS (SELECT s.*, i, j, abs(width / height - i / j) AS gap FROM sizes s, grids),
ties AS (SELECT *, min(gap) OVER (PARTITION BY p_partkey) AS best, width * height > 0.5 * 448 * 448 * i * j AS roomy FROM gaps),
tiles AS (SELECT p_partkey, width, height, CAST(i AS INTEGER) AS tiles_x, CAST(j AS INTEGER) AS tiles_y,
  CAST(i * j AS INTEGER) AS blocks, CAST(i * 448 AS INTEGER) AS target_width, CAST(j * 448 AS INTEGER) AS target_height
  FROM ties WHERE gap = best
  QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY roomy DESC, CASE WHEN roomy THEN -i * j ELSE i * j END) = 1)
"""


@query("image_tile_plan", f"{TILES_SQL} SELECT * FROM tiles")
def image_tile_plan(spark, sf):
    return inference.plan_tiles(_sizes(spark, sf), "width", "height")


@query("image_tile_boxes", f"""
{TILES_SQL}, numbered AS (SELECT p_partkey, blocks, tiles_x,
  unnest(range(blocks + CASE WHEN blocks > 1 THEN 1 ELSE 0 END)) AS tile FROM tiles)
SELECT p_partkey, CAST(tile AS INTEGER) AS tile, tile = blocks AS is_thumbnail,
  CAST(CASE WHEN tile = blocks THEN 0 ELSE tile % tiles_x * 448 END AS INTEGER) AS x0,
  CAST(CASE WHEN tile = blocks THEN 0 ELSE tile // tiles_x * 448 END AS INTEGER) AS y0,
  CAST(CASE WHEN tile = blocks THEN 448 ELSE (tile % tiles_x + 1) * 448 END AS INTEGER) AS x1,
  CAST(CASE WHEN tile = blocks THEN 448 ELSE (tile // tiles_x + 1) * 448 END AS INTEGER) AS y1 FROM numbered""")
def image_tile_boxes(spark, sf):
    boxes = inference.tile_boxes(inference.plan_tiles(_sizes(spark, sf), "width", "height"), thumbnail=True)
    return boxes.select("p_partkey", "tile", "is_thumbnail", "x0", "y0", "x1", "y1")


@query("normalize_vector", """
SELECT vec_id, CAST(p AS INTEGER) AS pos, round((CAST(embedding[p + 1] AS DOUBLE) - 0.5) / 0.5, 6) AS value
FROM (SELECT vec_id, embedding, unnest(range(len(embedding))) AS p FROM embeddings)""")
def normalize_vector(spark, sf):
    scaled = inference.normalize_array(load(spark, sf, "embeddings"), "embedding", 0.5, 0.5, "scaled")
    return scaled.select("vec_id", F.posexplode("scaled").alias("pos", "value")).withColumn("value", F.round("value", 6))


class LinearScorer:
    """A stand-in for a model: fixed weights, built once per task."""

    def __init__(self, size: int = 64):
        self.weights = np.array([(i * 37 % 11 - 5) / 10 for i in range(size)])

    def __call__(self, batch: pd.DataFrame) -> pd.DataFrame:
        score = np.stack(batch["embedding"].to_list()).astype(float) @ self.weights
        return pd.DataFrame({"vec_id": batch["vec_id"], "score": np.round(score, 4)})


@query("batch_score", """
SELECT vec_id, round(list_sum(list_transform(range(len(embedding)),
  lambda i: CAST(embedding[i + 1] AS DOUBLE) * ((i * 37 % 11 - 5) / 10.0::DOUBLE))), 4) AS score FROM embeddings""")
def batch_score(spark, sf):
    rows = load(spark, sf, "embeddings").select("vec_id", "embedding")
    return inference.score(rows, LinearScorer, "vec_id bigint, score double", batch_size=128)


class Describe:
    """A stand-in for a text model: one string per input, in input order."""

    def __call__(self, texts: pd.Series) -> pd.Series:
        return texts.str.count("[^ \\t\\r\\n]+").map("words={}".format)


@query("udf_column", r"""
SELECT doc_id, 'words=' || CAST(len(regexp_extract_all(text, '[^ \t\r\n]+')) AS VARCHAR) AS description FROM documents""")
def udf_column(spark, sf):
    describe = inference.as_column(Describe)
    return load(spark, sf, "documents").select("doc_id", describe("text").alias("description"))


# --- redaction --------------------------------------------------------------------------------------

def _label_sql(word: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({word}, '{p}') THEN '{name}'"
                              for name, p in redact.RULES.items()) + " ELSE 'O' END"


WORDS_SQL = rf"""
WITH arrays AS (SELECT doc_id, length(text) AS total, regexp_extract_all(text, '[^ \t\r\n]+') AS words,
  string_split_regex(text, '[^ \t\r\n]+') AS gaps FROM documents),
exploded AS (SELECT doc_id, total, unnest(range(len(words))) AS pos, unnest(words) AS word, unnest(gaps[:len(words)]) AS gap FROM arrays),
placed AS (SELECT *, sum(length(gap) + length(word)) OVER (PARTITION BY doc_id ORDER BY pos) AS word_end FROM exploded),
tokens AS (SELECT doc_id, total, pos, word_end - length(word) AS s, word_end AS e, {_label_sql('word')} AS label FROM placed)
"""


def _spans_sql(aggregate: bool, legacy: bool) -> str:
    join = "label <> 'O' AND prev <> 'O'" if aggregate else "label = prev"
    if legacy:
        close = "CASE WHEN nl <> 'O' THEN ns WHEN ne IS NULL THEN total ELSE ne END"
    else:
        close = "CASE WHEN nl <> 'O' THEN ns ELSE e END"
    return f"""{WORDS_SQL},
around AS (SELECT *, coalesce(lag(label) OVER w, 'O') AS prev, lead(label) OVER w AS nl, lead(s) OVER w AS ns, lead(e) OVER w AS ne
  FROM tokens WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
hot AS (SELECT *, sum(CASE WHEN {join} THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY pos) AS island, {close} AS close
  FROM around WHERE label <> 'O'),
spans AS (SELECT doc_id, island, CAST(min(s) AS INTEGER) AS start, CAST(max(close) AS INTEGER) AS "end",
  arg_min(label, pos) AS label FROM hot GROUP BY doc_id, island)"""


def _masked_sql(aggregate: bool, legacy: bool, out: str = "redacted_text") -> str:
    tag = "'[redacted]'" if aggregate else "'[' || label || ']'"
    return f"""{_spans_sql(aggregate, legacy)},
gapped AS (SELECT *, coalesce(lag("end") OVER (PARTITION BY doc_id ORDER BY start), 0) AS before FROM spans),
cut AS (SELECT g.*, d.text FROM gapped g JOIN documents d USING (doc_id)),
joined AS (SELECT doc_id, string_agg(substr(text, before + 1, start - before) || {tag}, '' ORDER BY start)
  || substr(any_value(text), max("end") + 1) AS masked FROM cut GROUP BY doc_id)
SELECT d.doc_id, coalesce(masked, text) AS {out} FROM documents d LEFT JOIN joined USING (doc_id)"""


@query("pii_spans", f"""{_spans_sql(False, False)} SELECT doc_id, start, "end", label FROM spans""")
def pii_spans(spark, sf):
    return redact.find_spans(load(spark, sf, "documents"), "text", ["doc_id"])


@query("pii_spans_legacy", f"""{_spans_sql(False, True)} SELECT doc_id, start, "end", label FROM spans""")
def pii_spans_legacy(spark, sf):
    return redact.find_spans(load(spark, sf, "documents"), "text", ["doc_id"], legacy_end=True)


@query("pii_redact_spans", _masked_sql(False, False))
def pii_redact_spans(spark, sf):
    return redact.redact(load(spark, sf, "documents").select("doc_id", "text"), "text").drop("text")


@query("pii_redact_aggregate", _masked_sql(True, False))
def pii_redact_aggregate(spark, sf):
    return redact.redact(load(spark, sf, "documents").select("doc_id", "text"), "text", aggregate=True).drop("text")


@query("pii_redact_legacy", _masked_sql(False, True))
def pii_redact_legacy(spark, sf):
    return redact.redact(load(spark, sf, "documents").select("doc_id", "text"), "text", legacy_end=True).drop("text")


@query("pii_redact_aggregate_legacy", _masked_sql(True, True))
def pii_redact_aggregate_legacy(spark, sf):
    rows = load(spark, sf, "documents").select("doc_id", "text")
    return redact.redact(rows, "text", aggregate=True, legacy_end=True).drop("text")


@query("score_then_redact", rf"""
WITH m AS ({_masked_sql(False, False)})
SELECT doc_id, redacted_text, 'words=' || CAST(len(regexp_extract_all(text, '[^ \t\r\n]+')) AS VARCHAR) AS description
FROM m JOIN documents USING (doc_id)""")
def score_then_redact(spark, sf):
    """Score, redact, drop the raw text: one job without a shuffle."""
    describe = inference.as_column(Describe)
    return inference.pipeline(load(spark, sf, "documents").select("doc_id", "text"), [
        lambda df: df.withColumn("description", describe("text")), lambda df: redact.redact(df, "text")], drop=["text"])
