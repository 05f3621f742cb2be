"""The queries of the operators in this package, and the SQL that some must agree with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import (bpe, chunking, fingerprint, html_text, jaccard, packing, phrases, quality, sharding, suffixes, toxicity, urls,
                       whitening)

TOKENIZER = "word_bpe_49k.json"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The checksum is worked out byte by byte from its table of 256 remainders.
ORACLE["op1_sharding"] = """
WITH bits AS (SELECT list_transform(range(256), lambda i: list_reduce([i] || [0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
raw AS (SELECT doc_id, source, hex(encode(coalesce(text, ''))) AS h FROM documents),
bytes AS (SELECT doc_id, source, len(h) // 2 AS n, list_transform(range(0, len(h), 2), lambda i: ('0x' || h[i + 1:i + 2])::BIGINT) AS b FROM raw),
sums AS (SELECT doc_id, source, n + 16 AS size, xor(4294967295, list_reduce([4294967295] || b,
    lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8))) AS text_crc32 FROM bytes, bits),
keyed AS (SELECT *, CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS s,
  ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS k FROM sums),
ranked AS (SELECT *, (row_number() OVER (PARTITION BY s ORDER BY k, doc_id, text_crc32, size) - 0.5::DOUBLE)
  / count(*) OVER (PARTITION BY s) AS share FROM keyed),
placed AS (SELECT *, row_number() OVER (ORDER BY share, k, s, doc_id, text_crc32, size) - 1 AS p, count(*) OVER () AS n FROM ranked),
cut AS (SELECT *, CAST(p * 40 // n AS INTEGER) AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard, CAST(p - (shard * n + 39) // 40 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM cut"""


@query
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    return quality.quality_rules(table(spark, sf_dir, "documents"), trusted)


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


@query
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), with_ids=False)


@query
def op3_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.near_edited(table(spark, sf_dir, "documents"))


#: All pairs that share an n-gram, in place of the banded candidates.
ORACLE["op5_jaccard"] = r"""
WITH RECURSIVE
split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) >= 5 THEN
    list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS grams FROM split),
keyed AS (SELECT doc_id, md5(array_to_string(grams, chr(10))) AS node, grams FROM sets),
nodes AS (SELECT node, count(*) AS copies, min(doc_id) AS least, any_value(grams) AS grams FROM keyed GROUP BY node),
flat AS (SELECT node, len(grams) AS size, unnest(grams) AS gram FROM nodes),
shared AS (SELECT a.node AS x, b.node AS y, count(*) AS n, any_value(a.size + b.size) AS sizes
  FROM flat a JOIN flat b ON a.gram = b.gram AND a.node < b.node GROUP BY 1, 2),
links AS (SELECT x, y FROM shared WHERE n >= 0.8::DOUBLE * (sizes - n) - 1e-9 UNION ALL
  SELECT y, x FROM shared WHERE n >= 0.8::DOUBLE * (sizes - n) - 1e-9),
reach(node, other) AS (SELECT node, node FROM nodes UNION SELECT r.node, l.y FROM reach r JOIN links l ON r.other = l.x),
classes AS (SELECT r.node, min(n.least) AS class_id FROM reach r JOIN nodes n ON r.other = n.node GROUP BY 1),
counted AS (SELECT l.x AS node, sum(n.copies) AS linked FROM links l JOIN nodes n ON l.y = n.node GROUP BY 1)
SELECT k.doc_id, c.class_id, CAST(coalesce(l.linked, 0) + n.copies - 1 AS BIGINT) AS n_links
FROM keyed k JOIN nodes n USING (node) JOIN classes c USING (node) LEFT JOIN counted l USING (node)"""


@query
def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


@query
def op9_chunking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.dedup_chunks(table(spark, sf_dir, "documents")).drop("row")


@query
def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.dedup_suffixes(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxicity(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(vectors)
    error = whitening.identity_error(vectors, model)
    shares = F.array(*[F.lit(float(v / model.trace)) for v in model.values]).cast("array<double>")
    found = whitening.whiten(vectors, model).select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return found.select("vec_id", (F.col("place") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                        shares[F.col("place")].alias("explained"), F.lit(error).alias("identity_error"))


ORACLE["op12_phrases"] = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS piece FROM documents),
split AS (SELECT lang, row_number() OVER () AS piece_id, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM split GROUP BY lang),
words AS (SELECT lang, piece_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM split WHERE len(w) > 0),
runs AS (SELECT lang, word, lead(word) OVER (PARTITION BY piece_id ORDER BY pos) AS word2,
  lead(word, 2) OVER (PARTITION BY piece_id ORDER BY pos) AS word3 FROM words),
grams AS (SELECT lang, 1 AS k, word AS phrase FROM runs UNION ALL
  SELECT lang, 2, word || ' ' || word2 FROM runs WHERE word2 IS NOT NULL UNION ALL
  SELECT lang, 3, word || ' ' || word2 || ' ' || word3 FROM runs WHERE word3 IS NOT NULL),
counts AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
cands AS MATERIALIZED (SELECT lang, k AS words, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k >= 2),
parts AS MATERIALIZED (SELECT lang, words, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
  FROM cands, (SELECT 1 AS k UNION ALL SELECT 2) cut_at WHERE k < words),
cuts AS (SELECT p.lang, p.words, p.phrase, p.a, p.k, x.f AS l, y.f AS r, (1000000::HUGEINT * p.a * p.a) // (x.f::HUGEINT * y.f) AS score
  FROM parts p JOIN counts x ON x.lang = p.lang AND x.phrase = p.head JOIN counts y ON y.lang = p.lang AND y.phrase = p.tail),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (SELECT lang, phrase, max(a) AS top FROM (SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase
  FROM cands WHERE words = 3) GROUP BY ALL),
ranked AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM best b LEFT JOIN longer g ON b.words = 2 AND g.lang = b.lang AND g.phrase = b.phrase WHERE g.top IS NULL OR 100 * g.top < 50 * a)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""


@query
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.top_phrases(table(spark, sf_dir, "documents"))


#: Verdict, host and path of the entries.
URL_ENTRIES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"),
               ("block", "net", "/fr/")]

ORACLE["op13_urls"] = r"""
WITH parts AS (SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
entries(verdict, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
judged AS (SELECT *, (SELECT arg_max({'rule': h || p, 'verdict': verdict}, length(h || p)) FROM entries
  WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS best FROM parts)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM judged"""


@query
def op13_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = spark.createDataFrame(URL_ENTRIES, "verdict string, host string, path string")
    return urls.judge(table(spark, sf_dir, "pages"), entries).select("page_id", "host", "path", "rule", "verdict")
