"""Ingest, cleaning, keys, joins, profiles, feature preparation."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quern.functions import columns, hashing, ordering
from quern.operators import clean, features, registry, splits
from quern.plans import standins as st
from quern.plans.registry import query, sql_uniform
from quern.session import ensure_checkpoint_dir
from quern.sources import synth, tables
from quern.sources.tables import load


@query("scan_count", """
SELECT l_returnflag, count(*) AS rows FROM lineitem GROUP BY 1""")
def scan_count(spark, sf):
    return load(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("rows"))


SYNTH_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                 "l_returnflag", "l_linestatus", "l_shipdate"]
SYNTH_STEPS = {"l_extendedprice": 100, "l_discount": 0.01, "l_tax": 0.01}
SYNTH_WHOLE, SYNTH_DOUBLES, SYNTH_TEXTS = SYNTH_COLUMNS[:4], SYNTH_COLUMNS[4:8], SYNTH_COLUMNS[8:10]


def synthetic(spark, sf):
    """As many synthetic rows as there are orders, over the ranges and domains of the order lines."""
    spec = synth.synth_spec_from(load(spark, sf, "lineitem").select(*SYNTH_COLUMNS), steps=SYNTH_STEPS)
    return synth.synth_table(spark, load(spark, sf, "orders").count(), spec)


def _sql_step(name, step=1):
    u = sql_uniform(2025, "i", name)
    return f"lo_{name} + {float(step)}::DOUBLE * floor({u} * (floor((hi_{name} - lo_{name}) / {float(step)} + 1e-9) + 1))"


def _sql_pick(name):
    return f"d_{name}[CAST(floor({sql_uniform(2025, 'i', name)} * len(d_{name})) AS INTEGER) + 1] AS {name}"


SYNTH_SQL = f"""
days AS (SELECT * REPLACE (date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS l_shipdate) FROM lineitem),
spec AS (SELECT {', '.join(f'min({c}) AS lo_{c}, max({c}) AS hi_{c}' for c in [*SYNTH_WHOLE, *SYNTH_DOUBLES, 'l_shipdate'])},
         {', '.join(f'list_sort(list(DISTINCT {c})) AS d_{c}' for c in SYNTH_TEXTS)} FROM days),
synth AS (SELECT i AS row_id,
  {', '.join(f'CAST({_sql_step(c)} AS {"INTEGER" if c == "l_linenumber" else "BIGINT"}) AS {c}' for c in SYNTH_WHOLE)},
  {', '.join(f'round({_sql_step(c, SYNTH_STEPS.get(c, 1))}, 4) AS {c}' for c in SYNTH_DOUBLES)},
  {', '.join(_sql_pick(c) for c in SYNTH_TEXTS)},
  CAST(DATE '1970-01-01' + CAST({_sql_step('l_shipdate')} AS INTEGER) AS TIMESTAMP) AS l_shipdate
  FROM spec, range((SELECT count(*) FROM orders)) r(i))
"""


@query("synth_rows", f"WITH {SYNTH_SQL} SELECT * FROM synth")
def synth_rows(spark, sf):
    rows = synthetic(spark, sf)
    return rows.withColumns({c: F.round(c, 4) for c in SYNTH_DOUBLES})


@query("union_real_synth", f"""
WITH {SYNTH_SQL}
SELECT 'real' AS origin, {', '.join(SYNTH_COLUMNS)} FROM lineitem
UNION ALL SELECT 'synthetic', {', '.join(SYNTH_COLUMNS)} FROM synth""")
def union_real_synth(spark, sf):
    real = load(spark, sf, "lineitem").select(F.lit("real").alias("origin"), *SYNTH_COLUMNS)
    return clean.append(real, synth_rows(spark, sf).drop("row_id").withColumn("origin", F.lit("synthetic")))


@query("upsert_latest", """
WITH changes AS (
  SELECT o_custkey + CASE WHEN o_custkey % 5 = 0 THEN 10000000 ELSE 0 END AS k, o_totalprice, o_orderdate, o_orderkey FROM orders),
newest AS (
  SELECT k, o_totalprice FROM changes
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
SELECT c_custkey AS custkey, c_acctbal AS balance FROM customer WHERE c_custkey NOT IN (SELECT k FROM newest)
UNION ALL SELECT k, o_totalprice FROM newest""")
def upsert_latest(spark, sf):
    base = load(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), F.col("c_acctbal").alias("balance"))
    shift = F.when(F.col("o_custkey") % 5 == 0, 10000000).otherwise(0)
    changes = load(spark, sf, "orders").select((F.col("o_custkey") + shift).alias("custkey"),
                                               F.col("o_totalprice").alias("balance"), "o_orderdate", "o_orderkey")
    merged = tables.upsert(base, changes, "custkey", [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])
    return merged.select("custkey", "balance")


@query("merge_partitions", """
WITH changes AS (
  SELECT c_custkey AS custkey, c_acctbal + 100 AS balance, (c_nationkey + 1) % 25 AS nation FROM customer
  WHERE c_nationkey < 5 AND c_custkey % 3 = 0 OR c_nationkey = 24
  UNION ALL SELECT c_custkey + 10000000, c_acctbal, 2 FROM customer WHERE c_custkey % 50 = 0)
SELECT c_custkey AS custkey, c_acctbal AS balance, c_nationkey AS nation FROM customer
WHERE c_custkey NOT IN (SELECT custkey FROM changes)
UNION ALL SELECT custkey, balance, nation FROM changes""")
def merge_partitions(spark, sf):
    """Write a partitioned table, merge changed, moved and new rows into some partitions (one becomes empty), read it."""
    base = load(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), F.col("c_acctbal").alias("balance"),
                                              F.col("c_nationkey").alias("nation"))
    moved = base.where("nation < 5 AND custkey % 3 = 0 OR nation = 24").select(
        "custkey", (F.col("balance") + 100).alias("balance"), ((F.col("nation") + 1) % 25).cast(base.schema["nation"].dataType).alias("nation"))
    new = base.where("custkey % 50 = 0").select((F.col("custkey") + 10000000).alias("custkey"), "balance",
                                                F.lit(2).cast(base.schema["nation"].dataType).alias("nation"))
    ensure_checkpoint_dir(spark)
    name = f"merge_partitions_{uuid.uuid4().hex}"
    tables.save_table(base, name, partition_by=["nation"])
    tables.merge_partitions(name, moved.union(new), "custkey")
    out = spark.table(name).checkpoint()
    tables.drop_table(spark, name)
    return out


@query("filter_conjunction", """
SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem
WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND l_quantity = 10""")
def filter_conjunction(spark, sf):
    lines = load(spark, sf, "lineitem")
    kept = lines.where((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F") & (F.col("l_quantity") == 10))
    return kept.select("l_orderkey", "l_partkey", "l_extendedprice")


@query("clean_trim_null", """
SELECT c_custkey, nullif(trim(CASE WHEN c_custkey % 7 = 0 THEN ' ? ' ELSE '  ' || c_mktsegment || ' ' END), '?') AS segment,
       nullif(trim(' ' || c_name), '?') AS name, c_acctbal FROM customer""")
def clean_trim_null(spark, sf):
    raw = load(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 7 == 0, " ? ").otherwise(F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))).alias("segment"),
        F.concat(F.lit(" "), "c_name").alias("name"), "c_acctbal")
    return clean.trim_strings(raw, "?")


@query("domain_values", """
SELECT DISTINCT 'p_brand' AS "column", p_brand AS value FROM part WHERE p_brand IS NOT NULL
UNION ALL SELECT DISTINCT 'kind', nullif(p_type, 'SMALL') FROM part WHERE nullif(p_type, 'SMALL') IS NOT NULL
UNION ALL SELECT DISTINCT 'p_size', CAST(p_size AS VARCHAR) FROM part""")
def domain_values(spark, sf):
    parts = load(spark, sf, "part").select("p_brand", F.nullif("p_type", F.lit("SMALL")).alias("kind"), "p_size")
    return clean.domains(parts, ["p_brand", "kind", "p_size"])


@query("fill_missing", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber IN (2, 3) THEN 1000.0::DOUBLE ELSE l_discount END AS discount
FROM lineitem""")
def fill_missing(spark, sf):
    value = (F.when(F.col("l_linenumber") == 3, F.lit(None).cast("double"))
             .when(F.col("l_linenumber") == 2, F.lit(float("nan"))).otherwise(F.col("l_discount")))
    rows = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", value.alias("discount"))
    return clean.fill_missing(rows, 1000.0, ["discount"])


LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus"]


@query("dedup_by_key", f"""
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(LINE_ORDER)}) = 1""")
def dedup_by_key(spark, sf):
    return clean.dedup_by_key(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], LINE_ORDER)


@query("encode_label", """
SELECT c_custkey, c_mktsegment, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS label FROM customer""")
def encode_label(spark, sf):
    rows = load(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return features.encode_label(rows, "c_mktsegment", "label").select("c_custkey", "c_mktsegment", "label")


@query("stable_key", """
SELECT c_custkey, md5(c_custkey || '|' || c_name || '|' || c_mktsegment) AS id FROM customer""")
def stable_key(spark, sf):
    rows = load(spark, sf, "customer")
    return clean.add_key(rows, "id", ["c_custkey", "c_name", "c_mktsegment"]).select("c_custkey", "id")


@query("feature_lookup_join", """
SELECT o_orderkey, o_orderstatus, c_mktsegment, c_acctbal, n_name
FROM orders LEFT JOIN customer ON c_custkey = o_custkey
LEFT JOIN nation ON n_nationkey = c_nationkey""")
def feature_lookup_join(spark, sf):
    labels = load(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("custkey"), "o_orderstatus")
    customers = load(spark, sf, "customer").withColumnsRenamed({"c_custkey": "custkey", "c_nationkey": "nationkey"})
    nations = load(spark, sf, "nation").withColumnRenamed("n_nationkey", "nationkey")
    looked = features.training_set(labels, [
        features.Lookup(customers, "custkey", ("c_mktsegment", "c_acctbal", "nationkey")),
        features.Lookup(nations, "nationkey", ("n_name",))], exclude=["custkey", "nationkey"])
    return looked.select("o_orderkey", "o_orderstatus", "c_mktsegment", "c_acctbal", "n_name")


PROFILED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("profile_numeric", " UNION ALL ".join(f"""
SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev,
       min({c}) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
       round(quantile_cont({c}, 0.75), 6) AS p75, max({c}) AS max FROM lineitem""" for c in PROFILED))
def profile_numeric(spark, sf):
    out = clean.profile(load(spark, sf, "lineitem"), PROFILED)
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "stddev", "p25", "p50", "p75")})


@query("impute_values", f"""
WITH {st.HOLED_SQL}, modes AS (
  SELECT 'l_returnflag' AS "column", l_returnflag AS v, count(*) AS n FROM holed WHERE l_returnflag IS NOT NULL GROUP BY ALL
  UNION ALL SELECT 'l_linestatus', l_linestatus, count(*) FROM holed WHERE l_linestatus IS NOT NULL GROUP BY ALL)
SELECT "column", v AS text_value, NULL::DOUBLE AS number_value FROM modes
QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY n DESC, v) = 1
UNION ALL SELECT 'l_quantity', NULL, quantile_cont(l_quantity, 0.5) FROM holed
UNION ALL SELECT 'l_extendedprice', NULL, round(quantile_cont(l_extendedprice, 0.5), 6) FROM holed
UNION ALL SELECT 'l_discount', NULL, quantile_cont(l_discount, 0.5) FROM holed""")
def impute_values(spark, sf):
    frame = features.impute_frame(st.holed(spark, sf), st.STRINGS, st.NUMBERS)
    return frame.withColumn("number_value", F.round("number_value", 6))


SPLIT_KEY = "CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)"
TRAIN_SQL = f"train AS (SELECT * FROM holed WHERE {sql_uniform(2025, SPLIT_KEY, 'split')} < 0.8)"


def line_split(df, share=0.8):
    parts = splits.hash_split(df, hashing.joined_key("l_orderkey", "l_linenumber"),
                              {"train": share, "test": 1 - share})
    return (parts.where(F.col("split") == "train").drop("split"), parts.where(F.col("split") == "test").drop("split"))


@query("scale_numeric", f"""
WITH {st.HOLED_SQL}, {TRAIN_SQL},
stats AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_extendedprice) AS mp, stddev_pop(l_extendedprice) AS sp FROM train)
SELECT l_orderkey, l_linenumber, round((l_quantity - mq) / sq, 6) AS l_quantity_scaled,
       round((l_extendedprice - mp) / sp, 6) AS l_extendedprice_scaled FROM holed, stats""")
def scale_numeric(spark, sf):
    rows = st.holed(spark, sf)
    train, _ = line_split(rows)
    out = features.scale_numeric(rows, features.fit_scale(train, ["l_quantity", "l_extendedprice"]))
    return out.select("l_orderkey", "l_linenumber", F.round("l_quantity_scaled", 6).alias("l_quantity_scaled"),
                      F.round("l_extendedprice_scaled", 6).alias("l_extendedprice_scaled"))


@query("one_hot_vectors", f"""
WITH {st.HOLED_SQL}, {TRAIN_SQL},
modes AS (SELECT
  (SELECT l_returnflag FROM train WHERE l_returnflag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS flag,
  (SELECT l_linestatus FROM train WHERE l_linestatus IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS status,
  (SELECT quantile_cont(l_quantity, 0.5) FROM train) AS mq, (SELECT quantile_cont(l_discount, 0.5) FROM train) AS md),
filled AS (SELECT t.l_orderkey, t.l_linenumber, coalesce(l_returnflag, flag) AS f, coalesce(l_linestatus, status) AS s,
  coalesce(l_quantity, mq) AS q, l_extendedprice AS p, coalesce(l_discount, md) AS d FROM holed t, modes),
fitted AS (SELECT coalesce(l_quantity, mq) AS q, l_extendedprice AS p, coalesce(l_discount, md) AS d FROM train, modes),
stats AS (SELECT avg(q) AS aq, stddev_pop(q) AS sq, avg(p) AS ap, stddev_pop(p) AS sp, avg(d) AS ad, stddev_pop(d) AS sd FROM fitted)
SELECT l_orderkey, l_linenumber, (f = 'A')::DOUBLE AS flag_a, (f = 'N')::DOUBLE AS flag_n, (f = 'R')::DOUBLE AS flag_r,
  (s = 'F')::DOUBLE AS status_f, (s = 'O')::DOUBLE AS status_o, round((q - aq) / sq, 6) AS quantity,
  round((p - ap) / sp, 6) AS price, round((d - ad) / sd, 6) AS discount FROM filled, stats""")
def one_hot_vectors(spark, sf):
    rows = st.holed(spark, sf)
    train, _ = line_split(rows)
    model = features.build_preprocessor(train, st.STRINGS, st.NUMBERS)
    vector = model.transform(rows).select("l_orderkey", "l_linenumber", vector_to_array("features").alias("v"))
    names = ["flag_a", "flag_n", "flag_r", "status_f", "status_o", "quantity", "price", "discount"]
    return vector.select("l_orderkey", "l_linenumber",
                         *[(F.round(F.col("v")[i], 6) if i > 4 else F.col("v")[i]).alias(n) for i, n in enumerate(names)])


@query("train_test_split", f"""
SELECT o_orderkey, CASE WHEN u < 0.6 THEN 'train' WHEN u < 0.9 THEN 'validation' ELSE 'test' END AS split
FROM (SELECT o_orderkey, {sql_uniform(2025, 'o_orderkey', 'split')} AS u FROM orders)""")
def train_test_split(spark, sf):
    orders = load(spark, sf, "orders").select("o_orderkey")
    return splits.hash_split(orders, F.col("o_orderkey"), {"train": 0.6, "validation": 0.3, "test": 0.1})


@query("top_n_preview", "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_n_preview(spark, sf):
    return load(spark, sf, "orders").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10)


@query("last_row", "SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1")
def last_row(spark, sf):
    return load(spark, sf, "orders").orderBy(F.col("o_orderdate").desc(), F.col("o_orderkey").desc()).limit(1)


@query("url_strip_prefix", """
SELECT page_id, CASE WHEN starts_with(url, 'https://') THEN substr(url, 9) ELSE url END AS file_path FROM pages""")
def url_strip_prefix(spark, sf):
    pages = load(spark, sf, "pages")
    return pages.select("page_id", columns.strip_prefix("url", "https://").alias("file_path"))


REGISTRY_SQL = """
models AS (SELECT 'model_' || o_custkey AS name,
  CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS version,
  CASE WHEN o_orderstatus = 'F' THEN 'Production' ELSE 'Staging' END AS alias, o_orderkey AS run_id FROM orders)
"""


@query("registry_latest", f"""
WITH {REGISTRY_SQL}
SELECT * FROM (SELECT 'latest' AS how, * FROM models QUALIFY row_number() OVER (PARTITION BY name ORDER BY version DESC) = 1)
UNION ALL SELECT * FROM (SELECT 'alias', * FROM models WHERE alias = 'Production'
  QUALIFY row_number() OVER (PARTITION BY name ORDER BY version DESC) = 1)
UNION ALL SELECT 'default', * FROM models WHERE version = 1""")
def registry_latest(spark, sf):
    orders = load(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    models = ordering.row_numbers(orders, ["o_orderdate", "o_orderkey"], "version", ["o_custkey"],
                                  at_most=orders.count()).select(
        F.concat(F.lit("model_"), F.col("o_custkey").cast("string")).alias("name"), F.col("version").cast("int").alias("version"),
        F.when(F.col("o_orderstatus") == "F", "Production").otherwise("Staging").alias("alias"),
        F.col("o_orderkey").alias("run_id"))
    found = [("latest", registry.latest(models)), ("alias", registry.resolve(models, alias="Production")),
             ("default", registry.resolve(models))]
    return tables.append_all([frame.select(F.lit(how).alias("how"), *models.columns) for how, frame in found])
