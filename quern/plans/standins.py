"""Inputs of the named queries, derived from the given tables, each with its SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators import panel
from quern.sources.tables import load

IDS = ["item_id", "dept_id", "cat_id", "store_id", "state_id"]
SERIES_ORDER = ["state_id", "store_id", "cat_id", "dept_id", "item_id"]
POSITIVE, NEGATIVE = ">50K", "<=50K"


# --- sales: one quantity column per quarter, a calendar of quarters, partial prices ------------------

def _sales(spark: SparkSession, sf: str) -> DataFrame:
    lines = load(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    parts = load(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type", "p_retailprice")
    stores = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    return lines.join(parts, "l_partkey").join(stores, "l_suppkey").select(
        F.concat_ws("_", "p_brand", "p_type").alias("item_id"), F.col("p_type").alias("dept_id"),
        F.col("p_brand").alias("cat_id"), F.col("l_suppkey").alias("store_id"), F.col("s_nationkey").alias("state_id"),
        F.concat(F.year("l_shipdate"), F.lit("Q"), F.quarter("l_shipdate")).alias("d"),
        (F.year("l_shipdate") * 100 + F.quarter("l_shipdate")).alias("wm_yr_wk"),
        F.to_date(F.date_trunc("quarter", "l_shipdate")).alias("date_time"), "l_quantity", "p_retailprice")


def sales_wide(spark: SparkSession, sf: str) -> DataFrame:
    """One column per label of the calendar; the labels (one per quarter) are read first, as a wide file has them."""
    labels = [r["d"] for r in calendar(spark, sf).select("d").sort("d").collect()]
    # what pivot does, in one aggregation in place of two: the rows are moved once
    wide = _sales(spark, sf).groupBy(*IDS).agg(
        *[F.sum(F.when(F.col("d") == label, F.col("l_quantity"))).alias(label) for label in labels])
    return wide.fillna(0.0, labels)


def calendar(spark: SparkSession, sf: str, gaps: bool = False) -> DataFrame:
    lines = load(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("l_shipdate")).distinct()  # few days
    out = lines.select(
        F.concat(F.year("l_shipdate"), F.lit("Q"), F.quarter("l_shipdate")).alias("d"),
        (F.year("l_shipdate") * 100 + F.quarter("l_shipdate")).alias("wm_yr_wk"),
        F.to_date(F.date_trunc("quarter", "l_shipdate")).alias("date_time")).distinct()
    return out.where(F.md5("d") >= "4") if gaps else out


def prices(spark: SparkSession, sf: str) -> DataFrame:
    """About three quarters of the (store, item, week) combinations have a price."""
    some = _sales(spark, sf).groupBy("store_id", "item_id", "wm_yr_wk").agg(F.max("p_retailprice").alias("sell_price"))
    return some.where(F.md5(F.concat_ws("-", F.col("store_id").cast("string"), "item_id",
                                        F.col("wm_yr_wk").cast("string"))) < "c")


def sales_long(spark: SparkSession, sf: str) -> DataFrame:
    return panel.melt(sales_wide(spark, sf), IDS, "d", "sale_quantity")


def sales_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Unpivot, calendar, price, sold rows only."""
    dated = panel.attach_calendar(sales_long(spark, sf), calendar(spark, sf), "d")
    priced = panel.attach_price(dated, prices(spark, sf), ["wm_yr_wk", "item_id", "store_id"])
    return panel.keep_sold(priced).select(*IDS, "date_time", "sell_price", "sale_quantity")


def sales_panel(spark: SparkSession, sf: str) -> DataFrame:
    numbered = panel.number_series(sales_clean(spark, sf), SERIES_ORDER)
    return panel.add_revenue(panel.assign_model(numbered))


SALES_SQL = """
sales AS (
  SELECT p_brand || '_' || p_type AS item_id, p_type AS dept_id, p_brand AS cat_id, l_suppkey AS store_id,
         s_nationkey AS state_id, CAST(year(l_shipdate) AS VARCHAR) || 'Q' || CAST(quarter(l_shipdate) AS VARCHAR) AS d,
         CAST(year(l_shipdate) * 100 + quarter(l_shipdate) AS INTEGER) AS wm_yr_wk,
         CAST(date_trunc('quarter', l_shipdate) AS DATE) AS date_time, l_quantity, p_retailprice
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey),
calendar AS (SELECT DISTINCT d, wm_yr_wk, date_time FROM sales),
labels_d AS (SELECT DISTINCT d FROM calendar),
series AS (SELECT DISTINCT item_id, dept_id, cat_id, store_id, state_id FROM sales),
bought AS (SELECT item_id, store_id, d, sum(l_quantity) AS q FROM sales GROUP BY ALL),
sales_long AS (
  SELECT s.*, l.d, coalesce(b.q, 0) AS sale_quantity FROM series s CROSS JOIN labels_d l
  LEFT JOIN bought b ON b.item_id = s.item_id AND b.store_id = s.store_id AND b.d = l.d),
prices AS (
  SELECT store_id, item_id, wm_yr_wk, max(p_retailprice) AS sell_price FROM sales
  GROUP BY ALL HAVING md5(store_id || '-' || item_id || '-' || wm_yr_wk) < 'c'),
sales_clean AS (
  SELECT s.item_id, s.dept_id, s.cat_id, s.store_id, s.state_id, c.date_time, p.sell_price, s.sale_quantity
  FROM sales_long s LEFT JOIN calendar c ON s.d = c.d
  LEFT JOIN prices p ON p.wm_yr_wk = c.wm_yr_wk AND p.item_id = s.item_id AND p.store_id = s.store_id
  WHERE s.sale_quantity > 0),
sales_numbered AS (
  SELECT *, CAST(dense_rank() OVER (ORDER BY state_id, store_id, cat_id, dept_id, item_id) AS INTEGER) AS item_num
  FROM sales_clean),
sales_panel AS (
  SELECT *, CAST(ceil(item_num / 100.0) AS BIGINT) AS model_num, sell_price * sale_quantity AS y FROM sales_numbered)
"""


# --- daily panel: one series per (supplier, return flag) --------------------------------------------

def daily_panel(spark: SparkSession, sf: str) -> DataFrame:
    """``model_num, ID, ds, y``, unique per (ID, ds)."""
    lines = load(spark, sf, "lineitem").select(
        "l_suppkey", "l_returnflag", F.to_date("l_shipdate").alias("ds"),
        (F.col("l_extendedprice") * F.col("l_quantity")).alias("y"))
    days = panel.daily(lines, ["l_suppkey", "l_returnflag"]).withColumn("y", F.round("y", 2))
    numbered = panel.assign_model(panel.number_series(days, ["l_suppkey", "l_returnflag"]))
    return numbered.select("model_num", F.col("item_num").alias("ID"), "ds", "y")


DAILY_SQL = """
days AS (
  SELECT l_suppkey, l_returnflag, CAST(l_shipdate AS DATE) AS ds, round(sum(l_extendedprice * l_quantity), 2) AS y
  FROM lineitem GROUP BY ALL),
numbered AS (
  SELECT CAST(dense_rank() OVER (ORDER BY l_suppkey, l_returnflag) AS INTEGER) AS "ID", ds, y FROM days),
daily AS (SELECT CAST(ceil("ID" / 100.0) AS BIGINT) AS model_num, "ID", ds, y FROM numbered)
"""


# --- labelled rows ----------------------------------------------------------------------------------

STRINGS = ["l_returnflag", "l_linestatus"]
NUMBERS = ["l_quantity", "l_extendedprice", "l_discount"]


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with a constructed two-class label."""
    lines = load(spark, sf, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *STRINGS, *NUMBERS).withColumn(
        "income", F.when(F.col("l_quantity") * F.col("l_extendedprice") > 1000000, POSITIVE).otherwise(NEGATIVE))


def holed(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with missing values in every feature."""
    rows = labelled(spark, sf)
    line = F.col("l_linenumber")
    return rows.withColumns({
        "l_returnflag": F.when(line != 1, F.col("l_returnflag")), "l_linestatus": F.when(line != 2, F.col("l_linestatus")),
        "l_quantity": F.when(line != 3, F.col("l_quantity")), "l_discount": F.when(line != 4, F.col("l_discount"))})


HOLED_SQL = """
holed AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CASE WHEN l_linenumber <> 1 THEN l_returnflag END AS l_returnflag,
         CASE WHEN l_linenumber <> 2 THEN l_linestatus END AS l_linestatus,
         CASE WHEN l_linenumber <> 3 THEN l_quantity END AS l_quantity, l_extendedprice,
         CASE WHEN l_linenumber <> 4 THEN l_discount END AS l_discount,
         CASE WHEN l_quantity * l_extendedprice > 1000000 THEN '>50K' ELSE '<=50K' END AS income
  FROM lineitem)
"""


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled lines with a hand-made score, probability and predicted class."""
    rows = labelled(spark, sf).withColumn("score", F.col("l_quantity") * 2000 + F.col("l_extendedprice"))
    chance = 1 / (1 + F.exp(-(F.col("score") - 105000) / 20000))
    return rows.withColumn("probability", chance).withColumn(
        "predicted", F.when(F.col("score") > 105000, POSITIVE).otherwise(NEGATIVE))


SCORED_SQL = """
labelled AS (
  SELECT *, CASE WHEN l_quantity * l_extendedprice > 1000000 THEN '>50K' ELSE '<=50K' END AS income,
         l_quantity * 2000 + l_extendedprice AS score FROM lineitem),
scored AS (
  SELECT *, 1 / (1 + exp(-(score - 105000) / 20000)) AS probability,
         CASE WHEN score > 105000 THEN '>50K' ELSE '<=50K' END AS predicted FROM labelled)
"""


# --- trial log --------------------------------------------------------------------------------------

def event_log(spark: SparkSession, sf: str) -> DataFrame:
    """Events as reports: ``trial`` = user, ``metric`` = value."""
    return load(spark, sf, "events").select(
        F.col("user_id").alias("trial"), "event_id", "ts", "event_type", F.col("value").alias("metric"))
