"""Sales preparation and many-series queries."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from quern.operators import panel, trials
from quern.plans import standins as st
from quern.plans.registry import query, sql_uniform

SALES = f"WITH {st.SALES_SQL}"
DAILY = f"WITH {st.DAILY_SQL}"


@query("melt_wide", f"""
{SALES} SELECT store_id, d, count(*) AS rows, sum(sale_quantity) AS quantity FROM sales_long GROUP BY ALL""")
def melt_wide(spark, sf):
    return st.sales_long(spark, sf).groupBy("store_id", "d").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("sale_quantity").alias("quantity"))


@query("left_join_calendar", f"""
{SALES} SELECT store_id, c.date_time, c.wm_yr_wk, count(*) AS rows, sum(sale_quantity) AS quantity
FROM sales_long s LEFT JOIN (SELECT * FROM calendar WHERE md5(d) >= '4') c ON s.d = c.d GROUP BY ALL""")
def left_join_calendar(spark, sf):
    dated = panel.attach_calendar(st.sales_long(spark, sf), st.calendar(spark, sf, gaps=True), "d")
    return dated.groupBy("store_id", "date_time", "wm_yr_wk").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("sale_quantity").alias("quantity"))


@query("left_join_price", f"""
{SALES} SELECT s.item_id, s.store_id, s.d, p.sell_price, s.sale_quantity
FROM sales_long s LEFT JOIN calendar c ON s.d = c.d
LEFT JOIN prices p ON p.wm_yr_wk = c.wm_yr_wk AND p.item_id = s.item_id AND p.store_id = s.store_id
WHERE sale_quantity > 0""")
def left_join_price(spark, sf):
    dated = panel.attach_calendar(st.sales_long(spark, sf), st.calendar(spark, sf), "d")
    priced = panel.attach_price(dated, st.prices(spark, sf), ["wm_yr_wk", "item_id", "store_id"])
    return panel.keep_sold(priced).select("item_id", "store_id", "d", "sell_price", "sale_quantity")


@query("filter_positive_qty", f"""
{SALES} SELECT item_id, store_id, d, sale_quantity FROM sales_long WHERE sale_quantity > 0""")
def filter_positive_qty(spark, sf):
    return panel.keep_sold(st.sales_long(spark, sf)).select("item_id", "store_id", "d", "sale_quantity")


NUMBERED_COLUMNS = "item_num, state_id, store_id, cat_id, dept_id, item_id"


@query("number_series", f"""
{SALES} SELECT {NUMBERED_COLUMNS}, count(*) AS rows, sum(sale_quantity) AS quantity FROM sales_numbered GROUP BY ALL""")
def number_series(spark, sf):
    sold = panel.keep_sold(st.sales_long(spark, sf))
    return panel.number_series(sold, st.SERIES_ORDER).groupBy("item_num", *st.SERIES_ORDER).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("sale_quantity").alias("quantity"))


@query("first_series", f"""
{SALES} SELECT {NUMBERED_COLUMNS}, date_time, sale_quantity FROM sales_numbered WHERE item_num <= 600""")
def first_series(spark, sf):
    kept = panel.first_n(panel.number_series(st.sales_clean(spark, sf), st.SERIES_ORDER), 600)
    return kept.select("item_num", *st.SERIES_ORDER, "date_time", "sale_quantity")


@query("assign_model", f"""
{SALES} SELECT item_num, model_num, date_time, sell_price, sale_quantity, round(y, 4) AS y FROM sales_panel""")
def assign_model(spark, sf):
    return st.sales_panel(spark, sf).select("item_num", "model_num", "date_time", "sell_price", "sale_quantity",
                                            F.round("y", 4).alias("y"))


@query("panel_stats", f"""
{SALES} SELECT model_num, count(y) AS num_datapoints, min(date_time) AS first_ds, max(date_time) AS last_ds
FROM sales_panel GROUP BY 1""")
def panel_stats(spark, sf):
    frame = panel.to_long_frame(st.sales_panel(spark, sf), keep=["model_num"])
    return panel.group_stats(frame, "model_num")


@query("group_model_count", f"""
{SALES} SELECT max(model_num) AS num_models, 9::BIGINT AS trials_per_model, max(model_num) * 3 AS total_concurrent_trials
FROM sales_panel""")
def group_model_count(spark, sf):
    return panel.model_count(st.sales_panel(spark, sf), concurrent=3, batches=3)


TREND_SQL = f"""
{SALES}, cut AS (SELECT model_num, max(date_time) - 7 AS cutoff, min(date_time) AS first_ds FROM sales_panel GROUP BY 1),
timed AS (SELECT p.model_num, p.y, datediff('day', first_ds, date_time) AS t, date_time < cutoff AS train
  FROM sales_panel p JOIN cut USING (model_num)),
line AS (SELECT model_num, regr_slope(y, t) AS slope, regr_intercept(y, t) AS intercept FROM timed WHERE train GROUP BY 1)
SELECT model_num, count(y) AS num_datapoints, round(max(slope), 4) AS slope,
  coalesce(round(sqrt(avg(CASE WHEN NOT train THEN pow(coalesce(y, 0) - coalesce(intercept + slope * t, 0), 2) END)), 2), 1000) AS "RMSE"
FROM timed LEFT JOIN line USING (model_num) GROUP BY 1"""


@query("trend_forecast_rmse", TREND_SQL)
def trend_forecast_rmse(spark, sf):
    """Unpivot, two left joins, filter, number, bucket, temporal split, line per model, test error."""
    frame = panel.to_long_frame(st.sales_panel(spark, sf), keep=["model_num"])
    out = panel.trend_forecast(frame)
    return out.withColumns({"slope": F.round("slope", 4), "RMSE": F.round("RMSE", 2)})


@query("temporal_split", f"""
{DAILY}, cut AS (SELECT model_num, max(ds) - 7 AS cutoff FROM daily GROUP BY 1)
SELECT model_num, "ID", ds, y, cutoff, CASE WHEN ds < cutoff THEN 'train' ELSE 'test' END AS split
FROM daily JOIN cut USING (model_num)""")
def temporal_split(spark, sf):
    return panel.temporal_split(st.daily_panel(spark, sf), "model_num")


@query("trailing_context", f"""
{DAILY}, last AS (SELECT model_num, max(ds) AS m FROM daily GROUP BY 1)
SELECT model_num, "ID", ds, y FROM daily JOIN last USING (model_num) WHERE ds >= m - 360""")
def trailing_context(spark, sf):
    return panel.context(st.daily_panel(spark, sf), "model_num").select("model_num", "ID", "ds", "y")


@query("panel_lags", f"""
{DAILY} SELECT "ID", ds, y, lag(y, 1) OVER w AS lag_1, lag(y, 2) OVER w AS lag_2, lag(y, 3) OVER w AS lag_3
FROM daily WINDOW w AS (PARTITION BY "ID" ORDER BY ds)""")
def panel_lags(spark, sf):
    return panel.add_lags(st.daily_panel(spark, sf), ["ID"], value="y").drop("model_num")


REGULAR_SQL = f"""
{DAILY}, span AS (SELECT model_num, "ID", min(ds) AS a, max(ds) AS b FROM daily GROUP BY ALL),
grid AS (SELECT model_num, "ID", CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS ds FROM span),
full_grid AS (SELECT g.model_num, g."ID", g.ds, d.y FROM grid g LEFT JOIN daily d ON d."ID" = g."ID" AND d.ds = g.ds),
near AS (SELECT *,
  last_value(y IGNORE NULLS) OVER p AS yp, last_value(CASE WHEN y IS NOT NULL THEN ds END IGNORE NULLS) OVER p AS dp,
  first_value(y IGNORE NULLS) OVER f AS yn, first_value(CASE WHEN y IS NOT NULL THEN ds END IGNORE NULLS) OVER f AS dn
  FROM full_grid WINDOW p AS (PARTITION BY "ID" ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  f AS (PARTITION BY "ID" ORDER BY ds ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
lined AS (SELECT *, CASE WHEN y IS NOT NULL THEN y
  WHEN datediff('day', dp, ds) <= 10 OR datediff('day', ds, dn) <= 10
  THEN yp + (yn - yp) * datediff('day', dp, ds) / datediff('day', dp, dn) END AS line FROM near),
regular AS (SELECT model_num, "ID", ds, y, coalesce(line, CASE WHEN count(line) OVER w >= 20 THEN avg(line) OVER w END) AS y_filled
  FROM lined WINDOW w AS (PARTITION BY "ID" ORDER BY ds ROWS BETWEEN 510 PRECEDING AND 509 FOLLOWING))
"""


@query("panel_regularize", f"""
{REGULAR_SQL} SELECT "ID", CAST(date_trunc('month', ds) AS DATE) AS month, count(*) AS days, count(y) AS observed,
  count(y_filled) AS filled, round(sum(y_filled), 0) AS total FROM regular GROUP BY ALL""")
def panel_regularize(spark, sf):
    regular = panel.regularize(st.daily_panel(spark, sf), ["ID"])
    return regular.groupBy("ID", F.trunc("ds", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("days"), F.count("y").alias("observed"), F.count("y_filled").alias("filled"),
        F.round(F.sum("y_filled"), 0).alias("total"))


HINGES = range(1, panel.N_CHANGEPOINTS + 1)


@query("trend_basis", f"""
{DAILY}, cut AS (SELECT model_num, max(ds) - 7 AS cutoff FROM daily GROUP BY 1),
ranged AS (SELECT model_num, min(ds) AS a, max(ds) AS b FROM daily JOIN cut USING (model_num) WHERE ds < cutoff GROUP BY 1),
timed AS (SELECT "ID", ds, datediff('day', a, ds) / datediff('day', a, b) AS t FROM daily JOIN ranged USING (model_num))
SELECT "ID", ds, round(t, 9) AS t, {', '.join(f'round(greatest(t - 0.8 * {i} / 11, 0), 9) AS hinge_{i}' for i in HINGES)}
FROM timed""")
def trend_basis(spark, sf):
    basis = panel.trend_basis(st.daily_panel(spark, sf), "model_num")
    return basis.select("ID", "ds", F.round("t", 9).alias("t"), *[F.round(f"hinge_{i}", 9).alias(f"hinge_{i}") for i in HINGES])


@query("recency_weight", f"""
{DAILY}, span AS (SELECT model_num, min(ds) AS a, max(ds) AS b FROM daily GROUP BY 1)
SELECT "ID", ds, y, round(1 + 3.0::DOUBLE * datediff('day', a, ds) / datediff('day', a, b), 9) AS sample_weight
FROM daily JOIN span USING (model_num)""")
def recency_weight(spark, sf):
    weighted = panel.recency_weight(st.daily_panel(spark, sf), "model_num", newest=4)
    return weighted.select("ID", "ds", "y", F.round("sample_weight", 9).alias("sample_weight"))


@query("fit_groups")
def fit_groups(spark, sf):
    return panel.fit_groups(st.daily_panel(spark, sf))


@query("group_trials")
def group_trials(spark, sf):
    return panel.group_trials(panel.moments(panel.design(st.daily_panel(spark, sf))))


def _line(part: pd.DataFrame) -> pd.DataFrame:
    days = (pd.to_datetime(part["ds"]) - pd.Timestamp("1995-01-01")).dt.days.to_numpy(float)
    slope = np.polyfit(days - days.mean(), part["y"].to_numpy(float), 1)[0] if len(part) > 1 else 0.0
    return pd.DataFrame({"ID": [part["ID"].iloc[0]], "rows": [len(part)], "first_y": [part["y"].iloc[0]],
                         "last_y": [part["y"].iloc[-1]], "slope": [round(float(slope), 2)]})


@query("map_groups", f"""
{DAILY} SELECT "ID", count(*) AS rows, arg_min(y, ds) AS first_y, arg_max(y, ds) AS last_y,
  round(coalesce(regr_slope(y, datediff('day', DATE '1995-01-01', ds)), 0), 2) AS slope FROM daily GROUP BY 1""")
def map_groups(spark, sf):
    """A pandas function per series, rows in date order."""
    return panel.map_groups(st.daily_panel(spark, sf), "ID", _line,
                            "ID int, rows bigint, first_y double, last_y double, slope double", order=["ds"])


SAMPLES = 9


def _sums(rows: pd.DataFrame) -> np.ndarray:
    """Per sample of the rows: count, sums of x, y, x * x and x * y."""
    x, y = rows["l_quantity"].to_numpy(float), rows["l_extendedprice"].to_numpy(float)
    terms, sample = (np.ones(len(x)), x, y, x * x, x * y), rows["l_orderkey"].to_numpy() % SAMPLES
    return np.stack([np.bincount(sample, t, SAMPLES) for t in terms], axis=1)


def _median_slope(sums: np.ndarray) -> dict:
    n, x, y, xx, xy = sums.T
    slopes = (n * xy - x * y) / (n * xx - x * x)
    return {"rows": int(n.sum()), "slope": round(float(np.median(slopes)), 4), "spread": round(float(np.ptp(slopes)), 4)}


@query("fold_groups", f"""
WITH samples AS (
  SELECT l_returnflag, l_orderkey % {SAMPLES} AS sample, count(*) AS n, regr_slope(l_extendedprice, l_quantity) AS slope
  FROM lineitem GROUP BY 1, 2)
SELECT l_returnflag, CAST(sum(n) AS BIGINT) AS rows, round(median(slope), 4) AS slope,
       round(max(slope) - min(slope), 4) AS spread FROM samples GROUP BY 1""")
def fold_groups(spark, sf):
    """A line that outliers can't move far: the median of the slopes of nine samples, three hot groups."""
    lines = st.load(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", F.col("l_quantity").cast("double"),
                                                  F.col("l_extendedprice").cast("double"))
    return panel.fold_groups(lines, "l_returnflag", lambda: np.zeros((SAMPLES, 5)), lambda state, rows: state + _sums(rows),
                             np.add, _median_slope, "rows bigint, slope double, spread double")


@query("guided_trials")
def guided_trials(spark, sf):
    """Twelve trials per model, the last four suggested from the log; the best of each model."""
    log = panel.guided_trials(panel.moments(panel.design(st.daily_panel(spark, sf))))
    return trials.best(log, "loss", "min", groups=["model_num"])


TREND_TRIALS_SQL = f"""
{SALES}, cut AS (SELECT model_num, max(date_time) - 7 AS cutoff, min(date_time) AS first_ds FROM sales_panel GROUP BY 1),
timed AS (SELECT p.model_num, p.y, datediff('day', first_ds, date_time)::DOUBLE AS t, date_time < cutoff AS train
  FROM sales_panel p JOIN cut USING (model_num)),
aged AS (SELECT *, t / max(CASE WHEN train THEN t END) OVER (PARTITION BY model_num) AS age FROM timed),
tried AS (SELECT model_num, trial, 1 + {sql_uniform(2025, "model_num || '-' || trial", "newer_samples_weight")} * 6 AS newest
  FROM (SELECT DISTINCT model_num FROM timed), range(9) r(trial)),
weighted AS (SELECT a.*, trial, newest, 1 + (newest - 1) * age AS w FROM aged a JOIN tried USING (model_num)),
sums AS (SELECT model_num, trial, sum(w) AS w, sum(w * t) AS wt, sum(w * t * t) AS wtt, sum(w * y) AS wy, sum(w * t * y) AS wty
  FROM weighted WHERE train AND y IS NOT NULL GROUP BY 1, 2),
lines AS (SELECT *, (w * wty - wt * wy) / (w * wtt - wt * wt) AS slope FROM sums),
scored AS (SELECT x.model_num, x.trial, any_value(newest) AS newest, any_value(slope) AS slope,
  sqrt(avg(pow(coalesce(y, 0) - ((wy - slope * wt) / l.w + slope * t), 2))) AS rmse
  FROM weighted x JOIN lines l USING (model_num, trial) WHERE NOT train GROUP BY 1, 2)"""


@query("trend_trials", f"""{TREND_TRIALS_SQL}
SELECT model_num, CAST(trial AS INTEGER) AS trial, round(newest, 6) AS newer_samples_weight, round(slope, 4) AS slope,
  round(rmse, 2) AS "RMSE" FROM scored""")
def trend_trials(spark, sf):
    frame = panel.to_long_frame(st.sales_panel(spark, sf), keep=["model_num"])
    out = panel.trend_trials(frame)
    return out.withColumns({"newer_samples_weight": F.round("newer_samples_weight", 6), "slope": F.round("slope", 4),
                            "RMSE": F.round("RMSE", 2)})


@query("trend_search_best", f"""{TREND_TRIALS_SQL}
SELECT model_num, CAST(trial AS INTEGER) AS trial, round(newest, 6) AS newer_samples_weight, round(rmse, 2) AS "RMSE" FROM scored
QUALIFY row_number() OVER (PARTITION BY model_num ORDER BY round(rmse, 2), trial) = 1""")
def trend_search_best(spark, sf):
    """The best of nine weighted fits of every model group."""
    found = trials.best(trend_trials(spark, sf), "RMSE", "min", groups=["model_num"])
    return found.select("model_num", "trial", "newer_samples_weight", "RMSE")
