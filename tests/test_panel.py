import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quern.operators import panel, trials
from quern.plans import standins
from quern.sources import tables

DAY = datetime.date(2020, 1, 1)


def day(i):
    return DAY + datetime.timedelta(days=int(i))


@pytest.fixture(scope="module")
def sales(spark, tmp_path_factory):
    """3 items x 2 stores x 10 days as CSV; one missing price, one series without sales."""
    home = tmp_path_factory.mktemp("sales")
    days = [f"d_{i}" for i in range(1, 11)]
    lines = ["id,item_id,dept_id,cat_id,store_id,state_id," + ",".join(days)]
    for item in range(3):
        for store in range(2):
            sold = [0 if (item, store) == (2, 1) else (i * (item + 1) + store) % 4 for i in range(10)]
            lines.append(f"i{item}s{store},i{item},D,C,s{store},S," + ",".join(map(str, sold)))
    (home / "sales.csv").write_text("\n".join(lines))
    (home / "calendar.csv").write_text("d,wm_yr_wk,date\n" + "\n".join(
        f"d_{i + 1},{1 + i // 7},{day(i)}" for i in range(10)))
    (home / "prices.csv").write_text("store_id,item_id,wm_yr_wk,sell_price\n" + "\n".join(
        f"s{s},i{i},{w},{i + w + 0.5}" for s in range(2) for i in range(3) for w in (1, 2) if (s, i, w) != (0, 0, 2)))
    return {n: tables.read_csv_typed(spark, str(home / f"{n}.csv")) for n in ("sales", "calendar", "prices")}


def test_sales_preparation(sales):
    ids = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]
    long = panel.melt(sales["sales"], ids, "d", "sale_quantity")
    assert long.count() == 60
    calendar = sales["calendar"].withColumnRenamed("date", "date_time").select("d", "wm_yr_wk", "date_time")
    priced = panel.attach_price(panel.attach_calendar(long, calendar, "d"), sales["prices"], ["wm_yr_wk", "item_id", "store_id"])
    assert priced.count() == 60 and priced.where("sell_price IS NULL").count() == 3
    sold = panel.keep_sold(priced)
    numbered = panel.add_revenue(panel.assign_model(
        panel.number_series(sold, ["state_id", "store_id", "cat_id", "dept_id", "item_id"]), 2))
    rows = numbered.collect()
    assert {(r["store_id"], r["item_id"]): r["item_num"] for r in rows} == {
        ("s0", "i0"): 1, ("s0", "i1"): 2, ("s0", "i2"): 3, ("s1", "i0"): 4, ("s1", "i1"): 5}
    assert all(r["model_num"] == (r["item_num"] + 1) // 2 for r in rows)
    assert any(r["y"] is None for r in rows)
    assert all(r["y"] == float(r["sell_price"]) * int(r["sale_quantity"]) for r in rows if r["y"] is not None)
    assert panel.first_n(numbered, 2).select("item_num").distinct().count() == 2
    assert panel.to_long_frame(numbered).columns == ["ID", "ds", "y"]


def test_split_is_per_group(spark):
    rows = [(1, 1, day(i), 1.0) for i in range(10)] + [(1, 2, day(i), 1.0) for i in range(20)] + [(2, 3, day(i), 1.0) for i in range(9)]
    df = spark.createDataFrame(rows, "model_num bigint, ID int, ds date, y double")
    out = panel.temporal_split(df, "model_num").collect()
    assert all((r["split"] == "train") == (r["ds"] < (day(12) if r["model_num"] == 1 else day(1))) for r in out)
    kept = panel.context(df, "model_num", 5).collect()
    assert len(kept) == 6 + 6 and all(r["ID"] != 1 for r in kept)


def pandas_filled(y, linear, rolling):
    """The two steps on a regular daily series."""
    s = pd.Series(y, dtype=float)
    line = s.interpolate(method="linear", limit=linear, limit_direction="both")
    mean = line.rolling(rolling + 2 * linear, min_periods=2 * linear, center=True).mean()
    return line.where(line.notna(), mean)


@pytest.mark.parametrize("linear,rolling", [(1, 6), (2, 8), (3, 5), (10, 1000)])
def test_regularize_matches_pandas(spark, linear, rolling):
    rnd = np.random.default_rng(linear)
    rows, wanted = [], {}
    for series in range(6):
        n = 80
        y = np.where(rnd.random(n) < 0.35, rnd.normal(10, 3, n), np.nan)
        keep = ~np.isnan(y) | (rnd.random(n) < 0.3)  # some days are present without a value
        keep[[0, -1]] = True
        rows += [(series, day(i), None if np.isnan(y[i]) else float(y[i])) for i in range(n) if keep[i]]
        wanted[series] = pandas_filled(y, linear, rolling)
    df = spark.createDataFrame(rows, "ID int, ds date, y double")
    got = panel.regularize(df, ["ID"], linear, rolling).orderBy("ID", "ds").toPandas()
    for series, want in wanted.items():
        mine = got[got["ID"] == series]
        assert list(mine["ds"]) == [day(i) for i in range(80)]
        np.testing.assert_allclose(mine["y_filled"].to_numpy(float), want.to_numpy(), rtol=1e-9)
    dropped = panel.regularize(df, ["ID"], linear, rolling, drop_missing=True).count()
    assert dropped == sum(int(w.notna().sum()) for w in wanted.values())


def test_regularize_series_without_values(spark):
    df = spark.createDataFrame([(1, day(0), None), (1, day(3), None)], "ID int, ds date, y double")
    assert panel.regularize(df, ["ID"]).count() == 4
    assert panel.regularize(df, ["ID"], drop_missing=True).count() == 0


def test_regular_days_and_lags_are_made_where_the_series_is(spark):
    """One shuffle, no sort of the long rows; the lags are those of ``add_lags``."""
    rows = [(s, 7 * s, day(i), None if i % 4 == 1 else float(i * s)) for s in range(1, 4) for i in range(0, 60, s + 2)]
    df = spark.createDataFrame(rows, "ID int, rank int, ds date, y double")
    got = panel.regularize(df, ["ID"], 1, 4, lags=2, keep=["rank"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Generate" not in plan
    want = panel.add_lags(panel.regularize(df, ["ID"], 1, 4), ["ID"], 2).orderBy("ID", "ds").collect()
    out = got.orderBy("ID", "ds").collect()
    assert [(r.ID, r.ds, r.y, r.y_filled, r.lag_1, r.lag_2) for r in out] == [tuple(r) for r in want]
    assert all(r["rank"] == 7 * r.ID for r in out) and any(r.y_filled is None for r in out)


def test_lags_trend_and_weights(spark):
    df = spark.createDataFrame([(1, 1, day(i), float(i)) for i in range(21)], "model_num bigint, ID int, ds date, y double")
    lagged = {r["ds"]: r for r in panel.add_lags(df, ["ID"], value="y").collect()}
    assert lagged[day(5)]["lag_3"] == 2.0 and lagged[day(1)]["lag_2"] is None
    basis = {r["ds"]: r for r in panel.trend_basis(df, "model_num", n=3).collect()}
    assert basis[day(0)]["t"] == 0.0 and basis[day(12)]["t"] == 1.0 and basis[day(20)]["t"] > 1.0
    assert [basis[day(12)][f"hinge_{i}"] for i in (1, 2, 3)] == pytest.approx([0.8, 0.6, 0.4])
    weights = {r["ds"]: r["sample_weight"] for r in panel.recency_weight(df, "model_num", 3).collect()}
    assert weights[day(0)] == 1.0 and weights[day(10)] == 2.0 and weights[day(20)] == 3.0


def make_panel(spark):
    rnd = np.random.default_rng(3)
    rows = []
    for series in range(1, 7):
        level = 20.0 + 5 * series
        for i in range(90):
            level += rnd.normal(0.1, 1.0)
            if rnd.random() < 0.9 or i in (0, 89):
                rows.append((1 + (series - 1) // 3, series, day(i), None if rnd.random() < 0.05 else float(level)))
    return spark.createDataFrame(rows, "model_num bigint, ID int, ds date, y double")


def test_search_equals_direct_least_squares(spark):
    """The trial errors from summed cross products equal fits on the full rows of each model."""
    frame = make_panel(spark)
    design = panel.design(frame)
    log = panel.group_trials(panel.moments(design.repartition(5)), n_trials=4).collect()
    assert len(log) == 8
    rows = design.toPandas()
    knots = np.asarray(panel.changepoints())
    for r in log:
        part = rows[rows["model_num"] == r["model_num"]]
        lags = int(r["ar_lags"])
        t = part["t"].to_numpy(float)
        x = np.column_stack([np.ones(len(t)), t, np.maximum(t[:, None] - knots, 0),
                             part[[f"lag_{k}" for k in (1, 2, 3)]].to_numpy(float) / part["scale"].iloc[0]])
        whole = ~np.isnan(x).any(axis=1)
        x = x[:, :12 + lags]
        y, target = (part[c].to_numpy(float) / part["scale"].iloc[0] for c in ("y_filled", "y"))
        fit = part["train"].to_numpy(bool) & whole
        w = 1 + (r["newer_samples_weight"] - 1) * np.clip(t[fit], 0, 1)
        gram = (x[fit] * w[:, None]).T @ x[fit]
        size = np.sqrt(np.maximum(np.diag(gram), 1e-12))
        beta = np.linalg.solve(gram / np.outer(size, size) + r["ridge"] * np.eye(len(size)),
                               ((x[fit] * w[:, None]).T @ y[fit]) / size) / size
        test = ~part["train"].to_numpy(bool)
        guess = np.where(whole[test], np.nan_to_num(x[test]) @ beta, 0.0)
        want = part["scale"].iloc[0] * np.sqrt(np.mean((np.nan_to_num(target[test]) - guess) ** 2))
        assert r["RMSE"] == pytest.approx(want, rel=1e-6)
    best = {r["model_num"]: r for r in panel.fit_groups(frame, n_trials=4).collect()}
    points = {r["model_num"]: r["num_datapoints"] for r in panel.group_stats(frame, "model_num").collect()}
    for model, r in best.items():
        assert r["RMSE"] == pytest.approx(min(t["RMSE"] for t in log if t["model_num"] == model))
        assert r["num_datapoints"] == points[model] and "ridge" in r["space"]


def test_trend_forecast_on_rows(spark):
    frame = make_panel(spark)
    rows = frame.toPandas()
    for r in panel.trend_forecast(frame).collect():
        part = rows[rows["model_num"] == r["model_num"]]
        t = np.array([(d - DAY).days for d in part["ds"]], float)
        y = part["y"].to_numpy(float)
        train = t < t.max() - 7
        seen = train & ~np.isnan(y)
        slope, intercept = np.polyfit(t[seen], y[seen], 1)
        error = np.nan_to_num(y[~train]) - (intercept + slope * t[~train])
        assert r["slope"] == pytest.approx(slope) and r["RMSE"] == pytest.approx(np.sqrt(np.mean(error ** 2)))


def test_weighted_trends_on_rows(spark):
    frame = make_panel(spark)
    rows = frame.toPandas()
    log = panel.trend_trials(frame, n_trials=3).collect()
    assert len(log) == 6
    for r in log:
        part = rows[rows["model_num"] == r["model_num"]]
        t = np.array([(d - DAY).days for d in part["ds"]], float)
        y = part["y"].to_numpy(float)
        train = t < t.max() - 7
        seen = train & ~np.isnan(y)
        w = 1 + (r["newer_samples_weight"] - 1) * t[seen] / t[train].max()
        slope, intercept = np.polyfit(t[seen], y[seen], 1, w=np.sqrt(w))
        error = np.nan_to_num(y[~train]) - (intercept + slope * t[~train])
        assert r["slope"] == pytest.approx(slope) and r["RMSE"] == pytest.approx(np.sqrt(np.mean(error ** 2)))


def test_group_without_history_gets_the_sentinel(spark):
    frame = spark.createDataFrame([(1, 1, day(0), None)], "model_num bigint, ID int, ds date, y double")
    row = panel.trend_forecast(frame).first()
    assert row["num_datapoints"] == 0 and row["RMSE"] == 0.0  # nothing predicted, nothing observed


def test_model_count(spark):
    frame = spark.createDataFrame([(1,), (6,)], "model_num bigint")
    assert tuple(panel.model_count(frame, 3, 3).first()) == (6, 9, 18)
    assert set(panel.SEARCH_SPACE) <= set(trials.sample(frame, "model_num", panel.SEARCH_SPACE, 2).columns)


def test_map_groups_sorts(spark):
    frame = spark.createDataFrame([(1, day(2), 3.0), (1, day(1), 2.0), (2, day(5), 1.0)], "g int, ds date, y double")

    def first(part):
        return pd.DataFrame({"g": [part["g"].iloc[0]], "y": [part["y"].iloc[0]]})

    out = panel.map_groups(frame, "g", first, "g int, y double", order=["ds"]).collect()
    assert sorted(map(tuple, out)) == [(1, 2.0), (2, 1.0)]


def test_fold_groups_merges_states_of_a_hot_group(spark):
    rows = spark.range(0, 20_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 50 == 1, F.concat(F.lit("k"), F.col("id") % 7)).otherwise("hot").alias("k"),
        (F.col("id") % 101).cast("double").alias("v"))
    want = {}
    for r in rows.collect():
        want.setdefault(r["k"], []).append(r["v"])

    def add(state, part):
        return (state[0] + len(part), max(state[1], part["v"].max()), state[2] | set(part["v"] % 10))

    def fold(frame, **options):
        return panel.fold_groups(frame, "k", lambda: (0, -1.0, frozenset()), add,
                                 lambda a, b: (a[0] + b[0], max(a[1], b[1]), a[2] | b[2]),
                                 lambda s: {"n": s[0], "top": s[1], "digits": len(s[2])}, "n bigint, top double, digits int", **options)

    for options in ({}, {"held": 1, "ways": 2}):
        got = {r["k"]: (r["n"], r["top"], r["digits"]) for r in fold(rows, **options).collect()}
        assert got == {k: (len(v), max(v), len({x % 10 for x in v})) for k, v in want.items()}
    assert fold(rows.limit(0)).count() == 0
    plan = fold(rows)._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" in plan and plan.index("MapInPandas") > plan.index("Exchange")


def test_price_join_keeps_nulls_and_columns(spark):
    rows = spark.createDataFrame([("i", 1, 5.0), ("i", None, 6.0), (None, 1, 7.0), ("j", 1, 8.0)], "item string, week int, q double")
    prices = spark.createDataFrame([("i", 1, 2.0), ("i", None, 3.0), (None, 1, 4.0), ("i", 1, 9.0)], "item string, week int, price double")
    out = panel.attach_price(rows, prices, ["week", "item"])
    assert out.columns == ["week", "item", "q", "price"]
    assert sorted((r.q, r.price or 0) for r in out.collect()) == [(5.0, 2.0), (5.0, 9.0), (6.0, 0), (7.0, 0), (8.0, 0)]
    assert "xxhash64" in out._jdf.queryExecution().optimizedPlan().toString()


def test_wide_sales_move_rows_once(spark, tmp_path):
    dates = [datetime.datetime(1995, 1, 2, 7), datetime.datetime(1995, 3, 31), datetime.datetime(1996, 12, 31), datetime.datetime(1996, 10, 1)]
    lines = [(k % 5, k % 3, None if k == 7 else float(k % 11), dates[k % 4]) for k in range(60)]
    for name, rows, schema in (
            ("lineitem", lines, "l_partkey long, l_suppkey long, l_quantity double, l_shipdate timestamp"),
            ("part", [(k, f"b{k % 2}", None if k == 4 else "t", 1.0 * k) for k in range(5)],
             "p_partkey long, p_brand string, p_type string, p_retailprice double"),
            ("supplier", [(0, 1), (1, None), (2, 1)], "s_suppkey long, s_nationkey int")):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert {tuple(r) for r in standins.calendar(spark, str(tmp_path)).collect()} == {
        ("1995Q1", 199501, datetime.date(1995, 1, 1)), ("1996Q4", 199604, datetime.date(1996, 10, 1))}
    labels = ["1995Q1", "1996Q4"]
    wide = standins.sales_wide(spark, str(tmp_path))
    given = standins._sales(spark, str(tmp_path)).groupBy(*standins.IDS).pivot("d", labels).agg(F.sum("l_quantity")).fillna(0.0, labels)
    assert given.columns == wide.columns == [*standins.IDS, *labels]
    assert sorted(map(str, given.collect())) == sorted(map(str, wide.collect()))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = standins.sales_wide(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count("Exchange hashpartitioning(item_id") == 1
