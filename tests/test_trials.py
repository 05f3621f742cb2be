import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.functions import hashing
from quern.operators import trials


def test_samplers_stay_in_range_and_reach_the_ends(spark):
    space = {"a": trials.uniform(2, 3), "b": trials.log_uniform(1e-3, 1e3), "c": trials.integer(3, 5),
             "d": trials.integer_below(3, 5), "e": trials.log_integer(1, 3), "f": trials.log_integer_below(1, 3),
             "g": trials.stepped(0.0, 1.0, 0.25), "h": trials.choice(["x", "y"]), "i": trials.power_of_two(2, 4),
             "j": trials.constant(7), "k": trials.choice([[64, 64], [128, 128]]), "m": trials.constant(["p", "q"])}
    rows = trials.random_search(spark, space, 1000).collect()
    values = {n: [r[n] for r in rows] for n in space}
    assert 2 <= min(values["a"]) and max(values["a"]) < 3
    logs = [math.log10(v) for v in values["b"]]
    assert min(logs) >= -3 and max(logs) < 3 and abs(sum(logs) / 1000) < 0.2
    assert set(values["c"]) == {3, 4, 5} and set(values["d"]) == {3, 4}
    assert set(values["e"]) == {1, 2, 3} and set(values["f"]) == {1, 2}
    assert set(values["g"]) == {0.0, 0.25, 0.5, 0.75, 1.0} and set(values["h"]) == {"x", "y"}
    assert set(values["i"]) == {4, 8} and set(values["j"]) == {7}
    assert {tuple(v) for v in values["k"]} == {(64, 64), (128, 128)} and values["m"][0] == ["p", "q"]
    again = trials.random_search(spark, space, 1000).repartition(7).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_conditional_parameters(spark):
    for r in trials.random_search(spark, trials.CLASSIFIER_SPACE, 200).collect():
        assert (r["C"] is not None) == (r["classifier"] == "LogisticRegression")
        assert (r["forest_trees"] is not None) == (r["classifier"] == "RandomForest")
        assert (r["num_leaves"] is not None) == (r["classifier"] == "GradientBoosting")


def test_grid_has_every_combination(spark):
    out = trials.grid(spark.range(2), {"a": [1, 2, 3], "b": ["x", "y"]})
    rows = [(r["id"], r["trial"], r["a"], r["b"]) for r in out.collect()]
    assert len(set(rows)) == 12 and {(a, b) for _, _, a, b in rows} == {(a, b) for a in (1, 2, 3) for b in "xy"}
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_best_uses_the_last_report_and_breaks_ties(spark):
    log = spark.createDataFrame([(1, 1, 0.9), (1, 2, 0.1), (2, 1, 0.5), (3, 1, 0.5)], "trial int, iteration int, m double")
    last = trials.last_reports(log, ["trial"], "iteration", ["m"])
    assert trials.best(last, "m", "max").first()["trial"] == 2
    assert trials.best(last, "m", "min").first()["trial"] == 1
    nulls = last.withColumn("m", F.when(F.col("trial") != 2, F.col("m")))
    assert trials.best(nulls, "m", "max").first()["trial"] == 3


def test_elapsed(spark):
    log = spark.createDataFrame([("2024-01-01 00:00:00", 5.0), ("2024-01-01 00:01:00", 7.0)], "ts string, s double")
    row = trials.elapsed(log.withColumn("ts", F.to_timestamp("ts")), "ts", "s").first()
    assert row["elapsed_seconds"] == 67.0 and row["reports"] == 2


@pytest.mark.parametrize("mode", ["min", "max"])
@pytest.mark.parametrize("limit", [7, 1000])
def test_halving_against_a_loop(spark, mode, limit):
    rnd = np.random.default_rng(2)
    reports = [(t, i, float(rnd.integers(0, 20))) for t in range(23) for i in range(1, 1 + rnd.integers(1, 9))]
    log = spark.createDataFrame(reports, "trial int, iteration int, metric double")
    got = {(r["trial"], r["rung"]): (r["place"], r["kept"], r["alive"])
           for r in trials.halve(log, trials.rungs(1, 2, 8), mode=mode, max_task_rows=limit).collect()}
    alive = {}
    for rung in (1, 2, 4, 8):
        here = sorted(((m if mode == "min" else -m, t) for t, i, m in reports if i == rung))
        quota = max(1, len(here) // 2)
        for place, (_, t) in enumerate(here, 1):
            alive[t] = alive.get(t, True) and place <= quota
            assert got[(t, rung)] == (place, place <= quota, alive[t])


def test_rungs():
    assert trials.rungs(1, 2, 40) == [1, 2, 4, 8, 16, 32] and trials.rungs(5, 2, 20) == [5, 10, 20]


def test_suggest_against_a_loop(spark):
    rnd = np.random.default_rng(4)
    log = [("hot", i, float(x)) for i, x in enumerate(rnd.uniform(0, 10, 400))] + [("few", i, float(i)) for i in range(5)]
    df = spark.createDataFrame(log, "g string, trial int, x double").withColumn("loss", F.abs(F.col("x") - 4))
    ranked = trials.suggest(df, "g", "x", "loss", "trial", 0.0, 10.0).collect()
    few = sorted((r["place"], r["candidate"]) for r in ranked if r["g"] == "few")
    assert few == [(k + 1, k) for k in range(8)]
    hot = sorted((r for r in ranked if r["g"] == "hot"), key=lambda r: r["place"])
    assert len(hot) == 8
    xs = sorted((abs(x - 4), i, x) for g, i, x in log if g == "hot")
    good, bad = [x for _, _, x in xs[:25]], [x for _, _, x in xs[25:]]

    def density(c, data):
        h = 10.0 * len(data) ** -0.2 / 5
        kernels = sum(math.exp(-0.5 * ((c - x) / h) ** 2) / math.sqrt(2 * math.pi) for x in data)
        return (kernels / h + 0.1) / (len(data) + 1)

    for r in hot:
        want = math.log(density(r["value"], good)) - math.log(density(r["value"], bad))
        assert r["density"] == pytest.approx(want, rel=1e-9)
    assert [r["density"] for r in hot] == sorted((r["density"] for r in hot), reverse=True)
    assert abs(trials.next_trial(trials.suggest(df, "g", "x", "loss", "trial", 0.0, 10.0)).where("g = 'hot'").first()["value"] - 4) < 5


def test_reports_are_appended(spark):
    trials.append_reports(spark, "reports", [trials.report(0, 1, "loss", 0.5), trials.report(0, 2, "loss", 0.25, 1.5)])
    trials.append_reports(spark, "reports", [trials.report(1, 1, "loss", 0.75)])
    log = spark.table("reports")
    assert log.count() == 3
    assert trials.best(trials.last_reports(log, ["trial"], "iteration", ["value"]), "value", "min").first()["trial"] == 0
    spark.sql("DROP TABLE reports")


def test_nested_run_log(spark):
    tried = spark.createDataFrame([(0, "a", 0.5, 1.0), (1, "b", None, 2.0)], "trial bigint, kind string, c double, rmse double")
    parent = spark.createDataFrame([("p", None, "search")], "run_id string, parent_id string, run_name string")
    runs, params, metrics = trials.run_log(parent, tried, ["kind", "c"], ["rmse"], "p")
    assert sorted((r["run_id"], r["parent_id"]) for r in runs.collect()) == [("p", None), ("p-0", "p"), ("p-1", "p")]
    assert sorted(map(tuple, params.collect())) == [("p-0", "c", "0.5"), ("p-0", "kind", "a"), ("p-1", "kind", "b")]
    assert sorted(map(tuple, metrics.collect())) == [("p-0", "rmse", 1.0), ("p-1", "rmse", 2.0)]


def test_parallel_runs_keep_their_order():
    out = trials.run_distributed([{"x": i} for i in range(6)], lambda c: {"y": c["x"] ** 2}, width=3)
    assert [(r["trial"], r["x"], r["y"]) for r in out] == [(i, i, i * i) for i in range(6)]


def test_successive_halving_continues_survivors():
    calls = []

    def fit(config, budget, state):
        calls.append((config["x"], budget, state))
        return abs(config["x"] - 3) / budget, budget

    reports = trials.successive_halving([{"x": i} for i in range(8)], fit, [1, 2, 4])
    assert [sum(r["iteration"] == b for r in reports) for b in (1, 2, 4)] == [8, 4, 2]
    assert all(state == {1: None, 2: 1, 4: 2}[budget] for _, budget, state in calls)
    assert min(reports, key=lambda r: (-r["iteration"], r["loss"]))["config"] == {"x": 3}
    calls.clear()
    longer = trials.successive_halving([{"x": i} for i in range(8)], lambda c, b, s: (abs(c["x"] - 3) / b, b), [1, 2, 4], longest=7)
    assert [sum(r["iteration"] == b for r in longer) for b in (1, 2, 4, 7)] == [8, 4, 2, 1]


def test_expand_moves_nothing(spark):
    out = trials.expand(spark.range(10), 4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 40 and "Exchange" not in plan and "Join" not in plan
    assert hashing.joined_key("id", "trial") is not None


def test_guided_search_learns(spark):
    """One hot optimum per group; guided trials end closer than the random ones before them."""
    groups = spark.createDataFrame([(g, 0.2 + 0.1 * g) for g in range(6)], "g int, goal double")

    def evaluate(asked):
        near = F.abs(F.col("a") - F.col("goal")) + F.abs(F.log10("b") + 2) / 4
        return asked.join(groups, "g").withColumn("loss", near)

    ranges = {"a": trials.Range(0.0, 1.0), "b": trials.Range(1e-4, 1.0, log=True)}
    log = trials.guided_search(groups, "g", ranges, evaluate, n_trials=14, startup=8)
    rows = log.collect()
    assert len(rows) == 6 * 14 and {r["trial"] for r in rows} == set(range(14))
    assert all(0 <= r["a"] <= 1 and 1e-4 * 0.999 <= r["b"] <= 1.001 for r in rows)
    early = np.mean([r["loss"] for r in rows if r["trial"] < 8])
    late = np.mean([r["loss"] for r in rows if r["trial"] >= 8])
    assert late < early


def test_best_leaves_nan_behind(spark):
    log = spark.createDataFrame([(1, 0.5), (2, float("nan")), (3, 0.9), (4, None)], "trial int, m double")
    assert trials.best(log, "m", "max").first()["trial"] == 3 and trials.best(log, "m", "min").first()["trial"] == 1


def test_params_read_back(spark):
    frame = spark.createDataFrame([(1, 1.234e-7, None)], "trial int, lr double, other int")
    assert [(r["param"], float(r["value"])) for r in trials.params_long(frame, ["trial"], ["lr", "other"]).collect()] == [("lr", 1.234e-7)]


def test_last_reports_never_mix_rows(spark):
    log = spark.createDataFrame([(1, 1, 9, 9), (1, 2, 1, 5), (1, 2, 4, 2)], "trial int, it int, a int, b int")
    assert tuple(trials.last_reports(log, ["trial"], "it", ["a", "b"]).first()) == (1, 4, 2, 2)


def test_steps_stay_within_the_range(spark):
    from quern.functions import hashing
    out = spark.range(2000).select(hashing.stepped(hashing.hash_uniform(1, "id", "x"), 0.0, 9.97, 0.5).alias("x"))
    assert out.agg({"x": "max"}).first()[0] == 9.5


def test_guided_search_of_a_conditional_space(spark):
    space = {"kind": trials.Options(("near", "far", "off")),
             "x": trials.Range(0.0, 1.0).only_if("kind", "near"),
             "n": trials.Range(1, 64, log=True, whole=True).only_if("kind", "far"),
             "depth": trials.Range(3, 10, whole=True)}

    def evaluate(df):
        branch = F.when(F.col("kind") == "near", F.abs(F.col("x") - 0.2)).when(F.col("kind") == "far", 1 + F.col("n") / 64).otherwise(3.0)
        return df.withColumn("loss", branch + F.abs(F.col("depth") - 7) / 10)

    groups = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "g string")
    log = trials.guided_search(groups, "g", space, evaluate, 14, startup=8)
    assert log.columns == ["g", "trial", "kind", "x", "n", "depth", "loss"]
    rows = log.collect()
    assert sorted((r["g"], r["trial"]) for r in rows) == [(g, t) for g in "abcd" for t in range(14)]
    for r in rows:
        assert (r["x"] is None) == (r["kind"] != "near") and (r["n"] is None) == (r["kind"] != "far")
        assert 3 <= r["depth"] <= 10 and (r["x"] is None or 0 <= r["x"] <= 1) and (r["n"] is None or 1 <= r["n"] <= 64)
    mean = {late: np.mean([r["loss"] for r in rows if (r["trial"] >= 8) == late]) for late in (True, False)}
    assert mean[True] < mean[False]
    near = {late: np.mean([r["kind"] == "near" for r in rows if (r["trial"] >= 8) == late]) for late in (True, False)}
    assert near[True] >= near[False]


def test_whole_ranges_go_there_and_back(spark):
    for r in (trials.Range(3, 10, whole=True), trials.Range(1, 64, log=True, whole=True)):
        df = spark.range(int(r.lo), int(r.hi) + 1).select(F.col("id"), r.from_unit(r.to_unit(F.col("id"))).alias("back"),
                                                        r.from_unit(F.lit(1.0)).alias("top"))
        assert all(x["id"] == x["back"] and x["top"] == r.hi for x in df.collect())


def test_an_option_with_few_trials_is_a_draw(spark):
    log = spark.createDataFrame([("few", 0, 1.0, 1), ("few", 0, 2.0, 2)] + [("many", i % 3, float(i % 3), i) for i in range(60)],
                                "g string, o int, loss double, trial int")
    got = {r["g"]: r["o"] for r in trials.suggest_option(log, "g", "o", "loss", "trial", 3).collect()}
    assert set(got) == {"few", "many"} and got["few"] in (0, 1, 2) and got["many"] == 0


def test_trials_in_one_aggregation(spark):
    rows = spark.range(1000).selectExpr("id % 3 AS g", "CAST(id AS DOUBLE) / 1000 AS x")
    sums = lambda t: {"n": F.count_if(F.col("x") < t / 50.0), "total": F.sum(F.when(F.col("x") < t / 50.0, F.lit(1)))}
    for groups in ([], ["g"]):
        got = trials.per_trial(rows, range(50), sums, groups, at_once=20)
        plain = trials.expand(rows, 50).groupBy(*groups, "trial").agg(
            F.sum((F.col("x") < F.col("trial") / 50.0).cast("long")).alias("n"),
            F.sum(F.when(F.col("x") < F.col("trial") / 50.0, F.lit(1))).alias("total"))
        assert sorted(map(str, got.collect())) == sorted(map(str, plain.select(got.columns).collect()))
    plan = trials.per_trial(rows, range(8), sums)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("HashAggregate")  # rows are added up before trials become rows
    assert [r.n for r in trials.per_trial(rows.limit(0), range(2), sums).collect()] == [0, 0]
