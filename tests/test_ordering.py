import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.functions import hashing, joins, ordering


@pytest.fixture(scope="module")
def rows(spark):
    """Group 0 holds most of the rows, one group is null."""
    g = F.when(F.col("id") % 10 < 7, F.lit(0)).when(F.col("id") % 10 < 9, (F.col("id") % 5)).cast("int")
    return spark.range(3000).select("id", g.alias("g"), (F.col("id") * 7919 % 3001).alias("v"))


def brute(rows, groups):
    seen, out = {}, {}
    for r in sorted(rows, key=lambda r: (r["v"], r["id"])):
        key = r["g"] if groups else None
        out[r["id"]] = seen.get(key, 0)
        seen[key] = seen.get(key, 0) + r["id"]
    return out


@pytest.mark.parametrize("limit", [500, 10_000])
@pytest.mark.parametrize("groups", [[], ["g"]])
def test_running_sums_whole_and_sliced(rows, limit, groups):
    got = ordering.running_sums(rows, ["v", "id"], {"s": "id"}, groups, max_task_rows=limit)
    assert {r["id"]: r["s"] for r in got.collect()} == brute(rows.collect(), groups)


def test_row_numbers_sliced_are_dense(rows):
    got = ordering.row_numbers(rows, ["v", "id"], "n", ["g"], max_task_rows=400).collect()
    for g in {r["g"] for r in got}:
        mine = sorted((r["v"], r["id"], r["n"]) for r in got if r["g"] == g)
        assert [m[2] for m in mine] == list(range(1, len(mine) + 1))


@pytest.mark.parametrize("limit", [20, 10_000])
@pytest.mark.parametrize("accuracy", [4, 20, 10_000])
def test_exact_quantiles(spark, limit, accuracy):
    values = np.random.default_rng(1).integers(0, 50, 999).astype(float)
    df = spark.createDataFrame([(float(v), float(-v) if i % 3 else None) for i, v in enumerate(values)], "a double, b double")
    got = {r["column"]: r for r in ordering.exact_quantiles(df, ["a", "b"], [0.1, 0.5, 0.75], limit, accuracy).collect()}
    other = [-v for i, v in enumerate(values) if i % 3]
    for name, data in (("a", values), ("b", other)):
        assert got[name]["n"] == len(data)
        assert [got[name][f"q_{i}"] for i in range(3)] == pytest.approx(list(np.quantile(data, [0.1, 0.5, 0.75])))


def test_quantiles_of_empty_and_special_columns(spark):
    df = spark.createDataFrame([(None, float("nan"), float("-inf")), (None, 2.0, 1.0), (None, 3.0, 2.0)], "a double, b double, c double")
    got = {r["column"]: r for r in ordering.exact_quantiles(df, ["a", "b", "c"], [0.0, 0.5]).collect()}
    assert (got["a"]["n"], got["a"]["q_0"]) == (0, None)
    assert (got["b"]["n"], got["b"]["q_0"], got["b"]["q_1"]) == (2, 2.0, 2.5)
    assert (got["c"]["q_0"], got["c"]["q_1"]) == (float("-inf"), 1.0)


def test_quantiles_shuffle_little(spark):
    df = spark.range(60_000).select((F.col("id") * 7919 % 60_013).cast("double").alias("v"))
    data = sorted(r["v"] for r in df.collect())
    row = ordering.exact_quantiles(df, ["v"], [0.25, 0.5]).first()
    assert [row["q_0"], row["q_1"]] == pytest.approx(list(np.quantile(data, [0.25, 0.5])))


def test_draws_do_not_depend_on_partitions(spark):
    df = spark.range(500)
    u = hashing.hash_uniform(1, "id", "x").alias("u")
    a = sorted(r[0] for r in df.repartition(1).select(u).collect())
    b = sorted(r[0] for r in df.repartition(13).select(u).collect())
    assert a == b and 0 <= a[0] and a[-1] < 1 and abs(sum(a) / 500 - 0.5) < 0.05


def test_match_keys_joins_null_to_null(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "k string, w int")
    assert sorted(r["w"] for r in joins.match_keys(left, right, ["k"]).collect()) == [10, 20]


def test_keys_of_several_columns_are_matched_by_a_hash_first(spark):
    left = spark.createDataFrame([(1, "a", 10), (1, None, 20), (None, None, 30), (2, "a", 40), (1, "a", 50)], "k int, t string, v int")
    right = spark.createDataFrame([(1, "a", "x"), (1, None, "y"), (None, None, "z"), (None, "a", "no")], "k int, t string, w string")
    for limit in ("-1", "10485760"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            out = joins.match_keys(left, right, ["k", "t"])
            assert out.columns == ["k", "t", "v", "w"]
            assert sorted((r.v, r.w) for r in out.collect()) == [(10, "x"), (20, "y"), (30, "z"), (50, "x")]
            plan = out._jdf.queryExecution().optimizedPlan().toString()
            assert "xxhash64" in plan
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # equal numbers with other bits, and keys of two types, are matched as before
    zero = spark.createDataFrame([(0.0, 1, 1)], "d double, k int, v int")
    other = spark.createDataFrame([(-0.0, 1, 2)], "d double, k bigint, w int")
    assert joins.match_keys(zero, other, ["d", "k"]).count() == 1
