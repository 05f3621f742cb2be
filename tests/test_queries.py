"""Every named query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from tests.oracle import compare, connect

ORACLE = contract.oracle_sql()
ROWS_ONLY = sorted(set(contract.queries()) - set(ORACLE))


@pytest.fixture(scope="module")
def con(tiny):
    return connect(tiny)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, con, tiny, name):
    frame = contract.queries()[name](spark, tiny)
    plan = plan_of(frame)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert compare(spark, con, tiny, name, lambda *_: frame, ORACLE[name]) == []


def test_filters_and_columns_reach_the_scan(spark, tiny):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = plan_of(contract.queries()["filter_conjunction"](spark, tiny))
    assert "EqualTo(l_returnflag,R)" in plan and "EqualTo(l_quantity,10.0)" in plan and "l_tax" not in plan


@pytest.mark.parametrize("name", ["pii_redact_spans", "pii_spans", "image_tile_boxes", "trials_random", "udf_column",
                                  "score_then_redact", "one_hot_vectors"])
def test_record_steps_do_not_shuffle(spark, tiny, name):
    assert "Exchange" not in plan_of(contract.queries()[name](spark, tiny))


@pytest.mark.parametrize("name", ["dedup_by_key", "best_trial_per_group", "upsert_latest"])
def test_first_row_per_key_is_limited_before_the_exchange(spark, tiny, name):
    plan = plan_of(contract.queries()[name](spark, tiny))
    assert plan.count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_returns_rows(spark, tiny, name):
    assert contract.queries()[name](spark, tiny).count() > 0


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["model_num", "num_datapoints", "slope", "RMSE"]
    assert frame.count() > 0


def test_no_sql_without_query():
    assert set(ORACLE) <= set(contract.queries())
