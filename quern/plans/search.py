"""Trial tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quern.operators import trials
from quern.plans import standins as st
from quern.plans.registry import query, sql_uniform
from quern.sources.tables import load

N_TRIALS = 40
CLASSIFIER_PARAMS = list(trials.CLASSIFIER_SPACE)


def _u(name, key="s_suppkey || '-' || trial"):
    return sql_uniform(2025, key, name)


def _when(condition, value, name):
    return f"CASE WHEN classifier = '{condition}' THEN {value} END AS {name}"


def _int(name, lo, hi):
    return f"CAST({lo} + floor({_u(name)} * {hi - lo + 1}) AS INTEGER)"


def _log(name, lo, hi):
    return f"exp(ln({lo}::DOUBLE) + {_u(name)} * (ln({hi}::DOUBLE) - ln({lo}::DOUBLE)))"


def _log_int(name, lo, hi):
    return f"CAST(floor({_log(name, lo, hi + 1)}) AS INTEGER)"


CLASSIFIER_SQL = f"""
base AS (SELECT s_suppkey, CAST(trial AS INTEGER) AS trial FROM supplier, range({N_TRIALS}) r(trial)),
picked AS (SELECT *, ['LogisticRegression', 'RandomForest', 'GradientBoosting'][CAST(floor({_u('classifier')} * 3) AS INTEGER) + 1] AS classifier FROM base),
sampled AS (SELECT s_suppkey, trial, classifier,
  {_when('LogisticRegression', f"round({_log('C', 0.01, 1.0)}, 9)", 'C')},
  {_when('LogisticRegression', f"round(1e-6::DOUBLE + 1e-6::DOUBLE * floor({_u('tol')} * 1000), 9)", 'tol')},
  {_when('RandomForest', _log_int('forest_trees', 10, 200), 'forest_trees')},
  {_when('RandomForest', _int('forest_depth', 3, 10), 'forest_depth')},
  {_when('RandomForest', _int('min_samples_split', 2, 10), 'min_samples_split')},
  {_when('RandomForest', _int('min_samples_leaf', 1, 10), 'min_samples_leaf')},
  {_when('GradientBoosting', _log_int('boost_rounds', 10, 200), 'boost_rounds')},
  {_when('GradientBoosting', _int('boost_depth', 3, 10), 'boost_depth')},
  {_when('GradientBoosting', f"round(0.01::DOUBLE + {_u('learning_rate')} * 0.89::DOUBLE, 9)", 'learning_rate')},
  {_when('GradientBoosting', _int('max_bin', 2, 256), 'max_bin')},
  {_when('GradientBoosting', _int('num_leaves', 2, 256), 'num_leaves')} FROM picked)
"""


def _sampled(spark, sf):
    groups = load(spark, sf, "supplier").select("s_suppkey")
    out = trials.sample(groups, "s_suppkey", trials.CLASSIFIER_SPACE, N_TRIALS)
    return out.withColumns({c: F.round(c, 9) for c in ("C", "tol", "learning_rate")})


@query("trials_random", f"WITH {CLASSIFIER_SQL} SELECT * FROM sampled")
def trials_random(spark, sf):
    """A conditional search space, one search of 40 trials per supplier."""
    return _sampled(spark, sf)


@query("trials_network", f"""
SELECT s_suppkey, CAST(trial AS INTEGER) AS trial, CAST(pow(2, {_int('l1', 2, 8)}) AS INTEGER) AS l1,
  CAST(pow(2, {_int('l2', 2, 8)}) AS INTEGER) AS l2, round({_log('lr', 1e-4, 1e-1)}, 9) AS lr,
  [2, 4, 8, 16][CAST(floor({_u('batch_size')} * 4) AS INTEGER) + 1] AS batch_size, 20::INTEGER AS max_epoch
FROM supplier, range(8) r(trial)""")
def trials_network(spark, sf):
    out = trials.sample(load(spark, sf, "supplier").select("s_suppkey"), "s_suppkey", trials.NETWORK_SPACE, 8)
    return out.withColumn("lr", F.round("lr", 9))


@query("trials_grid", """
SELECT s_suppkey, CAST((row_number() OVER (PARTITION BY s_suppkey ORDER BY c, depth)) - 1 AS INTEGER) AS trial, c, depth
FROM supplier, (SELECT unnest([0.01, 0.1, 1.0])::DOUBLE AS c), (SELECT unnest([3, 5, 7, 9])::INTEGER AS depth)""")
def trials_grid(spark, sf):
    groups = load(spark, sf, "supplier").select("s_suppkey")
    return trials.grid(groups, {"c": [0.01, 0.1, 1.0], "depth": [3, 5, 7, 9]})


@query("trials_cross_data", f"""
SELECT CAST(trial AS INTEGER) AS trial, count(*) AS rows, count(*) FILTER (l_discount < trial / 100.0) AS below,
  round(sum(CASE WHEN l_discount < trial / 100.0 THEN l_quantity ELSE 0 END), 2) AS quantity
FROM lineitem, range(8) r(trial) GROUP BY 1""")
def trials_cross_data(spark, sf):
    """Every trial sees every row; each counts the rows below its own threshold."""
    def sums(trial):
        hit = F.col("l_discount") < F.lit(trial) / 100.0
        return {"rows": F.count(F.lit(1)), "below": F.count_if(hit),
                "quantity": F.round(F.sum(F.when(hit, F.col("l_quantity")).otherwise(0.0)), 2)}

    return trials.per_trial(load(spark, sf, "lineitem").select("l_discount", "l_quantity"), range(8), sums)


@query("trial_params_long", f"""
WITH {CLASSIFIER_SQL}, shown AS (SELECT s_suppkey, trial, {', '.join(f'CAST({p} AS VARCHAR) AS "{p}"' for p in CLASSIFIER_PARAMS)} FROM sampled),
long AS (UNPIVOT shown ON {', '.join(f'"{p}"' for p in CLASSIFIER_PARAMS)} INTO NAME param VALUE value)
SELECT s_suppkey, trial, param, round(TRY_CAST(value AS DOUBLE), 9) AS number,
  CASE WHEN TRY_CAST(value AS DOUBLE) IS NULL THEN value END AS text FROM long""")
def trial_params_long(spark, sf):
    """All parameters, read back from their logged strings."""
    long = trials.params_long(_sampled(spark, sf), ["s_suppkey", "trial"], CLASSIFIER_PARAMS)
    number = F.col("value").try_cast("double")
    return long.select("s_suppkey", "trial", "param", F.round(number, 9).alias("number"),
                       F.when(number.isNull(), F.col("value")).alias("text"))


@query("best_trial", """
WITH last AS (SELECT user_id AS trial, arg_max(value, (ts, event_id)) AS metric, max(ts) AS ts FROM events GROUP BY 1)
SELECT trial, metric FROM last ORDER BY metric DESC, trial LIMIT 1""")
def best_trial(spark, sf):
    """Best by each trial's last report."""
    log = st.event_log(spark, sf).withColumn("at", F.struct("ts", "event_id"))
    last = trials.last_reports(log, ["trial"], "at", ["metric"])
    return trials.best(last, "metric", "max").select("trial", "metric")


BOOSTED_LOSS = "pow(eta - 0.3, 2) + pow(subsample - 0.8, 2) + max_depth / 100.0"


@query("best_trial_per_group", f"""
WITH tried AS (SELECT s_suppkey, CAST(trial AS INTEGER) AS trial, {_log_int('n_estimators', 10, 199)} AS n_estimators,
  {_int('max_depth', 3, 9)} AS max_depth, {_int('min_child_weight', 1, 3)} AS min_child_weight,
  0.5::DOUBLE + {_u('subsample')} * 0.5::DOUBLE AS subsample, 0.01::DOUBLE + {_u('eta')} * 0.89::DOUBLE AS eta
  FROM supplier, range({N_TRIALS}) r(trial)),
logged AS (SELECT s_suppkey, trial, n_estimators, max_depth, min_child_weight, round(subsample, 9) AS subsample, round(eta, 9) AS eta,
  round((eta - 0.3) * (eta - 0.3) + (subsample - 0.8) * (subsample - 0.8) + max_depth / 100.0, 9) AS loss FROM tried)
SELECT * FROM logged QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY loss, trial) = 1""")
def best_trial_per_group(spark, sf):
    tried = trials.sample(load(spark, sf, "supplier").select("s_suppkey"), "s_suppkey", trials.BOOSTED_SPACE, N_TRIALS)
    eta, share = F.col("eta") - 0.3, F.col("subsample") - 0.8
    logged = tried.withColumn("loss", F.round(eta * eta + share * share + F.col("max_depth") / 100.0, 9))
    found = trials.best(logged, "loss", "min", groups=["s_suppkey"])
    return found.select("s_suppkey", "trial", "n_estimators", "max_depth", "min_child_weight",
                        F.round("subsample", 9).alias("subsample"), F.round("eta", 9).alias("eta"), "loss")


@query("trial_elapsed", """
SELECT event_type, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6::DOUBLE + arg_max(value, (ts, value)), 6) AS elapsed_seconds,
  count(*) AS reports FROM events GROUP BY 1""")
def trial_elapsed(spark, sf):
    out = trials.elapsed(load(spark, sf, "events"), "ts", "value", ["event_type"])
    return out.withColumn("elapsed_seconds", F.round("elapsed_seconds", 6))


MILESTONES = trials.rungs(grace=1, factor=2, longest=16)


@query("halving_survivors", """
WITH reports AS (SELECT user_id AS trial, value AS metric,
    CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS rung FROM events),
placed AS (SELECT trial, rung, metric, row_number() OVER (PARTITION BY rung ORDER BY metric, trial) AS place,
    count(*) OVER (PARTITION BY rung) AS entrants FROM reports WHERE rung IN (1, 2, 4, 8, 16)),
judged AS (SELECT *, place <= greatest(floor(entrants / 2), 1) AS kept FROM placed)
SELECT *, bool_and(kept) OVER (PARTITION BY trial ORDER BY rung) AS alive FROM judged""")
def halving_survivors(spark, sf):
    order = Window.partitionBy("trial").orderBy("ts", "event_id")
    log = st.event_log(spark, sf).withColumn("iteration", F.row_number().over(order))
    log = log.where(F.col("iteration") <= MILESTONES[-1])  # at most the longest milestone per trial leaves a task
    return trials.halve(log, MILESTONES)


PARZEN_SPAN = 500.0


def _kernel(x, c, h):
    return f"exp(-0.5 * (({c} - {x}) / {h}) * (({c} - {x}) / {h})) / sqrt(2 * pi())"


@query("parzen_rank", f"""
WITH log AS (SELECT event_type AS g, event_id AS trial, value AS x, abs(value - 40) AS loss FROM events),
ranked AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY loss, trial) AS rn, count(*) OVER (PARTITION BY g) AS n FROM log),
flagged AS (SELECT *, rn <= least(ceil(0.1 * n), 25) AS good FROM ranked),
sizes AS (SELECT g, count(*) AS n, count(*) FILTER (good) AS ng FROM flagged GROUP BY 1),
widths AS (SELECT *, {PARZEN_SPAN} * pow(greatest(ng, 1)::DOUBLE, -0.2) / 5 AS hg,
  {PARZEN_SPAN} * pow(greatest(n - ng, 1)::DOUBLE, -0.2) / 5 AS hb FROM sizes),
draws AS (SELECT w.*, k, {sql_uniform(2025, "g || '-' || k", 'centre')} AS u0, {sql_uniform(2025, "g || '-' || k", 'radius')} AS u1,
  {sql_uniform(2025, "g || '-' || k", 'angle')} AS u2 FROM widths w, range(8) r(k)),
moved AS (SELECT d.g, d.k, d.n, d.ng, d.hg, d.hb, f.x + hg * sqrt(-2 * ln(1 - u1)) * cos(2 * pi() * u2) AS m
  FROM draws d JOIN flagged f ON f.g = d.g AND f.rn = floor(u0 * ng) + 1),
cands AS (SELECT *, greatest(0.0, least({PARZEN_SPAN},
  CASE WHEN m < 0 THEN -m WHEN m > {PARZEN_SPAN} THEN 2 * {PARZEN_SPAN} - m ELSE m END)) AS c FROM moved),
sums AS (SELECT c.g, c.k, any_value(c.c) AS c, any_value(c.n) AS n, any_value(c.ng) AS ng, any_value(hg) AS hg, any_value(hb) AS hb,
  sum({_kernel('f.x', 'c.c', 'hg')}) FILTER (f.good) AS sg, sum({_kernel('f.x', 'c.c', 'hb')}) FILTER (NOT f.good) AS sb
  FROM cands c JOIN flagged f USING (g) GROUP BY 1, 2),
scored AS (SELECT g, k, c, ln((sg / hg + 1 / {PARZEN_SPAN}) / (ng + 1)) - ln((sb / hb + 1 / {PARZEN_SPAN}) / (n - ng + 1)) AS density FROM sums)
SELECT g AS event_type, CAST(row_number() OVER (PARTITION BY g ORDER BY density DESC, k) AS INTEGER) AS place,
  CAST(k AS INTEGER) AS candidate, round(c, 6) AS value, round(density, 6) AS density FROM scored""")
def parzen_rank(spark, sf):
    """Next value of one parameter per group, from a log of thousands of finished trials per group."""
    log = load(spark, sf, "events").select("event_type", "event_id", "value", F.abs(F.col("value") - 40).alias("loss"))
    ranked = trials.suggest(log, "event_type", "value", "loss", "event_id", 0.0, PARZEN_SPAN)
    return ranked.withColumns({"value": F.round("value", 6), "density": F.round("density", 6)})


@query("parzen_option", f"""
WITH log AS (SELECT user_id % 100 AS g, event_id % 5 AS o, event_id AS trial, abs(value - 40) AS loss FROM events),
ranked AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY loss, trial) AS rn, count(*) OVER (PARTITION BY g) AS n FROM log),
flagged AS (SELECT *, rn <= least(ceil(0.1 * n), 25) AS good FROM ranked),
weights AS (SELECT a.g, a.o, count(f.trial) FILTER (good) + 1 AS wg, count(f.trial) FILTER (NOT good) + 1 AS wb
  FROM (SELECT DISTINCT g, r.o FROM log, range(5) r(o)) a LEFT JOIN flagged f ON f.g = a.g AND f.o = a.o GROUP BY 1, 2),
shares AS (SELECT *, sum(wg) OVER (PARTITION BY g ORDER BY o) AS upto, sum(wg) OVER (PARTITION BY g) AS tg,
  sum(wb) OVER (PARTITION BY g) AS tb FROM weights),
draws AS (SELECT g, k, {sql_uniform(2025, "g || '-' || k", 'option')} AS u FROM (SELECT DISTINCT g FROM log), range(8) r(k)),
picked AS (SELECT d.g, d.k, min(s.o) AS o FROM draws d JOIN shares s ON s.g = d.g AND s.upto > u * tg GROUP BY 1, 2),
scored AS (SELECT p.g, p.o, round(ln(wg::DOUBLE / tg::DOUBLE) - ln(wb::DOUBLE / tb::DOUBLE), 9) AS density
  FROM picked p JOIN shares s ON s.g = p.g AND s.o = p.o)
SELECT g AS user_group, CAST(o AS INTEGER) AS option, density FROM scored
QUALIFY row_number() OVER (PARTITION BY g ORDER BY density DESC, o) = 1""")
def parzen_option(spark, sf):
    """Next option of a parameter without order per group, from a log of finished trials."""
    log = load(spark, sf, "events").select((F.col("user_id") % 100).alias("user_group"), (F.col("event_id") % 5).alias("option"),
                                           "event_id", F.abs(F.col("value") - 40).alias("loss"))
    return trials.suggest_option(log, "user_group", "option", "loss", "event_id", 5, startup=1)
