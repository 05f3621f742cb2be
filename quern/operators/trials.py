"""Hyper-parameter trials as tables: sample, expand, rank, stop early, suggest, log."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.functions import hashing, joins, ordering
from quern.session import ensure_checkpoint_dir

# Fixed values of the model-based sampler.
STARTUP_TRIALS = 8
CANDIDATES = 8
GOOD_SHARE = 0.1
GOOD_LIMIT = 25


@dataclass(frozen=True)
class Param:
    """One search dimension; ``only_if`` makes it null unless an earlier parameter has that value."""

    draw: Callable[[Column], Column]
    condition: tuple[str, object] | None = None

    def only_if(self, name: str, value: object) -> "Param":
        return replace(self, condition=(name, value))


def uniform(lo: float, hi: float) -> Param:
    return Param(lambda u: hashing.uniform(u, lo, hi))


def log_uniform(lo: float, hi: float) -> Param:
    return Param(lambda u: hashing.log_uniform(u, lo, hi))


def stepped(lo: float, hi: float, step: float) -> Param:
    return Param(lambda u: hashing.stepped(u, lo, hi, step))


def integer(lo: int, hi: int) -> Param:
    """lo..hi, both included."""
    return Param(lambda u: hashing.integer(u, lo, hi))


def integer_below(lo: int, hi: int) -> Param:
    """lo..hi - 1."""
    return integer(lo, hi - 1)


def log_integer(lo: int, hi: int) -> Param:
    """lo..hi, both included, on the log scale."""
    return Param(lambda u: hashing.log_integer(u, lo, hi))


def log_integer_below(lo: int, hi: int) -> Param:
    return log_integer(lo, hi - 1)


def choice(values: Sequence) -> Param:
    return Param(lambda u: hashing.pick(u, values))


def power_of_two(lo: int, hi: int) -> Param:
    """2**k for k in lo..hi - 1."""
    return Param(lambda u: F.pow(F.lit(2.0), hashing.integer(u, lo, hi - 1)).cast("int"))


def constant(value) -> Param:
    return Param(lambda u: F.array(*[F.lit(v) for v in value]) if isinstance(value, (list, tuple)) else F.lit(value))


# Search spaces of the classifier, boosted-tree and network searches (fixed ranges).
CLASSIFIER_SPACE = {
    "classifier": choice(["LogisticRegression", "RandomForest", "GradientBoosting"]),
    "C": log_uniform(0.01, 1.0).only_if("classifier", "LogisticRegression"),
    "tol": stepped(1e-6, 1e-3, 1e-6).only_if("classifier", "LogisticRegression"),
    "forest_trees": log_integer(10, 200).only_if("classifier", "RandomForest"),
    "forest_depth": integer(3, 10).only_if("classifier", "RandomForest"),
    "min_samples_split": integer(2, 10).only_if("classifier", "RandomForest"),
    "min_samples_leaf": integer(1, 10).only_if("classifier", "RandomForest"),
    "boost_rounds": log_integer(10, 200).only_if("classifier", "GradientBoosting"),
    "boost_depth": integer(3, 10).only_if("classifier", "GradientBoosting"),
    "learning_rate": uniform(0.01, 0.9).only_if("classifier", "GradientBoosting"),
    "max_bin": integer(2, 256).only_if("classifier", "GradientBoosting"),
    "num_leaves": integer(2, 256).only_if("classifier", "GradientBoosting"),
}
BOOSTED_SPACE = {
    "n_estimators": log_integer_below(10, 200),
    "max_depth": integer_below(3, 10),
    "min_child_weight": choice([1, 2, 3]),
    "subsample": uniform(0.5, 1.0),
    "eta": uniform(0.01, 0.9),
    "objective": constant("binary:logistic"),
    "eval_metric": constant(["logloss", "error"]),
}
NETWORK_SPACE = {
    "l1": power_of_two(2, 9),
    "l2": power_of_two(2, 9),
    "lr": log_uniform(1e-4, 1e-1),
    "batch_size": choice([2, 4, 8, 16]),
    "max_epoch": constant(20),
}


def expand(df: DataFrame, n_trials: int) -> DataFrame:
    """Every row once per trial, column ``trial`` from 0.

    A generator inside the scan stage: nothing is joined, broadcast or moved.
    """
    return df.withColumn("trial", F.explode(F.sequence(F.lit(0), F.lit(n_trials - 1))))


def per_trial(df: DataFrame, trials: Sequence[int], sums: Callable[[int], Mapping[str, Column]], groups: Sequence[str] = (),
              at_once: int = 32) -> DataFrame:
    """One row ``groups, trial, <sums>`` per trial; ``sums`` names the aggregates of a trial.

    All trials are aggregates of one pass, so no row is multiplied and a task sends one row per group. Beyond
    ``at_once`` trials further passes keep the generated code small. A group needs a row in ``df``; without groups
    every trial has its row.
    """
    parts = []
    for start in range(0, len(trials), at_once):
        some = [F.struct(F.lit(t).alias("trial"), *[c.alias(name) for name, c in sums(t).items()]) for t in trials[start:start + at_once]]
        wide = df.groupBy(*groups).agg(F.array(*some).alias("_trials"))
        parts.append(wide.select(*groups, F.inline("_trials")))
    return reduce(DataFrame.unionByName, parts)


def draws(df: DataFrame, key: str | Column, space: Mapping[str, Param], seed: int = 2025) -> DataFrame:
    """Add one column per parameter, drawn from the row's key."""
    key = F.col(key) if isinstance(key, str) else key
    for name, param in space.items():
        value = param.draw(hashing.hash_uniform(seed, key, name))
        if param.condition:
            other, wanted = param.condition
            value = F.when(F.col(other) == F.lit(wanted), value)
        df = df.withColumn(name, value)
    return df


def sample(groups: DataFrame, group: str, space: Mapping[str, Param], n_trials: int, seed: int = 2025) -> DataFrame:
    """``n_trials`` random configurations per row of ``groups``; repeatable per (seed, group, trial)."""
    return draws(expand(groups, n_trials), hashing.joined_key(group, "trial"), space, seed)


def random_search(spark: SparkSession, space: Mapping[str, Param], n_trials: int, seed: int = 2025) -> DataFrame:
    """A search without groups."""
    return draws(spark.range(n_trials).withColumnRenamed("id", "trial"), "trial", space, seed)


def grid(groups: DataFrame, axes: Mapping[str, Sequence]) -> DataFrame:
    """Every combination of the axis values per row of ``groups``; ``trial`` numbers them, last axis fastest."""
    total = math.prod(len(v) for v in axes.values())
    out, block = expand(groups, total), total
    for name, values in axes.items():
        block //= len(values)
        place = F.floor(F.col("trial") / F.lit(block)) % len(values) + 1
        out = out.withColumn(name, F.element_at(F.array(*[F.lit(v) for v in values]), place.cast("int")))
    return out


def report(trial: int, iteration: int, metric: str, value: float, seconds: float = 0.0, group: int = 0) -> tuple:
    """One row of a metric log with columns ``REPORT_SCHEMA``."""
    import datetime
    return (group, trial, iteration, metric, float(value), datetime.datetime.now(), float(seconds))


REPORT_SCHEMA = ("group_id bigint, trial bigint, iteration int, metric string, value double, "
                 "ts timestamp, seconds double")


def append_reports(spark: SparkSession, table: str, rows: Sequence[tuple]) -> None:
    spark.createDataFrame(list(rows), REPORT_SCHEMA).write.mode("append").saveAsTable(table)


def last_reports(log: DataFrame, keys: Sequence[str], iteration: str, values: Sequence[str]) -> DataFrame:
    """The values of each trial's last report; of two at one iteration, the larger in the order of ``values``."""
    last = log.groupBy(*keys).agg(F.max(F.struct(iteration, *values)).alias("_last"))
    return last.select(*keys, *[F.col("_last")[v].alias(v) for v in values], F.col("_last")[iteration].alias(iteration))


def best(log: DataFrame, metric: str, mode: str = "max", trial: str = "trial", groups: Sequence[str] = ()) -> DataFrame:
    """The best row, or the best row per group; ties go to the lowest trial, null and NaN come last.

    Only one row per group and task takes part in the exchange.
    """
    value = F.col(metric)
    if log.schema[metric].dataType.typeName() in ("double", "float"):
        value = F.when(~F.isnan(value), value)
    order = [value.desc_nulls_last() if mode == "max" else value.asc_nulls_last(), F.col(trial)]
    if not groups:
        return log.orderBy(*order).limit(1)
    window = Window.partitionBy(*groups).orderBy(*order)
    return log.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def elapsed(log: DataFrame, ts: str, seconds: str, groups: Sequence[str] = ()) -> DataFrame:
    """Last time stamp minus first plus the last report's own duration, in seconds."""
    start, end = F.min(F.col(ts)), F.max(F.col(ts))
    last = F.max_by(F.col(seconds), F.struct(F.col(ts), F.col(seconds)))
    span = F.timestamp_diff("MICROSECOND", start, end) / 1e6
    return log.groupBy(*groups).agg((span + last).alias("elapsed_seconds"), F.count(F.lit(1)).alias("reports"))


def params_long(df: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Configurations as rows ``keys, param, value``; absent parameters are left out.

    Values are strings that read back to the same number.
    """
    typed = df.select(*keys, *[F.col(n).cast("string").alias(n) for n in names])
    return typed.unpivot(list(keys), list(names), "param", "value").where(F.col("value").isNotNull())


def run_log(runs: DataFrame, trials: DataFrame, params: Sequence[str], metrics: Sequence[str],
            parent: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tables ``runs`` (run_id, parent_id, ...), ``params`` and ``metrics`` (long) of a nested search."""
    keyed = trials.withColumn("run_id", F.format_string("%s-%d", F.lit(parent), F.col("trial")))
    children = keyed.select("run_id", F.lit(parent).alias("parent_id"),
                            F.format_string("trial_%d", F.col("trial")).alias("run_name"))
    values = keyed.select("run_id", *[F.col(m).cast("double").alias(m) for m in metrics])
    return (runs.unionByName(children), params_long(keyed, ["run_id"], params),
            values.unpivot(["run_id"], list(metrics), "metric", "value"))


# --- early stopping ---------------------------------------------------------------------------------

def rungs(grace: int, factor: int, longest: int) -> list[int]:
    """grace, grace * factor, ... up to ``longest``."""
    out, budget = [], grace
    while budget <= longest:
        out.append(budget)
        budget *= factor
    return out


def halve(log: DataFrame, milestones: Sequence[int], factor: int = 2, mode: str = "min",
          max_task_rows: int = ordering.MAX_TASK_ROWS) -> DataFrame:
    """Early-stopping decisions of a log ``trial, iteration, metric``.

    At each milestone the best 1/factor of the trials that reported there (at least one) go on.  Returns
    ``trial, rung, metric, place, entrants, kept, alive``; ``alive`` means kept here and at every earlier
    rung.  A rung may hold any number of trials, so places come from the sliced row numbers.
    """
    at = (log.where(F.col("iteration").isin(list(milestones))).select("trial", F.col("iteration").alias("rung"), "metric")
          .withColumn("_order", F.col("metric") if mode == "min" else -F.col("metric")))
    placed = ordering.row_numbers(at, ["_order", "trial"], "place", ["rung"], max_task_rows)
    sizes = at.groupBy("rung").agg(F.count(F.lit(1)).alias("entrants"))
    placed = placed.join(F.broadcast(sizes), "rung")  # one row per milestone
    quota = F.greatest(F.floor(F.col("entrants") / factor), F.lit(1))
    placed = placed.withColumn("kept", F.col("place") <= quota)
    so_far = Window.partitionBy("trial").orderBy("rung")  # one row per milestone
    return placed.withColumn("alive", F.min("kept").over(so_far)).drop("_order")


def successive_halving(configs: Sequence[Mapping], fit: Callable[[Mapping, int, object], tuple[float, object]],
                       milestones: Sequence[int], factor: int = 2, width: int = 4,
                       longest: int | None = None) -> list[dict]:
    """Train all configurations to the first milestone, keep the best 1/factor, continue those.

    With ``longest`` the last milestone cuts as well and its survivors train on to that budget.

    ``fit(config, budget, state) -> (loss, state)`` runs a distributed fit that continues from ``state``
    (for example network weights).  Returns every report; the survivors have the largest budget.
    """
    alive = [(i, c, None) for i, c in enumerate(configs)]
    budgets = [*milestones, longest] if longest is not None and longest > milestones[-1] else list(milestones)
    reports = []
    for rung, budget in enumerate(budgets):
        with ThreadPoolExecutor(width) as pool:
            done = list(pool.map(lambda item: (item, fit(item[1], budget, item[2])), alive))
        scored = sorted(((loss, i, c, state) for (i, c, _), (loss, state) in done), key=lambda r: r[:2])
        reports += [{"trial": i, "config": dict(c), "iteration": budget, "loss": loss, "state": state}
                    for loss, i, c, state in scored]
        keep = max(1, len(scored) // factor) if rung < len(budgets) - 1 else len(scored)
        alive = [(i, c, state) for _, i, c, state in scored[:keep]]
    return reports


def run_distributed(configs: Sequence[Mapping], fit: Callable[[Mapping], Mapping], width: int = 4) -> list[dict]:
    """Run ``fit`` for every configuration, ``width`` at a time; each fit is itself a distributed job."""
    with ThreadPoolExecutor(width) as pool:
        results = list(pool.map(fit, configs))
    return [{"trial": i, **c, **r} for i, (c, r) in enumerate(zip(configs, results))]


# --- model-based suggestion -------------------------------------------------------------------------

def suggest(log: DataFrame, group: str | Sequence[str], param: str, loss: str, trial: str, lo: float, hi: float,
            n_candidates: int = CANDIDATES, seed: int | str = 2025, startup: int = STARTUP_TRIALS) -> DataFrame:
    """Rank candidate values of one parameter per group by a Parzen estimate of good over other trials.

    The good trials are the lowest-loss tenth of a group (25 at most).  A candidate is a good value moved
    by a hash-drawn normal step and mirrored at the ends of the range.  ``density = log(good kernels) - log(other kernels)``; groups with fewer
    than ``startup`` trials get uniform candidates, in candidate order.

    The kernels of all candidates are summed in one aggregation over the log, so neither pairs nor
    groups are ever materialised and a group may hold most of the log.
    """
    keys = [group] if isinstance(group, str) else list(group)
    span = float(hi) - float(lo)
    counted = log.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    ranking = Window.partitionBy(*keys).orderBy(F.col(loss), F.col(trial))
    top = log.withColumn("_rn", F.row_number().over(ranking)).where(F.col("_rn") <= GOOD_LIMIT)
    good_n = F.least(F.ceil(F.lit(GOOD_SHARE) * F.col("_n")), F.lit(GOOD_LIMIT))
    per_group = joins.match_keys(top, counted, keys).where(F.col("_rn") <= good_n)
    per_group = per_group.groupBy(*keys).agg(  # at most GOOD_LIMIT values
        F.max("_n").alias("_n"),
        F.transform(F.array_sort(F.collect_list(F.struct("_rn", param))), lambda s: s[param]).alias("_good"))
    per_group = per_group.withColumns({"_hg": _bandwidth(F.size("_good"), span),
                                       "_hb": _bandwidth(F.col("_n") - F.size("_good"), span)})

    numbers = F.sequence(F.lit(0), F.lit(n_candidates - 1))

    def candidate(k: Column) -> Column:
        def u(part: str) -> Column:
            return hashing.hash_uniform(seed, F.concat_ws("-", hashing.joined_key(*keys), k.cast("string")), part)
        step = F.sqrt(-2.0 * F.log(1.0 - u("radius"))) * F.cos(2.0 * math.pi * u("angle"))
        moved = hashing.pick(u("centre"), F.col("_good")) + F.col("_hg") * step
        mirrored = F.lit(float(hi)) - F.abs(F.lit(float(hi)) - (F.lit(float(lo)) + F.abs(moved - F.lit(float(lo)))))
        near = F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), mirrored))
        return F.when(F.col("_n") < startup, hashing.uniform(u("centre"), lo, hi)).otherwise(near)

    per_group = per_group.withColumn("_candidates", F.transform(numbers, candidate))

    rows = joins.match_keys(log.select(*keys, param), per_group, keys)
    total = rows.groupBy(*keys).agg(*[
        F.sum(_kernel(F.col("_candidates")[k] - F.col(param), F.col("_hb"))).alias(f"_all{k}")
        for k in range(n_candidates)])
    total = total.select(*keys, F.array(*[f"_all{k}" for k in range(n_candidates)]).alias("_all"))
    scored = joins.match_keys(total, per_group, keys)

    def near_good(centre: Column, width: Column) -> Column:
        return F.aggregate("_good", F.lit(0.0), lambda acc, x: acc + _kernel(centre - x, width))

    flat = 1.0 / span

    def entry(k: Column) -> Column:
        c = F.get("_candidates", k)
        good = (near_good(c, F.col("_hg")) / F.col("_hg") + flat) / (F.size("_good") + 1)
        others = F.greatest(F.get("_all", k) - near_good(c, F.col("_hb")), F.lit(0.0))
        bad = (others / F.col("_hb") + flat) / (F.col("_n") - F.size("_good") + 1)
        density = F.when(F.col("_n") < startup, -k.cast("double")).otherwise(F.log(good) - F.log(bad))
        return F.struct((-density).alias("_o"), k.alias("candidate"), c.alias("value"))

    ranked = scored.select(*keys, F.posexplode_outer(F.array_sort(F.transform(numbers, entry))))
    return ranked.select(*keys, (F.col("pos") + 1).alias("place"), "col.candidate", "col.value",
                         (-F.col("col._o")).alias("density"))


def next_trial(ranked: DataFrame) -> DataFrame:
    """The top candidate per group."""
    return ranked.where(F.col("place") == 1)


def suggest_option(log: DataFrame, group: str | Sequence[str], option: str, loss: str, trial: str, size: Column | int,
                   n_candidates: int = CANDIDATES, seed: int | str = 2025, startup: int = STARTUP_TRIALS) -> DataFrame:
    """One of the options 0 to ``size - 1`` per group, by their shares among good and other trials.

    The good trials are those of ``suggest``. Candidates are drawn from the shares of the good ones, one added to every
    count; the candidate with the highest ``density = log(share in good) - log(share in others)`` wins, of equal ones
    the lowest. Groups with fewer than ``startup`` trials get a uniform draw. Rows are counted per option before they move.
    """
    keys = [group] if isinstance(group, str) else list(group)
    size = F.lit(size) if isinstance(size, int) else size
    ranking = Window.partitionBy(*keys).orderBy(F.col(loss), F.col(trial))
    top = log.withColumn("_rn", F.row_number().over(ranking)).where(F.col("_rn") <= GOOD_LIMIT)

    def as_map(counts: DataFrame, name: str) -> DataFrame:
        return counts.groupBy(*keys).agg(F.sum("_c").alias(f"{name}_n"),
                                         F.map_from_entries(F.collect_list(F.struct(option, "_c"))).alias(name))

    every = as_map(log.groupBy(*keys, option).agg(F.count(F.lit(1)).alias("_c")), "_all")
    good_n = F.least(F.ceil(F.lit(GOOD_SHARE) * F.col("_all_n")), F.lit(GOOD_LIMIT))
    good = joins.match_keys(top, every, keys).where(F.col("_rn") <= good_n)
    good = as_map(good.groupBy(*keys, option).agg(F.count(F.lit(1)).alias("_c")), "_good")

    def of(name: str, o: Column) -> Column:
        return F.coalesce(F.element_at(name, o), F.lit(0))

    def total(weights: Column) -> Column:
        return F.aggregate(weights, F.lit(0).cast("long"), lambda acc, w: acc + w)

    numbers = F.transform(F.sequence(F.lit(0), size - 1), lambda o: o.cast(log.schema[option].dataType))
    both = joins.match_keys(every, good, keys).withColumns({
        "_g": F.transform(numbers, lambda o: of("_good", o) + 1),
        "_b": F.transform(numbers, lambda o: of("_all", o) - of("_good", o) + 1)})

    def candidate(k: Column) -> Column:
        u = hashing.hash_uniform(seed, F.concat_ws("-", hashing.joined_key(*keys), k.cast("string")), "option")
        before = F.filter(numbers, lambda o: total(F.slice("_g", F.lit(1), o.cast("int") + 1)) <= u * total(F.col("_g")))
        drawn = F.when(F.col("_all_n") < startup, F.floor(u * size).cast("int")).otherwise(F.size(before))
        share = F.log(F.get("_g", drawn) / total(F.col("_g"))) - F.log(F.get("_b", drawn) / total(F.col("_b")))
        order = F.when(F.col("_all_n") < startup, k.cast("double")).otherwise(-F.round(share, 9))
        return F.struct(order.alias("_o"), drawn.alias("option"), F.round(share, 9).alias("density"))

    best = F.array_min(F.transform(F.sequence(F.lit(0), F.lit(n_candidates - 1)), candidate))
    return both.select(*keys, best.alias("_best")).select(*keys, F.col("_best.option").alias(option), F.col("_best.density").alias("density"))


@dataclass(frozen=True)
class Range:
    """A numeric dimension of a guided search; ``whole`` makes it the integers lo..hi."""

    lo: float
    hi: float
    log: bool = False
    whole: bool = False
    condition: tuple[str, object] | None = None

    def only_if(self, name: str, value: object) -> "Range":
        return replace(self, condition=(name, value))

    def _end(self) -> float:
        return self.hi + 1 if self.whole else self.hi

    def to_unit(self, value: Column) -> Column:
        """Whole numbers stand for the middle of their stretch."""
        if self.whole:
            value = F.sqrt(value * (value + 1.0)) if self.log else value + 0.5
        if self.log:
            return (F.log(value) - F.lit(math.log(self.lo))) / F.lit(math.log(self._end() / self.lo))
        return (value - F.lit(float(self.lo))) / F.lit(float(self._end()) - float(self.lo))

    def from_unit(self, unit: Column) -> Column:
        value = (hashing.log_uniform if self.log else hashing.uniform)(unit, self.lo, self._end())
        if not self.whole:
            return value
        return F.least(F.greatest(F.floor(value), F.lit(int(self.lo))), F.lit(int(self.hi))).cast("int")


@dataclass(frozen=True)
class Options:
    """A dimension of a guided search with a few unordered values; later dimensions may depend on it by ``only_if``."""

    values: tuple
    condition: tuple[str, object] | None = None

    def only_if(self, name: str, value: object) -> "Options":
        return replace(self, condition=(name, value))

    def from_unit(self, unit: Column) -> Column:
        return hashing.pick(unit, self.values)

    def place(self, value: Column) -> Column:
        """Position of a value, from 0; null stays null."""
        return F.array_position(F.array(*[F.lit(v) for v in self.values]), value) - 1

    def at(self, place: Column) -> Column:
        return F.get(F.array(*[F.lit(v) for v in self.values]), place.cast("int"))


def guided_search(groups: DataFrame, group: str, ranges: Mapping[str, Range | Options],
                  evaluate: Callable[[DataFrame], DataFrame], n_trials: int, startup: int = STARTUP_TRIALS,
                  seed: int = 2025) -> DataFrame:
    """A search per row of ``groups`` in which later trials learn from earlier ones.

    The first ``startup`` trials are random.  Each later round asks for one more trial of every group at
    once: all parameters of all groups are ranked in one pass over the log, then ``evaluate`` adds a
    column ``loss`` to the frame ``group, trial, <params>``.  The log is checkpointed per round.

    A dimension with a condition learns from the trials of its branch only and is null in the others; a branch
    with fewer than ``startup`` trials is drawn at random.
    """
    ensure_checkpoint_dir(groups.sparkSession)
    space = {name: Param(r.from_unit, r.condition) for name, r in ranges.items()}
    columns = [group, "trial", *ranges, "loss"]
    numeric = {n: r for n, r in ranges.items() if isinstance(r, Range)}
    options = {n: r for n, r in ranges.items() if isinstance(r, Options)}
    log = evaluate(sample(groups.select(group), group, space, startup, seed)).select(*columns).checkpoint()
    for number in range(startup, n_trials):
        wide = groups.select(group)
        if numeric:
            chosen = next_trial(suggest(_by_param(log, group, {n: r.to_unit(F.col(n)) for n, r in numeric.items()}),
                                        [group, "param"], "at", "loss", "trial", 0.0, 1.0, seed=f"{seed}-{number}", startup=startup))
            wide = joins.match_keys(wide, _by_name(chosen, group, numeric, "value"), [group], "left")
        if options:
            sizes = F.create_map(*[F.lit(x) for n, r in options.items() for x in (n, len(r.values))])
            chosen = suggest_option(_by_param(log, group, {n: r.place(F.col(n)) for n, r in options.items()}),
                                    [group, "param"], "at", "loss", "trial", F.element_at(sizes, F.col("param")),
                                    seed=f"{seed}-{number}", startup=startup)
            wide = joins.match_keys(wide, _by_name(chosen, group, options, "at"), [group], "left")
        asked = wide.withColumn("trial", F.lit(number))
        for name, r in ranges.items():
            fresh = hashing.hash_uniform(f"{seed}-{number}", hashing.joined_key(group, "trial"), name)
            if isinstance(r, Options):
                value = F.coalesce(r.at(F.col(name)), r.from_unit(fresh))
            else:
                value = r.from_unit(F.coalesce(F.col(name), fresh))
            if r.condition:
                value = F.when(F.col(r.condition[0]) == F.lit(r.condition[1]), value)
            asked = asked.withColumn(name, value)
        log = log.unionByName(evaluate(asked.select(group, "trial", *ranges)).select(*columns)).checkpoint()
    return log


def _by_param(log: DataFrame, group: str, values: Mapping[str, Column]) -> DataFrame:
    """Rows ``group, trial, loss, param, at`` of the parameters a trial has."""
    wide = log.select(group, "trial", "loss", *[v.alias(n) for n, v in values.items()])
    return wide.unpivot([group, "trial", "loss"], list(values), "param", "at").where(F.col("at").isNotNull())


def _by_name(chosen: DataFrame, group: str, names: Mapping, value: str) -> DataFrame:
    return chosen.groupBy(group).agg(*[F.max(F.when(F.col("param") == n, F.col(value))).alias(n) for n in names])


def _bandwidth(n: Column, span: float) -> Column:
    return F.lit(span) * F.pow(F.greatest(n, F.lit(1)).cast("double"), F.lit(-0.2)) / 5


def _kernel(distance: Column, width: Column) -> Column:
    """Gaussian without its width, so that the caller divides once."""
    return F.exp(-0.5 * (distance / width) * (distance / width)) / math.sqrt(2 * math.pi)
