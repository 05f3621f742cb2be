"""Many time series: reshape, number, split, feature columns and per-group fits.

After ``daily`` a series has at most one row per calendar day, so windows over one series stay within
the length of the calendar however many raw rows the series has.
"""

from __future__ import annotations

import pickle
import time
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions import joins, ordering
from quern.operators import trials

# Fixed values of the forecasting set-up.
TEST_DAYS = 7
CONTEXT_DAYS = 360
N_LAGS = 3
N_CHANGEPOINTS = 10
CHANGEPOINT_RANGE = 0.8
IMPUTE_LINEAR = 10
IMPUTE_ROLLING = 1000
SERIES_PER_MODEL = 100


def melt(wide: DataFrame, ids: Sequence[str], variable: str, value: str) -> DataFrame:
    """Every column that is not an id becomes a row ``ids, variable, value``."""
    return wide.unpivot(list(ids), [c for c in wide.columns if c not in set(ids)], variable, value)


def attach_calendar(long: DataFrame, calendar: DataFrame, label: str) -> DataFrame:
    """Add the calendar columns of a day label; days without an entry keep nulls."""
    return long.join(calendar, label, "left")


def attach_price(long: DataFrame, prices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the price of a row; rows without a price keep null."""
    keys = list(keys)
    renamed = prices.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = joins.hash_first(long, renamed, keys, [f"_r_{k}" for k in keys])
    for k in keys:
        same = same & (F.col(k) == F.col(f"_r_{k}"))
    front = long.select(*keys, *[c for c in long.columns if c not in keys])
    return front.join(renamed, same, "left").drop(*[f"_r_{k}" for k in keys])


def keep_sold(df: DataFrame, quantity: str = "sale_quantity") -> DataFrame:
    return df.where(F.col(quantity).try_cast("double") > 0)


def number_series(df: DataFrame, keys: Sequence[str], out: str = "item_num") -> DataFrame:
    """Dense rank of the series key over the whole table.

    Only the distinct keys are ordered; the rows then get their number by a join.
    """
    keys = list(keys)
    numbered = ordering.row_numbers(df.select(*keys).distinct(), keys, out)
    return joins.match_keys(df, numbered, keys).withColumn(out, F.col(out).cast("int"))


def first_n(df: DataFrame, n: int, number: str = "item_num") -> DataFrame:
    return df.where(F.col(number) <= n)


def assign_model(df: DataFrame, per_model: int = SERIES_PER_MODEL, number: str = "item_num") -> DataFrame:
    return df.withColumn("model_num", F.ceil(F.col(number) / F.lit(per_model)).cast("long"))


def add_revenue(df: DataFrame, price: str = "sell_price", quantity: str = "sale_quantity") -> DataFrame:
    return df.withColumn("y", F.col(price).cast("double") * F.col(quantity).cast("double"))


def to_long_frame(df: DataFrame, number: str = "item_num", date: str = "date_time", keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, F.col(number).alias("ID"), F.col(date).alias("ds"), "y")


def daily(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per series and day."""
    return df.groupBy(*keys, "ds").agg(F.sum("y").alias("y"))


def group_stats(df: DataFrame, group: str) -> DataFrame:
    """Observed points, first and last day per group."""
    return df.groupBy(group).agg(F.count("y").alias("num_datapoints"), F.min("ds").alias("first_ds"),
                                 F.max("ds").alias("last_ds"))


def map_groups(df: DataFrame, group: str, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str,
               order: Sequence[str] = ()) -> DataFrame:
    """``fn`` on the whole pandas frame of every group, rows in ``order``.

    A group is one frame in one task.  Use it for groups that are bounded by construction, such as a daily
    series; a fit over groups of any size is written with mergeable sums, as ``moments`` and
    ``trend_forecast`` are.
    """
    def run(part: pd.DataFrame) -> pd.DataFrame:
        return fn(part.sort_values(list(order), ignore_index=True) if order else part)

    return df.groupBy(group).applyInPandas(run, schema)


def fold_groups(df: DataFrame, group: str, start: Callable[[], object], add: Callable[[object, pd.DataFrame], object],
                merge: Callable[[object, object], object], finish: Callable[[object], dict], schema: str,
                held: int = 10_000, ways: int = 64) -> DataFrame:
    """A group function in mergeable form: ``group`` and the columns ``finish`` makes of the group's state.

    ``add`` takes rows of one group into a state, ``merge`` joins two states, in any order. Every task folds the rows
    it has and sends one state per group (more often beyond ``held`` groups), so no task gets the rows of a whole group.
    The states of a group are merged in ``ways`` parts and then once more. ``schema`` names the columns of
    ``finish``; null is a group of its own, and a frame without rows has no groups.
    """
    key = df.schema[group].dataType.simpleString()
    packed = f"_group {key}, _part int, _state binary"

    def dumped(states: dict, part: int) -> pd.DataFrame:
        names = [None if k is pd.NA else k for k in states]
        return pd.DataFrame({"_group": pd.Series(names, dtype=object), "_part": part,
                             "_state": [pickle.dumps(s) for s in states.values()]})

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        states, part = {}, TaskContext.get().partitionId() % ways
        for batch in batches:
            for name, rows in batch.groupby("_group", dropna=False, sort=False):
                name = pd.NA if pd.isna(name) else name
                states[name] = add(states[name] if name in states else start(), rows.drop(columns="_group"))
            if len(states) > held:
                yield dumped(states, part)
                states = {}
        yield dumped(states, part)

    def reduced(batches: Iterator[pd.DataFrame]) -> object:
        state = start()
        for batch in batches:
            for other in batch["_state"]:
                state = merge(state, pickle.loads(other))
        return state

    def join(names: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"_group": pd.Series([names[0]], dtype=object), "_part": [0], "_state": [pickle.dumps(reduced(batches))]})

    def end(names: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({group: pd.Series([names[0]], dtype=object),
                            **{c: [v] for c, v in finish(reduced(batches)).items()}})

    parts = df.withColumn("_group", F.col(group)).mapInPandas(fold, packed)
    fewer = parts.groupBy("_group", "_part").applyInPandas(join, packed)
    return fewer.groupBy("_group").applyInPandas(end, f"`{group}` {key}, {schema}")


def model_count(df: DataFrame, concurrent: int, batches: int) -> DataFrame:
    """Number of models and the number of trials that run at once and in all."""
    top = df.agg(F.max("model_num").alias("num_models"))
    return top.select("num_models", F.lit(concurrent * batches).cast("long").alias("trials_per_model"),
                      (F.col("num_models") * concurrent).alias("total_concurrent_trials"))


def _with_last_day(df: DataFrame, group: str) -> DataFrame:
    last = df.groupBy(group).agg(F.max("ds").alias("_last"))
    return joins.match_keys(df, last, [group])


def temporal_split(df: DataFrame, group: str, days: int = TEST_DAYS) -> DataFrame:
    """Rows strictly before the group's last day minus ``days`` are train, the others test.

    The last day comes from an aggregate rather than a window, so rows are not moved by group.
    """
    cut = F.date_sub("_last", days)
    return (_with_last_day(df, group).withColumn("cutoff", cut)
            .withColumn("split", F.when(F.col("ds") < F.col("cutoff"), "train").otherwise("test")).drop("_last"))


def context(df: DataFrame, group: str, days: int = CONTEXT_DAYS) -> DataFrame:
    """Rows of the group's last ``days`` days."""
    return _with_last_day(df, group).where(F.col("ds") >= F.date_sub("_last", days)).drop("_last")


def regularize(df: DataFrame, keys: Sequence[str], linear: int = IMPUTE_LINEAR, rolling: int = IMPUTE_ROLLING,
               drop_missing: bool = False, lags: int = 0, keep: Sequence[str] = ()) -> DataFrame:
    """A row for every day between a series' first and last day; adds ``y_filled``.

    A gap is interpolated up to ``linear`` days from each side; what is left gets the mean of a centred
    window of ``rolling + 2 * linear`` days that holds at least ``2 * linear`` values.  ``df`` must be daily.
    ``lags`` adds ``lag_1 ..`` of ``y_filled`` (of the days before, dropped ones too); ``keep`` names columns with one
    value per series.
    """
    import pyarrow as pa

    keys, keep = list(keys), list(keep)
    series = Window.partitionBy(*keys).orderBy("ds")
    whole = Window.partitionBy(*keys)
    rows = df.select(*keys, *keep, F.col("ds").cast("date").alias("ds"), "y").withColumns({
        "_low": F.min("ds").over(whole), "_high": F.max("ds").over(whole), "_known": F.count("y").over(whole)})
    # Each known day covers the days up to the next known one, so a day and its neighbours are made
    # together: the calendar is never joined and no second pass looks ahead.
    rows = rows.where(F.col("y").isNotNull() | ((F.col("_known") == 0) & (F.col("ds") == F.col("_low"))))
    rows = rows.withColumns({"_yn": F.lead("y").over(series), "_dn": F.lead("ds").over(series),
                             "_first": F.lag("ds").over(series).isNull(), "_n": F.row_number().over(series)})
    begin = F.when(F.col("_first"), F.col("_low")).otherwise(F.col("ds"))
    until = F.greatest(begin, F.coalesce(F.date_sub("_dn", 1), F.col("_high")))
    # The days are made where the series already is, in its order, so the long rows are neither sorted nor moved.
    rows = rows.select(*keys, *keep, F.unix_date(begin).alias("_begin"), F.unix_date(until).alias("_until"),
                       F.unix_date("ds").alias("_day"), F.unix_date("_dn").alias("_ahead"), "y",
                       F.col("y").cast("double").alias("_y"), F.col("_yn").cast("double").alias("_yn"), "_n")
    rows = rows.sortWithinPartitions(*[F.col(k) for k in keys], "_n")
    same = keys + keep
    kept = df.select(*keys, *keep, F.col("ds").cast("date").alias("ds"), "y").schema
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in kept]).add("y_filled", "double")
    for k in range(1, lags + 1):
        schema = schema.add(f"lag_{k}", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            starts = np.flatnonzero(batch.column("_n").to_numpy() == 1)
            if len(starts) and (waiting or starts[-1]):
                yield from made([*waiting, batch.slice(0, starts[-1])])
                waiting = []
            waiting.append(batch.slice(starts[-1]) if len(starts) else batch)
        yield from made(waiting)

    def made(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The days of whole series, some ``DAYS_AT_ONCE`` at a time."""
        if not sum(p.num_rows for p in parts):
            return
        rows = pa.Table.from_batches(parts).combine_chunks()
        begin, until = (_numbers(rows[c]) for c in ("_begin", "_until"))
        days = np.where(np.isnan(begin[1]), 1, until[0] - begin[0] + 1).astype(np.int64)
        first = np.flatnonzero(rows["_n"].to_numpy() == 1)
        group = np.add.reduceat(days, first).cumsum() // DAYS_AT_ONCE
        cuts = first[np.flatnonzero(np.diff(group, prepend=-1))].tolist() + [len(days)]
        for a, b in zip(cuts, cuts[1:]):
            yield from _regular_days(rows.slice(a, b - a), days[a:b], same, linear, rolling, lags, drop_missing)

    return rows.mapInArrow(run, schema)


#: Days of a panel that are made together, apart from the last series of them.
DAYS_AT_ONCE = 200_000


def _numbers(column) -> tuple[np.ndarray, np.ndarray]:
    """Values (0 where null) and the same with NaN where null."""
    null = column.is_null().to_numpy(zero_copy_only=False) if column.null_count else np.zeros(len(column), bool)
    values = (column.fill_null(0) if column.null_count else column).to_numpy().astype(float)
    return values, np.where(null, np.nan, 0.0)


def _regular_days(rows, days: np.ndarray, same: Sequence[str], linear: int, rolling: int, lags: int, drop_missing: bool):
    """The daily rows of whole series out of their known days."""
    import pyarrow as pa

    total, at = int(days.sum()), np.repeat(np.arange(len(days)), days)
    (begin, no_day), (known, unknown_day), (ahead_day, no_next) = (_numbers(rows[c]) for c in ("_begin", "_day", "_ahead"))
    (y, no_y), (y_next, no_y_next) = (_numbers(rows[c]) for c in ("_y", "_yn"))
    within = np.arange(total) - np.repeat(days.cumsum() - days, days)
    day, dated = begin[at] + within, ~np.isnan(no_day)[at]
    series = (rows["_n"].to_numpy() == 1).cumsum()[at]
    if ((np.diff(day) < 0) & (np.diff(series) == 0)).any():  # a row without a day covers days of its own
        order = np.lexsort((np.where(dated, day, -np.inf), series))
        at, day, dated = at[order], day[order], dated[order]
    empty_y, empty_next, last = np.isnan(no_y)[at], np.isnan(no_y_next)[at], np.isnan(no_next)[at]
    placed = dated & ~np.isnan(unknown_day)[at]  # the distance to the known day is known
    back, ahead = day - known[at], ahead_day[at] - day
    itself = placed & (back == 0)
    near = placed & ((back <= linear) & (back > 0) | (back < 0) & (-back <= linear))
    between = placed & (back > 0) & ~last & (near | (ahead <= linear))
    alone = itself | near & ((back < 0) | last)
    with np.errstate(divide="ignore", invalid="ignore"):
        line = np.where(between, y[at] + (y_next[at] - y[at]) * back / (back + ahead), y[at])
    has = (alone & ~empty_y) | (between & ~empty_y & ~empty_next)

    # The frame of 2 * linear + rolling rows is a difference of running totals: one addition per row.
    start = np.flatnonzero(np.diff(series, prepend=0))
    end = np.append(start[1:], total)
    value = np.where(has, line, 0.0)
    sums, counts = np.empty(total), has.cumsum()
    for a, b in zip(start.tolist(), end.tolist()):
        np.cumsum(value[a:b], out=sums[a:b])
    lengths = end - start
    low, high = np.repeat(start, lengths), np.repeat(end, lengths)
    size = rolling + 2 * linear
    place = np.arange(total)
    to, since = np.minimum(place + (size - 1) // 2, high - 1), place - size // 2 - 1
    before = np.maximum(since, 0)
    held = counts[to] - np.where(since >= low, counts[before], np.where(low > 0, counts[low - 1], 0))
    with np.errstate(divide="ignore", invalid="ignore"):
        mean = (sums[to] - np.where(since >= low, sums[before], 0.0)) / held
    full = has | ((held >= 2 * linear) & (held > 0))
    filled = np.where(has, line, mean)
    columns = {c: rows[c].take(at) for c in same}
    columns["ds"] = pa.array(day.astype(np.int32), mask=~dated).cast(pa.date32())
    columns["y"] = rows["y"].take(pa.array(at, mask=~itself))
    columns["y_filled"] = pa.array(filled, mask=~full)
    for k in range(1, lags + 1):
        from_ = place - k
        columns[f"lag_{k}"] = pa.array(filled[np.maximum(from_, 0)], mask=(from_ < low) | ~full[np.maximum(from_, 0)])
    out = pa.table(columns)
    return (out.filter(pa.array(full)) if drop_missing else out).combine_chunks().to_batches()


def add_lags(df: DataFrame, keys: Sequence[str], n: int = N_LAGS, value: str = "y_filled") -> DataFrame:
    """``lag_1 .. lag_n`` of a daily series."""
    series = Window.partitionBy(*keys).orderBy("ds")
    return df.withColumns({f"lag_{k}": F.lag(value, k).over(series) for k in range(1, n + 1)})


def changepoints(n: int = N_CHANGEPOINTS, upto: float = CHANGEPOINT_RANGE) -> list[float]:
    """Positions of the trend changes, equally spaced over the first part of the train range."""
    return [upto * i / (n + 1) for i in range(1, n + 1)]


def relative_time(day: Column, first: Column, last: Column) -> Column:
    """0 on the first train day, 1 on the last."""
    span = F.datediff(last, first)
    return F.when(span == 0, F.lit(0.0)).otherwise(F.datediff(day, first) / span)


def _train_range(df: DataFrame, group: str, days: int) -> DataFrame:
    """Per group: last day, first and last day before the cut, largest absolute ``y``.  One pass over ``df``."""
    whole = Window.partitionBy(group)  # one row per calendar day
    by_day = df.groupBy(group, "ds").agg(F.max(F.abs("y")).alias("_y")).withColumn("_last", F.max("ds").over(whole))
    train_day = F.when(F.col("ds") < F.date_sub("_last", days), F.col("ds"))
    return by_day.groupBy(group).agg(F.max("_last").alias("_last"), F.min(train_day).alias("_from"),
                                     F.max(train_day).alias("_to"), F.max("_y").alias("_top"))


def trend_basis(df: DataFrame, group: str, n: int = N_CHANGEPOINTS, days: int = TEST_DAYS) -> DataFrame:
    """Relative time ``t`` and hinge columns ``hinge_1 .. hinge_n`` = max(t - changepoint, 0)."""
    ranged = joins.match_keys(df, _train_range(df, group, days), [group])
    ranged = ranged.withColumn("t", relative_time(F.col("ds"), F.col("_from"), F.col("_to")))
    ranged = ranged.drop("_last", "_from", "_to", "_top")
    return ranged.withColumns({f"hinge_{i}": F.greatest(F.col("t") - F.lit(c), F.lit(0.0))
                               for i, c in enumerate(changepoints(n), 1)})


def recency_weight(df: DataFrame, group: str, newest: float) -> DataFrame:
    """Weight 1 on the group's first day, growing linearly to ``newest`` on its last."""
    span = df.groupBy(group).agg(F.min("ds").alias("_from"), F.max("ds").alias("_to"))
    ranged = joins.match_keys(df, span, [group])
    weight = 1 + F.lit(float(newest) - 1) * relative_time(F.col("ds"), F.col("_from"), F.col("_to"))
    return ranged.withColumn("sample_weight", weight).drop("_from", "_to")


def _by_day(df: DataFrame, group: str, days: int) -> DataFrame:
    """Rows reduced to sums per group and day, with the day number ``t`` and the flag ``train``."""
    y = F.col("y")
    whole = Window.partitionBy(group)  # one row per calendar day
    sums = df.groupBy(group, "ds").agg(
        F.count(F.lit(1)).alias("rows"), F.count(y).alias("points"),
        F.sum(F.coalesce(y, F.lit(0.0))).alias("sy"), F.sum(F.coalesce(y * y, F.lit(0.0))).alias("syy"))
    return sums.withColumns({"train": F.col("ds") < F.date_sub(F.max("ds").over(whole), days),
                             "t": F.datediff("ds", F.min("ds").over(whole)).cast("double")})


def _line(n: Column, st: Column, stt: Column, sy: Column, sty: Column) -> tuple[Column, Column]:
    """Slope and intercept from (weighted) sums; null where undefined."""
    spread = n * stt - st * st
    slope = F.when(spread != 0, (n * sty - st * sy) / spread)
    return slope, (sy - slope * st) / F.when(n > 0, n)


def trend_forecast(df: DataFrame, group: str = "model_num", days: int = TEST_DAYS) -> DataFrame:
    """Straight-line fit per group on the train days and its RMSE on the test days.

    The line and its squared error follow from sums per group and day, so no group is ever gathered and
    only one small row per group and day is shuffled.  A missing ``y`` is left out of the fit and counts
    as 0 when scoring.
    """
    by_day = _by_day(df, group, days)
    whole = Window.partitionBy(group)
    n, t, sy, train = F.col("points"), F.col("t"), F.col("sy"), F.col("train")

    def over_train(value: Column) -> Column:
        return F.sum(F.when(train, value).otherwise(0.0)).over(whole)

    by_day = by_day.withColumns({"_n": over_train(n.cast("double")), "_st": over_train(n * t),
                                 "_stt": over_train(n * t * t), "_sy": over_train(sy), "_sty": over_train(sy * t)})
    slope, intercept = _line(*[F.col(c) for c in ("_n", "_st", "_stt", "_sy", "_sty")])
    by_day = by_day.withColumns({"slope": slope, "intercept": intercept})
    guess = F.coalesce(F.col("intercept") + F.col("slope") * t, F.lit(0.0))
    error = F.col("syy") - 2 * guess * sy + F.col("rows") * guess * guess
    tested = F.sum(F.when(~train, F.col("rows")))
    return by_day.groupBy(group).agg(
        F.sum("points").alias("num_datapoints"), F.max("slope").alias("slope"),
        F.coalesce(F.sqrt(F.greatest(F.sum(F.when(~train, error)), F.lit(0.0)) / tested),
                   F.lit(1000.0)).alias("RMSE"))


def trend_trials(df: DataFrame, group: str = "model_num", n_trials: int = 9, seed: int = 2025,
                 days: int = TEST_DAYS) -> DataFrame:
    """Recency-weighted lines for sampled weights: ``group, trial, newer_samples_weight, slope, RMSE``.

    The weight of a day is linear in the sampled value, so two sets of sums per group serve all trials.
    """
    by_day = _by_day(df, group, days)
    whole = Window.partitionBy(group)  # one row per calendar day
    newest = F.max(F.when(F.col("train"), F.col("t"))).over(whole)
    by_day = by_day.withColumn("age", F.when(newest > 0, F.col("t") / newest).otherwise(0.0))
    n, t, sy, rows = F.col("points").cast("double"), F.col("t"), F.col("sy"), F.col("rows").cast("double")
    fit = {"n": n, "t": n * t, "tt": n * t * t, "y": sy, "ty": sy * t}
    check = {"n": rows, "t": rows * t, "tt": rows * t * t, "y": sy, "ty": sy * t, "yy": F.col("syy")}
    sums = by_day.groupBy(group).agg(
        *[F.sum(F.when(F.col("train"), v).otherwise(0.0)).alias(f"plain_{k}") for k, v in fit.items()],
        *[F.sum(F.when(F.col("train"), v * F.col("age")).otherwise(0.0)).alias(f"aged_{k}") for k, v in fit.items()],
        *[F.sum(F.when(~F.col("train"), v).otherwise(0.0)).alias(f"test_{k}") for k, v in check.items()])
    tried = trials.sample(sums, group, {"newer_samples_weight": SEARCH_SPACE["newer_samples_weight"]}, n_trials, seed)
    extra = F.col("newer_samples_weight") - 1
    slope, intercept = _line(*[F.col(f"plain_{k}") + extra * F.col(f"aged_{k}") for k in fit])
    tried = tried.withColumns({"slope": slope, "_a": F.coalesce(intercept, F.lit(0.0))})
    a, b = F.col("_a"), F.coalesce(F.col("slope"), F.lit(0.0))
    test = {k: F.col(f"test_{k}") for k in check}
    error = (test["yy"] - 2 * a * test["y"] - 2 * b * test["ty"] + a * a * test["n"] + 2 * a * b * test["t"]
             + b * b * test["tt"])
    rmse = F.when(test["n"] > 0, F.sqrt(F.greatest(error, F.lit(0.0)) / test["n"])).otherwise(F.lit(1000.0))
    return tried.select(group, "trial", "newer_samples_weight", "slope", rmse.alias("RMSE"))


# --- search per model group -------------------------------------------------------------------------

SEARCH_SPACE = {
    "newer_samples_weight": trials.uniform(1, 7),
    "ridge": trials.log_uniform(1e-6, 1e-1),
    "ar_lags": trials.choice([1, 2, 3]),
}


def design(panel: DataFrame, n_changepoints: int = N_CHANGEPOINTS, n_lags: int = N_LAGS,
           days: int = TEST_DAYS) -> DataFrame:
    """Regular daily rows ``model_num, ID, ds, y, y_filled, lag_*, t, train, scale``."""
    ranged = joins.match_keys(panel, _train_range(panel, "model_num", days), ["model_num"])
    rows = regularize(ranged, ["model_num", "ID"], lags=n_lags, keep=["_last", "_from", "_to", "_top"])
    return rows.select(
        "model_num", "ID", "ds", "y", "y_filled", *[f"lag_{k}" for k in range(1, n_lags + 1)],
        F.coalesce(relative_time(F.col("ds"), F.col("_from"), F.col("_to")), F.lit(0.0)).alias("t"),
        (F.col("ds") < F.date_sub("_last", days)).alias("train"),
        F.when(F.col("_top") > 0, F.col("_top")).otherwise(1.0).alias("scale"))


def _basis(frame: pd.DataFrame, knots: np.ndarray, n_lags: int) -> np.ndarray:
    t = frame["t"].to_numpy(float)
    lags = frame[[f"lag_{k}" for k in range(1, n_lags + 1)]].to_numpy(float) / frame["scale"].to_numpy(float)[:, None]
    return np.column_stack([np.ones_like(t), t, np.maximum(t[:, None] - knots, 0.0), lags])


def moments(rows: DataFrame, n_changepoints: int = N_CHANGEPOINTS, n_lags: int = N_LAGS) -> DataFrame:
    """Cross products of the design per model: ``model_num, points, tested, unseen, scale, plain, aged, test``.

    They are all that a weighted least-squares fit and its test error need.  Tasks add up their own rows
    per model and send one short row per model, whatever the number of rows a model has.
    """
    knots = np.asarray(changepoints(n_changepoints))
    width = n_changepoints + n_lags + 3
    schema = ("model_num bigint, points bigint, tested bigint, unseen double, scale double, "
              "plain array<double>, aged array<double>, test array<double>")

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}
        for batch in batches:
            for model, part in batch.groupby("model_num", sort=False):
                x = _basis(part, knots, n_lags)
                scale = part["scale"].to_numpy(float)
                filled = part["y_filled"].to_numpy(float) / scale
                scored = part["y"].fillna(0.0).to_numpy(float) / scale
                train = part["train"].to_numpy(bool)
                whole = ~np.isnan(x).any(axis=1)
                fit = train & whole & ~np.isnan(filled)
                z = np.column_stack([x[fit], filled[fit]])
                age = np.clip(part["t"].to_numpy(float)[fit], 0.0, 1.0)
                seen, unseen = ~train & whole, ~train & ~whole
                v = np.column_stack([x[seen], scored[seen]])
                sums = held.setdefault(model, [0, 0, 0.0, scale[0]] + [np.zeros((width, width)) for _ in range(3)])
                sums[0] += int(part["y"].notna().sum())
                sums[1] += int((~train).sum())
                sums[2] += float(np.square(scored[unseen]).sum())
                sums[4] += z.T @ z
                sums[5] += (z * age[:, None]).T @ z
                sums[6] += v.T @ v
            if len(held) >= 2000:
                yield emit(held)
                held = {}
        if held:
            yield emit(held)

    def emit(held: dict[int, list]) -> pd.DataFrame:
        return pd.DataFrame([[m, s[0], s[1], s[2], s[3], *[a.ravel() for a in s[4:]]] for m, s in held.items()],
                            columns=["model_num", "points", "tested", "unseen", "scale", "plain", "aged", "test"])

    def total(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([[key[0], part["points"].sum(), part["tested"].sum(), part["unseen"].sum(),
                              part["scale"].max(), *[np.sum(np.stack(part[c].to_list()), axis=0)
                                                     for c in ("plain", "aged", "test")]]], columns=part.columns)

    # dates would become Python objects
    used = rows.select("model_num", "y", "y_filled", *[f"lag_{k}" for k in range(1, n_lags + 1)], "t", "train", "scale")
    partials = used.mapInPandas(partial, schema)
    return partials.groupBy("model_num").applyInPandas(total, schema)  # one short row per task in a group


def _solve(plain: np.ndarray, aged: np.ndarray, test: np.ndarray, newest: float, ridge: float, lags: int,
           n_lags: int) -> float:
    """Test squared error of the ridge fit with the given recency weight, number of lags and penalty."""
    p = plain.shape[0] - 1
    use = np.arange(p - n_lags + lags)
    gram = plain + (newest - 1.0) * aged
    size = np.sqrt(np.maximum(np.diag(gram)[use], 1e-12))
    left = gram[np.ix_(use, use)] / np.outer(size, size)
    left[np.diag_indices_from(left)] += ridge
    beta = np.linalg.solve(left, gram[use, p] / size) / size
    return float(test[p, p] - 2.0 * beta @ test[use, p] + beta @ test[np.ix_(use, use)] @ beta)


def score_trials(tried: DataFrame, n_lags: int = N_LAGS) -> DataFrame:
    """Add ``RMSE`` and ``seconds`` to rows that hold a model's cross products and a configuration."""

    def score(*cols: pd.Series) -> pd.DataFrame:
        out = []
        for tested, unseen, scale, plain, aged, test, newest, ridge, lags in zip(*cols):
            began = time.perf_counter()
            width = int(round(len(plain) ** 0.5))
            shaped = [np.asarray(a, float).reshape(width, width) for a in (plain, aged, test)]
            error = _solve(*shaped, newest, ridge, int(lags), n_lags) + unseen
            value = scale * np.sqrt(max(error, 0.0) / tested) if tested else float("nan")
            out.append((1000.0 if np.isnan(value) else value, time.perf_counter() - began))
        return pd.DataFrame(out, columns=["RMSE", "seconds"])

    udf = F.pandas_udf(score, "RMSE double, seconds double")
    scored = tried.withColumn("_s", udf("tested", "unseen", "scale", "plain", "aged", "test",
                                        "newer_samples_weight", "ridge", "ar_lags"))
    return scored.withColumns({"RMSE": F.col("_s.RMSE"), "seconds": F.col("_s.seconds")}).drop("_s")


def group_trials(sums: DataFrame, n_trials: int = 9, seed: int = 2025) -> DataFrame:
    """Fit every trial of every model: ``model_num, trial, <params>, num_datapoints, RMSE, seconds``."""
    scored = score_trials(trials.sample(sums, "model_num", SEARCH_SPACE, n_trials, seed))
    return scored.select("model_num", "trial", *SEARCH_SPACE, F.col("points").alias("num_datapoints"), "RMSE", "seconds")


def guided_trials(sums: DataFrame, n_trials: int = 12, seed: int = 2025) -> DataFrame:
    """Like ``group_trials``, but later trials of a model learn from its earlier ones; all lags are used."""
    sums = sums.checkpoint()  # one short row per model, read in every round

    def evaluate(asked: DataFrame) -> DataFrame:
        rows = joins.match_keys(asked, sums, ["model_num"]).withColumn("ar_lags", F.lit(N_LAGS))
        return score_trials(rows).withColumn("loss", F.col("RMSE"))

    ranges = {"newer_samples_weight": trials.Range(1, 7), "ridge": trials.Range(1e-6, 1e-1, log=True)}
    return trials.guided_search(sums, "model_num", ranges, evaluate, n_trials, seed=seed)


def fit_groups(panel: DataFrame, n_trials: int = 9, seed: int = 2025) -> DataFrame:
    """Search per model: ``model_num, model_HPT_time, num_datapoints, RMSE, space`` of the best trial."""
    log = group_trials(moments(design(panel)), n_trials, seed)
    params = F.to_json(F.struct(*SEARCH_SPACE))
    log = log.withColumn("space", params)
    return log.groupBy("model_num").agg(
        F.sum("seconds").cast("string").alias("model_HPT_time"), F.max("num_datapoints").alias("num_datapoints"),
        F.min("RMSE").alias("RMSE"), F.expr("min_by(space, struct(RMSE, trial))").alias("space"))
