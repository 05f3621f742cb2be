"""Ordered computations whose groups may be too large for one task.

A Spark window puts a whole group into one task.  ``running_sums`` keeps that plan while the input is
small enough and otherwise sorts by range: groups are cut into slices of about equal size, each slice
is summed on its own, and the (few) slice totals give every slice its starting value.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.session import ensure_checkpoint_dir

MAX_TASK_ROWS = 4_000_000


def running_sums(df: DataFrame, order: Sequence[str], sums: Mapping[str, str | Column],
                 groups: Sequence[str] = (), max_task_rows: int = MAX_TASK_ROWS,
                 at_most: int | None = None) -> DataFrame:
    """Add, per output name, the sum of its input over the earlier rows of the row's group.

    ``groups + order`` must be unique.  ``at_most`` is a known bound on the rows, for a plain scan its
    count; without it the input is checkpointed and counted, which suits inputs that are costly to
    compute twice.  Range bounds are sampled, so slices are checkpointed before they are used twice.
    """
    ensure_checkpoint_dir(df.sparkSession)
    groups, order = list(groups), list(order)
    work = {f"_in_{name}": F.expr(c) if isinstance(c, str) else c for name, c in sums.items()}
    keep = df.columns
    df = df.withColumns(work)
    if at_most is None:
        df = df.checkpoint()
        at_most = df.count()

    def before(window):
        return {name: F.coalesce(F.sum(f"_in_{name}").over(window), F.lit(0)) for name in sums}

    if at_most <= max_task_rows:
        window = Window.partitionBy(*groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumns(before(window)).select(*keep, *sums)

    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-at_most // max_task_rows))
    sliced = (df.repartitionByRange(parts, *groups, *order)
              .withColumn("_slice", F.spark_partition_id()).checkpoint())
    totals = sliced.groupBy(*groups, "_slice").agg(*[F.sum(c).alias(c) for c in work])
    across = Window.partitionBy(*groups).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *[F.col(g).alias(f"_g_{g}") for g in groups], F.col("_slice").alias("_s"),
        *[F.coalesce(F.sum(f"_in_{name}").over(across), F.lit(0)).alias(f"_start_{name}") for name in sums])
    same = F.col("_slice") == F.col("_s")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    within = (Window.partitionBy(*groups, "_slice").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    local = before(within)
    return (sliced.withColumns(local).join(starts, same, "inner")
            .select(*keep, *[(F.col(name) + F.col(f"_start_{name}")).alias(name) for name in sums]))


def row_numbers(df: DataFrame, order: Sequence[str], out: str, groups: Sequence[str] = (),
                max_task_rows: int = MAX_TASK_ROWS, at_most: int | None = None) -> DataFrame:
    """1, 2, 3, ... within each group; ``groups + order`` must be unique."""
    counted = running_sums(df, order, {out: F.lit(1).cast("long")}, groups, max_task_rows, at_most)
    return counted.withColumn(out, F.col(out) + 1)


ACCURACY = 10_000


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                    max_task_rows: int = MAX_TASK_ROWS, accuracy: int = ACCURACY) -> DataFrame:
    """Exact interpolated quantiles, one row per column: ``column, n, q_0, q_1, ...``.  NaN is left out.

    A first pass sketches a bracket around every quantile, a second counts what lies below and in it.  A bracket
    of one value is the quantile itself; of the others only the values inside, a few in ten thousand, become
    rows, which are ranked.  A quantile outside its bracket shows in the counts and is looked for among all values.
    """
    columns, probs = list(columns), list(probs)
    held = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    margin = 4.0 / accuracy
    edges = [min(max(p + side, 0.0), 1.0) for p in probs for side in (-margin, margin)]
    sketch = df.agg(*[F.count(v).alias(f"n_{c}") for c, v in held.items()],
                    *[F.percentile_approx(v, edges, accuracy).alias(f"e_{c}") for c, v in held.items()]).first()
    sizes = {c: sketch[f"n_{c}"] for c in columns}
    everything = (float("-inf"), float("inf"))
    brackets = {(c, i): (sketch[f"e_{c}"][2 * i], sketch[f"e_{c}"][2 * i + 1]) if sizes[c] > accuracy else everything
                for c in columns if sizes[c] for i in range(len(probs))}
    found = _within(df, held, sizes, probs, brackets, max_task_rows)
    missed = {slot: everything for slot in brackets if slot not in found}
    if missed:
        found.update(_within(df, held, sizes, probs, missed, max_task_rows))
    rows = [(c, sizes[c], *[found.get((c, i)) for i in range(len(probs))]) for c in columns]
    return df.sparkSession.createDataFrame(
        rows, ", ".join(["column string", "n bigint"] + [f"q_{i} double" for i in range(len(probs))]))


def _within(df: DataFrame, held: Mapping[str, Column], sizes: Mapping[str, int], probs: Sequence[float],
            brackets: Mapping[tuple[str, int], tuple[float, float]], max_task_rows: int) -> dict:
    """The quantiles that lie in their bracket, by (column, index of the probability)."""
    if not brackets:
        return {}
    slots = list(brackets)
    place = [(sizes[c] - 1) * probs[i] for c, i in slots]
    values = [held[c] for c, _ in slots]
    counts = df.agg(*[F.count_if(v < F.lit(brackets[s][0])).alias(f"b_{k}") for k, (s, v) in enumerate(zip(slots, values))],
                    *[F.count_if(v <= F.lit(brackets[s][1])).alias(f"u_{k}") for k, (s, v) in enumerate(zip(slots, values))]
                    ).first()
    out, ranked = {}, []
    for k, slot in enumerate(slots):
        if not counts[f"b_{k}"] <= math.floor(place[k]) <= math.ceil(place[k]) < counts[f"u_{k}"]:
            continue  # not in its bracket
        low, high = brackets[slot]
        if low == high:
            out[slot] = low
        else:
            ranked.append(k)
    if not ranked:
        return out

    inside = {k: (values[k] >= F.lit(brackets[slots[k]][0])) & (values[k] <= F.lit(brackets[slots[k]][1])) for k in ranked}
    entries = [F.struct(F.lit(k).alias("slot"), F.when(inside[k], values[k]).alias("key")) for k in ranked]
    few = df.where(reduce(or_, inside.values())).select(F.inline(F.array(*entries))).where(F.col("key").isNotNull())
    keys = few.groupBy("slot", "key").agg(F.count(F.lit(1)).alias("copies"))
    total = sum(counts[f"u_{k}"] - counts[f"b_{k}"] for k in ranked)
    placed = running_sums(keys, ["key"], {"before": "copies"}, ["slot"], max_task_rows,
                          total if total <= max_task_rows else None)
    spots = {k: place[k] - counts[f"b_{k}"] for k in ranked}
    spot = F.element_at(F.create_map(*[F.lit(x) for k in ranked for x in (k, float(spots[k]))]), F.col("slot"))

    def at(x: Column) -> Column:
        return F.max(F.when((F.col("before") <= x) & (x < F.col("before") + F.col("copies")), F.col("key")))

    for r in placed.groupBy("slot").agg(at(F.floor(spot)).alias("low"), at(F.ceil(spot)).alias("high")).collect():
        x = place[r["slot"]]
        low, high = r["low"], r["high"]
        out[slots[r["slot"]]] = low if low == high else low + (high - low) * (x - int(x))
    return out
