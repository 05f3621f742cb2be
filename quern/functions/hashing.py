"""Uniform draws that depend only on (seed, key, name).

A draw is the first 32 bits of an md5, so a row gets the same value whatever the partitioning, on a
re-run after a lost executor, and in any other engine that has md5.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_uniform(seed: int | str, key: Column | str, name: str) -> Column:
    """A double in [0, 1) from ``md5(seed:key:name)``."""
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string"), F.lit(name)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def joined_key(*cols: str) -> Column:
    """One string key out of several columns."""
    return F.concat_ws("-", *[F.col(c).cast("string") for c in cols])


def uniform(u: Column, lo: float, hi: float) -> Column:
    return F.lit(float(lo)) + u * F.lit(float(hi) - float(lo))


def log_uniform(u: Column, lo: float, hi: float) -> Column:
    base = math.log(lo)
    return F.exp(F.lit(base) + u * F.lit(math.log(hi) - base))


def stepped(u: Column, lo: float, hi: float, step: float) -> Column:
    """lo, lo + step, ... up to the last value not above hi (both ends reachable)."""
    count = math.floor((hi - lo) / step + 1e-9) + 1
    return F.lit(float(lo)) + F.lit(float(step)) * F.floor(u * F.lit(float(count)))


def integer(u: Column, lo: int, hi: int) -> Column:
    """Integers lo..hi, both included."""
    return (F.lit(lo) + F.floor(u * F.lit(float(hi - lo + 1)))).cast("int")


def log_integer(u: Column, lo: int, hi: int) -> Column:
    """Integers lo..hi, both included, uniform on the log scale."""
    return F.floor(log_uniform(u, lo, hi + 1)).cast("int")


def pick(u: Column, values: Sequence | Column) -> Column:
    """One of ``values`` (an array column or a list of literals; list values become arrays)."""
    if not isinstance(values, Column):
        values = F.array(*[F.array(*[F.lit(x) for x in v]) if isinstance(v, (list, tuple)) else F.lit(v)
                           for v in values])
    return F.element_at(values, (F.floor(u * F.size(values)) + 1).cast("int"))
