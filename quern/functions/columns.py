"""Column expressions used by more than one operator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fill_missing(value: Column | str, default: float) -> Column:
    """Null and NaN become ``default``."""
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.nanvl(value.cast("double"), F.lit(None).cast("double")), F.lit(float(default)))


def strip_prefix(value: Column | str, prefix: str) -> Column:
    """Drop ``prefix`` where the text starts with it."""
    value = F.col(value) if isinstance(value, str) else value
    rest = F.substr(value, F.lit(len(prefix) + 1))
    return F.when(value.startswith(prefix), rest).otherwise(value)


def normalize_array(values: Column | str, mean: float, std: float) -> Column:
    """(x - mean) / std for every entry."""
    values = F.col(values) if isinstance(values, str) else values
    return F.transform(values, lambda x: (x.cast("double") - F.lit(float(mean))) / F.lit(float(std)))
