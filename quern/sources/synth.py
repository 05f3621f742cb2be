"""Synthetic tables drawn from a column specification."""

from __future__ import annotations

import datetime
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import hashing, ordering

MAX_LITERAL_VALUES = 1000
EPOCH = datetime.date(1970, 1, 1)


def synth_table(spark: SparkSession, rows: int, spec: Mapping[str, dict], seed: int = 2025,
                partitions: int | None = None) -> DataFrame:
    """``rows`` random rows ``row_id, <spec columns>``.

    A column is ``{"min", "max", "step"}`` (a double, or of its ``"type"``; days since 1970 for dates and
    timestamps), ``{"values": [...]}`` or ``{"domain": frame}`` with one column of distinct values; the last kind may have any size and is
    joined by position.
    """
    out = spark.range(0, rows, 1, partitions).withColumnRenamed("id", "row_id") if partitions \
        else spark.range(rows).withColumnRenamed("id", "row_id")
    exprs, joins = {}, []
    for name, column in spec.items():
        u = hashing.hash_uniform(seed, "row_id", name)
        if "domain" in column:
            joins.append((name, column["domain"], u))
        elif "values" in column:
            picked = hashing.pick(u, column["values"])
            exprs[name] = picked.cast(column["type"]) if "type" in column else picked
        else:
            number = hashing.stepped(u, column["min"], column["max"], column.get("step", 1))
            kind = column.get("type", "double")
            if kind in ("date", "timestamp", "timestamp_ntz"):
                number = F.date_add(F.lit(EPOCH), number.cast("int"))
            exprs[name] = number.cast(kind)
    out = out.withColumns(exprs)
    for name, domain, u in joins:
        source = domain.columns[0]
        numbered = ordering.row_numbers(domain, [source], "_pos").withColumnRenamed(source, name)
        size = numbered.count()
        position = (F.floor(u * F.lit(float(size))) + 1).cast("long")
        out = out.withColumn("_pos", position).join(numbered, "_pos").drop("_pos")
    return out.select("row_id", *spec)


def synth_spec_from(df: DataFrame, exclude: tuple[str, ...] = (), steps: Mapping[str, float] | None = None,
                    max_literal: int = MAX_LITERAL_VALUES) -> dict[str, dict]:
    """Specification with the ranges of numeric and date columns and the domains of string columns.

    Whole numbers and dates keep their type; a timestamp is drawn as the start of a day.
    """
    steps = steps or {}
    types = {f.name: f.dataType.typeName() for f in df.schema.fields if f.name not in exclude}
    numeric = [n for n, t in types.items() if t in ("double", "float", "integer", "long", "short")]
    times = [n for n, t in types.items() if t in ("date", "timestamp", "timestamp_ntz")]
    strings = [n for n, t in types.items() if t == "string"]
    bounds = df.agg(*[F.min(c).alias(f"lo_{c}") for c in numeric], *[F.max(c).alias(f"hi_{c}") for c in numeric],
                    *[f(F.date_diff(F.col(c).cast("date"), F.lit(EPOCH))).alias(f"{x}_{c}")
                      for c in times for x, f in (("lo", F.min), ("hi", F.max))],
                    *[F.approx_count_distinct(c).alias(f"n_{c}") for c in strings]).first()
    spec: dict[str, dict] = {}
    for field in df.schema.fields:
        name = field.name
        if name in numeric or name in times:
            if bounds[f"lo_{name}"] is None:
                spec[name] = {"values": [None], "type": "double" if name in numeric else types[name]}
            else:
                spec[name] = {"min": float(bounds[f"lo_{name}"]), "max": float(bounds[f"hi_{name}"]),
                              "step": steps.get(name, 1)}
                if types[name] not in ("double", "float"):
                    spec[name]["type"] = types[name]
        elif name in strings:
            domain = df.select(name).where(F.col(name).isNotNull()).distinct()
            if bounds[f"n_{name}"] > max_literal:
                spec[name] = {"domain": domain}
                continue
            head = domain.limit(2 * max_literal).collect()
            if len(head) < 2 * max_literal:
                values = sorted(r[0] for r in head)
                spec[name] = {"values": values} if values else {"values": [None], "type": "string"}
            else:
                spec[name] = {"domain": domain}
    return spec
