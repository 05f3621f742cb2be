"""The table of named queries and of the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a plan under ``name``; ``sql`` computes the same rows in an independent engine."""
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


def sql_uniform(seed: int, key: str, name: str) -> str:
    """SQL text of ``hash_uniform``; ``key`` is an SQL string expression."""
    return f"(('0x' || substr(md5('{seed}:' || {key} || ':{name}'), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"
