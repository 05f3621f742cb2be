"""Compare named queries with their SQL on one folder of tables.

Run as ``python tests/oracle.py [folder] [name ...]``.
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def kind(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, datetime.datetime):
        return "datetime"
    return type(value).__name__


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else (0.0 if value == 0 else value)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(normal(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark, con, folder: str, name: str, plan, sql: str) -> list[str]:
    """Differences, empty if equal."""
    frame = plan(spark, folder)
    mine = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    other = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if mine[0] != other[0]:
        return [f"columns {mine[0]} != {other[0]}"]
    problems = []
    if len(mine[1]) != len(other[1]):
        problems.append(f"rows {len(mine[1])} != {len(other[1])}")
    for c in range(len(mine[0])):
        kinds = [{kind(r[c]) for r in side[1]} - {"null"} for side in (mine, other)]
        if all(kinds) and kinds[0] != kinds[1]:
            problems.append(f"type of {mine[0][c]}: {kinds}")
    different = [(a, b) for a, b in zip(mine[1], other[1]) if a != b]
    if different:
        problems.append(f"{len(different)} rows differ, first {different[:2]}")
    return problems


if __name__ == "__main__":
    import __spark_entry__ as contract
    from quern.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(contract.queries())
    spark = build_session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
                          spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    for name in names:
        began = time.time()
        try:
            plan, sql = contract.queries()[name], contract.oracle_sql().get(name)
            if sql is None:
                rows = plan(spark, folder).collect()
                print(f"rows  {name} {len(rows)} {time.time() - began:.1f}s {rows[:1]}", flush=True)
                continue
            problems = compare(spark, con, folder, name, plan, sql)
            print(f"{'FAIL' if problems else 'ok'}  {name} {time.time() - began:.1f}s {' | '.join(problems)[:600]}", flush=True)
        except Exception as error:
            print(f"ERROR {name} {time.time() - began:.1f}s {str(error)[:700]}", flush=True)
