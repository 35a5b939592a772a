"""Run a query on Spark and its SQL on DuckDB, and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "null" if math.isnan(value) else f"{value:.6g}"
    if isinstance(value, bool) or value is None:
        return str(value).lower().replace("none", "null")
    if isinstance(value, int):
        return f"{float(value):.6g}" if abs(value) < 1 << 50 else str(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat(" ")
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(plain, value)) + "]"
    return str(value)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted(tuple(map(plain, r)) for r in df.select(*names).collect())


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    names = [x[0] for x in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(plain(r[i]) for i in order) for r in result.fetchall())
