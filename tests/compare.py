"""Order-free comparison of a Spark result with a SQL result."""

from __future__ import annotations

import glob
import os
from datetime import date, datetime
from decimal import Decimal

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"create view {name} as select * from read_parquet('{files}')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return f"{value.normalize():f}" if value else "0"
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(
        (tuple(plain(row[i]) for i in order) for row in rows), key=lambda r: tuple(map(str, r))
    )


def spark_result(frame):
    return canonical(frame.columns, [tuple(r) for r in frame.collect()])


def sql_result(con, sql):
    cursor = con.execute(sql)
    return canonical([d[0] for d in cursor.description], cursor.fetchall())


SAME_TYPE = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def spark_types(frame):
    return {n: SAME_TYPE.get(t, t.upper().replace(",", ", ")) for n, t in frame.dtypes}


def sql_types(con, sql):
    described = con.execute(f"describe {sql}").fetchall()
    return {row[0]: row[1].replace(", ", ",").replace(",", ", ") for row in described}
