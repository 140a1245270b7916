"""Compare a Spark result with its oracle in DuckDB: columns, types, and the bag of rows."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb

KINDS = {
    "int64": "int", "int32": "int", "int16": "int", "uint64": "int", "double": "float", "float": "float",
    "string": "text", "large_string": "text", "bool": "bool", "date32[day]": "date",
    "timestamp[us]": "timestamp", "timestamp[ns]": "timestamp",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def kinds(table) -> dict[str, str]:
    return {f.name: KINDS.get(str(f.type), str(f.type)) for f in table.schema}


def rows(table) -> Counter:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return Counter(zip(*columns))


def differences(spark_df, sql: str, con) -> str | None:
    got, want = spark_df.toArrow(), con.sql(sql).to_arrow_table()
    if kinds(got) != kinds(want):
        return f"columns {kinds(got)} against {kinds(want)}"
    if got.num_rows == 0:
        return "no rows"
    left, right = rows(got), rows(want)
    if left != right:
        only_left, only_right = left - right, right - left
        return f"{sum(only_left.values())} rows only in Spark {list(only_left)[:3]}, {sum(only_right.values())} only in SQL {list(only_right)[:3]}"
    return None
