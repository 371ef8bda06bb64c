"""Run a registered query in Spark and its SQL in DuckDB, and compare the rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb

SF_DIR = os.environ.get("FOLIOFLOW_SF_DIR", "/root/testdata/sf0.01")


def connect(sf_dir: str = SF_DIR):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df):
    return sorted(df.columns), canonical(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql: str):
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    return sorted(columns), canonical(columns, result.fetchall())


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def compare(df, con, sql: str) -> None:
    left_columns, left = spark_rows(df)
    right_columns, right = duck_rows(con, sql)
    assert left_columns == right_columns, (left_columns, right_columns)
    assert len(left) == len(right), f"rows: spark {len(left)}, duckdb {len(right)}"
    for a, b in zip(left, right):
        assert a == b, f"spark {a!r}\nduckdb {b!r}"
    duck_types = {c[0]: str(c[1]) for c in con.execute(f"DESCRIBE {sql}").fetchall()}
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == duck_types, (df.dtypes, duck_types)
