"""Compares a query with its SQL in DuckDB, as the driver does: rows in any order, columns by name."""

from pathlib import Path

import duckdb

SF = "/root/testdata/sf0.001"


def connected(sf=SF):
    con = duckdb.connect()
    for path in Path(sf).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def rows(frame):
    columns = sorted(frame.columns)
    clean = frame[columns].astype(object).where(frame[columns].notna(), None)
    return columns, sorted(tuple(f"{v:.6g}" if isinstance(v, float) else str(v) for v in row) for row in clean.values.tolist())


def same(spark, query, sql, sf=SF):
    assert rows(query(spark, sf).toPandas()) == rows(connected(sf).sql(sql).df())
