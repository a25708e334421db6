"""Row-by-row comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def both(spark, con, query, sql, sf_dir):
    """((columns, rows) of Spark, (columns, rows) of DuckDB), columns by name and rows sorted."""
    df = query(spark, sf_dir)
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    theirs = _rows([d[0] for d in result.description], result.fetchall())
    return ours, theirs
