"""Holds a query's result against its SQL in DuckDB, rows as multisets."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def compare(spark, query, sql: str, sf_dir: str) -> tuple[int, int, list]:
    """Rows here, rows there, and up to five differing rows."""
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df = query(spark, sf_dir)
    columns = sorted(df.columns)
    mine = Counter(tuple(_plain(v) for v in row) for row in df.select(*columns).collect())
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == columns, (sorted(names), columns)
    order = [names.index(c) for c in columns]
    theirs = Counter(tuple(_plain(row[i]) for i in order) for row in found.fetchall())
    return sum(mine.values()), sum(theirs.values()), [("here", r) for r in (mine - theirs)][:5] + [("there", r) for r in (theirs - mine)][:5]
