"""The comparison of a query with its SQL."""

from __future__ import annotations

import duckdb
import pandas as pd

TINY, SMALL = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def tidy(frame: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples, columns by name, numbers and nulls made comparable."""

    def value(x):
        if isinstance(x, (list, tuple)) or hasattr(x, "tolist") and getattr(x, "ndim", 0):
            return tuple(value(v) for v in x)
        if x is None or x is pd.NA or isinstance(x, float) and x != x or x is pd.NaT:
            return None
        if isinstance(x, bool):
            return x
        return round(float(x), 6) if hasattr(x, "__float__") and not isinstance(x, str) else x

    columns = sorted(frame.columns)
    return sorted((tuple(value(x) for x in row) for row in frame[columns].itertuples(index=False)), key=repr)


def in_duckdb(sql: str, sf_dir: str) -> pd.DataFrame:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con.execute(sql).df()


def same_as_sql(spark, query, sql: str, sf_dir: str = TINY) -> int:
    """Asserts that a query and its SQL give the same columns and rows; returns how many."""
    ours, theirs = query(spark, sf_dir).toPandas(), in_duckdb(sql, sf_dir)
    assert sorted(ours.columns) == sorted(theirs.columns)
    a, b = tidy(ours), tidy(theirs)
    assert len(a) == len(b)
    assert a == b
    return len(a)
