"""Compare a query with its SQL counterpart in DuckDB: columns, row count, values."""

import duckdb
import numpy as np
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and np.isnan(value)) or value is pd.NA:
        return None
    if isinstance(value, (bool, np.bool_)):
        return bool(value)
    if isinstance(value, (int, float, np.integer, np.floating)):
        return round(float(value), 6)
    return str(value)


def normal(frame):
    frame = frame[sorted(frame.columns)]
    rows = [tuple(_cell(v) for v in row) for row in frame.itertuples(index=False)]
    return list(frame.columns), sorted(rows, key=repr)


def difference(spark_frame, con, sql):
    """None when both agree, else a short text."""
    mine, theirs = normal(spark_frame.toPandas()), normal(con.execute(sql).df())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} <> {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"rows {len(mine[1])} <> {len(theirs[1])}"
    for a, b in zip(mine[1], theirs[1]):
        if a != b:
            return f"{mine[0]}: {a} <> {b}"
    return None
