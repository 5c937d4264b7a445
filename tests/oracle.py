"""Comparison of a Spark result with the same query in DuckDB: rows as multisets."""

import math
from collections import Counter
from datetime import datetime
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir):
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return db


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    return value


def as_multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df, db, sql):
    """None where equal, else what differs."""
    answer = db.execute(sql)
    names = [part[0] for part in answer.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    ours = as_multiset(df.columns, [tuple(row) for row in df.collect()])
    theirs = as_multiset(names, answer.fetchall())
    if ours == theirs:
        return None
    return (f"{sum(ours.values())} / {sum(theirs.values())} rows; "
            f"only ours {list((ours - theirs).items())[:2]}; only theirs {list((theirs - ours).items())[:2]}")
