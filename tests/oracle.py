"""Running a query and its SQL side by side."""

from collections import Counter
from pathlib import Path

import duckdb
import numpy as np


def connect(sf_dir):
    con = duckdb.connect()
    for p in Path(sf_dir).iterdir():
        files = f"{p}/*.parquet" if p.is_dir() else str(p)
        con.execute(f"CREATE VIEW {p.name.split('.')[0]} AS SELECT * FROM '{files}'")
    return con


def value(x):
    if x is None or isinstance(x, float) and x != x:
        return "null"
    if isinstance(x, (list, np.ndarray)):
        return "[" + ",".join(map(value, x)) + "]"
    if isinstance(x, float):
        return str(int(x)) if x == int(x) and abs(x) < 1e15 else repr(x)
    return str(x)


def compare(df, con, sql):
    cols = sorted(df.columns)
    ours = Counter(tuple(value(r[c]) for c in cols) for r in df.collect())
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    assert sorted(names) == cols
    theirs = Counter(tuple(value(row[names.index(c)]) for c in cols) for row in cur.fetchall())
    assert ours == theirs, (list((ours - theirs).items())[:3], list((theirs - ours).items())[:3])
    return sum(ours.values())
