"""Comparison of a query with its SQL on the same tables."""

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir, f"{t}.parquet")
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}/*.parquet')" if p.is_dir() else f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    clean = lambda v: round(v, 6) + 0.0 if isinstance(v, float) and not math.isnan(v) else v
    return sorted([tuple(clean(r[i]) for i in order) for r in data], key=repr)


def compare(frame, con, sql):
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    want = rows(names, found.fetchall())
    assert sorted(names) == sorted(frame.columns)
    got = rows(frame.columns, [tuple(r) for r in frame.collect()])
    assert len(got) == len(want), (len(got), len(want))
    wrong = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
    assert not wrong, (len(wrong), wrong[:3])
    return len(got)
