"""Spark's rows beside DuckDB's, in any order."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v if v is None or isinstance(v, (int, str, bool)) else str(v)


def both(df, sql, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    columns = sorted(names)
    want = sorted((tuple(cell(r[names.index(c)]) for c in columns) for r in cur.fetchall()), key=repr)
    got = sorted((tuple(cell(r[c]) for c in columns) for r in df.collect()), key=repr)
    return got, want
