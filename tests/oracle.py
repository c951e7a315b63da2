"""Rows of a query and of its SQL, made comparable."""

import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{name}'")
    return con


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: round(v, 9) if isinstance(v, float) else list(v) if isinstance(v, (list, tuple)) else v
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=repr)


def same(spark, sf_dir, query, sql):
    df = query(spark, sf_dir)
    cur = connect(sf_dir).execute(sql)
    names = [x[0] for x in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(names, cur.fetchall())
