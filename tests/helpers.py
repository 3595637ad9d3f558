"""Comparison of a query with its SQL, as rows with columns sorted by name."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF = "/root/testdata/sf0.001"


def by_sql(sql, sf=SF):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS FROM '{sf}/{t}.parquet'")
    rel = con.sql(sql)
    order = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    return sorted(rel.columns), sorted(repr(tuple(r[i] for i in order)) for r in rel.fetchall())


def by_spark(df):
    cols = sorted(df.columns)
    return cols, sorted(repr(tuple(r[c] for c in cols)) for r in df.collect())
