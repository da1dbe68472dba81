"""Compares a query with its oracle over a data folder: equal rows in any order, columns by name."""

from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SMALL = "/root/testdata/sf0.001"


def connection(sf_dir=SMALL):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def _cell(x):
    if x is None or x != x:
        return "null"
    if isinstance(x, Decimal):
        x = int(x) if x == int(x) else float(x)
    return repr(round(x, 9)) if isinstance(x, float) else str(x)


def rows(columns, tuples):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(t[i]) for i in order) for t in tuples)


def agree(spark, query, sql, sf_dir=SMALL):
    df, relation = query(spark, sf_dir), connection(sf_dir).sql(sql)
    got, want = rows(df.columns, df.collect()), rows(relation.columns, relation.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
