"""Spark result against DuckDB result: column names and the bag of rows."""

from collections import Counter
from pathlib import Path

import duckdb

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


def duck_rows(sql, sf_dir):
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    relation = con.sql(sql)
    return relation.columns, [str(t) for t in relation.types], relation.fetchall()


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(row[i] for i in order) for row in rows)


def assert_same(df, sql, sf_dir):
    columns, _, expected = duck_rows(sql, sf_dir)
    names, got = bag(df.columns, [tuple(r) for r in df.collect()])
    wanted_names, wanted = bag(columns, expected)
    assert names == wanted_names
    assert got == wanted, (list((got - wanted).items())[:5], list((wanted - got).items())[:5])
    return sum(got.values())
