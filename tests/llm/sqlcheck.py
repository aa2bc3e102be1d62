"""Compares a registered query with its SQL over the tables of a folder."""

import duckdb

import __spark_entry__ as entry
from test_contract import TABLES, canon


def matches_sql(spark, key: str, folder: str) -> int:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    df = entry.queries()[key](spark, folder)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[key])
    names, want = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert len(rows) == len(want)
    assert canon(df.columns, rows) == canon(names, want)
    return len(rows)
