"""Registered queries against their SQL in an independent engine, on the smallest tables."""

import os

import duckdb

from estrato.llm import queries

SF = "/root/testdata/sf0.001"


def same_as_sql(spark, name):
    engine = duckdb.connect()
    for file in os.listdir(SF):
        engine.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF}/{file}'")
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    cursor = engine.execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    theirs = sorted((tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall()), key=str)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str) == theirs
    engine.close()
