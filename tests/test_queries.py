import math

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry, oracle_sql, queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return f"{float(value):.6f}"
    return str(value)


def rows(frame):
    names = sorted(frame.columns)
    return names, sorted(tuple(map(plain, r)) for r in frame[names].itertuples(index=False))


# tests/llm tests the training-data queries.
@pytest.mark.parametrize("name", [n for n in queries() if n != "pipeline" and not n.startswith("op")])
def test_query(spark, sf_dir, duck, name):
    frame = queries()[name](spark, sf_dir).toPandas()
    sql = oracle_sql().get(name)
    if sql is None:
        assert len(frame) > 0
    else:
        assert rows(frame) == rows(duck.execute(sql).fetchdf())


def test_entry(spark):
    assert entry(spark).count() > 0


def test_unchecked_queries_are_few():
    assert not {n for n in set(queries()) - set(oracle_sql()) if n != "pipeline" and not n.startswith("op")}
    assert not set(oracle_sql()) - set(queries())
