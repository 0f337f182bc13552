"""Every query that SQL can express gives the same rows as DuckDB over the smallest tables."""

import os

import duckdb
import pytest

from sijill.plans import catalogue

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for name in os.listdir(DIR):
        c.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{DIR}/{name}'")
    return c


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(round(r[i], 9) if isinstance(r[i], float) else r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_same_as_sql(spark, con, name):
    df, want = catalogue.queries()[name](spark, DIR), con.sql(catalogue.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(want.fetchall(), want.columns)


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_others_run(spark, name):
    assert catalogue.queries()[name](spark, DIR).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    df = e.entry(spark)
    assert df.columns == ["doc_id", "topic_slug", "confidence"] and df.count() > 0
