"""Every SQL statement against its query on the smallest tables (a cheap subset:
the driver compares all of them)."""

import duckdb
import pytest

import __spark_entry__ as entry
from kinfold.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
CHEAP = [k for k in catalog.oracle_sql() if k[0] in "abij" or k.startswith(("c8", "d10", "d11", "g2"))]


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(tuple(round(float(x), 6) if isinstance(x, float) else x for x in r) for r in df.itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def con(data):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", CHEAP)
def test_query_is_its_statement(spark, con, data, name):
    a, b = catalog.queries()[name](spark, data).toPandas(), con.execute(catalog.oracle_sql()[name]).df()
    assert sorted(a.columns) == sorted(b.columns)
    assert rows(a) == rows(b)


def test_statements_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["source1_entity_id", "candidate_entity_ids", "matched_entity_ids"] and df.count() == 67
