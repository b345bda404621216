"""Every query against its SQL on the smallest given tables."""

import os

import duckdb
import pytest

from clickloom.plans import catalog, oracles

DATA = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="given tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def _rows(frame):
    columns = sorted(frame.columns)
    values = frame[columns].astype(object).where(frame[columns].notna(), None)
    return columns, sorted(tuple("" if v is None else str(v) for v in row)
                           for row in values.itertuples(index=False))


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(oracles.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_sql(spark, duck, name):
    found = catalog.queries()[name](spark, DATA).toPandas()
    wanted = duck.execute(oracles.oracle_sql()[name]).fetchdf()
    assert _rows(found) == _rows(wanted)
    kinds = lambda frame: {c: frame[c].dtype.kind for c in frame if frame[c].notna().any()}
    assert kinds(found) == kinds(wanted)
