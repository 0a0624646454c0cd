"""Every registered query against its SQL, over whole small tables."""

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from seqloom.plans import registry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def comparable(df):
    def show(value):
        return repr(round(float(value), 9)) if isinstance(value, (float, np.floating)) else str(value)

    df = df[sorted(df.columns)]
    return sorted(tuple(show(v) for v in row) for row in df.itertuples(index=False))


#: Learned models that SQL cannot express; they have tests of their own.
NO_SQL = {"quality_classifier", "classifier_quality"}


def test_every_query_has_its_sql():
    assert registry.QUERIES.keys() - NO_SQL == registry.ORACLES.keys()
    assert registry.QUERIES.items() <= entry.queries().items()


@pytest.mark.parametrize("name", list(registry.ORACLES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    mine = entry.queries()[name](spark, sf_dir).toPandas()
    theirs = duck.execute(entry.oracle_sql()[name]).fetchdf()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert len(mine) == len(theirs) > 0
    assert comparable(mine) == comparable(theirs)


def test_entry(spark):
    assert entry.entry(spark).columns == ["chunk_id", "seq_id", "input_ids", "labels"]
