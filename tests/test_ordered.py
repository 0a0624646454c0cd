"""Orders by value: one value of most rows is split by its ties."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from seqloom.operators.ordered import BUCKET, by_value, ordinal


def placed(rows, column, ties, buckets):
    order = by_value(rows, column, ties, buckets)
    sizes = {r[0]: r[1] for r in order.add_bucket(rows).groupBy(BUCKET).count().collect()}
    got = ordinal(rows, order).collect()
    return sizes, sorted(got, key=lambda r: r.row_idx)


@pytest.mark.parametrize("share", [1.0, 0.4])
def test_one_value_fills_all_its_buckets(spark, share):
    rng = random.Random(3)
    rows = [(7 if n < share * 4000 else rng.randint(0, 2000), f"k{rng.random()}é") for n in range(4000)]
    df = spark.createDataFrame(rows, "v long, k string").repartition(5)
    sizes, got = placed(df, "v", ["k"], 16)
    assert [(r.v, r.k) for r in got] == sorted(rows) and [r.row_idx for r in got] == list(range(4000))
    assert len(sizes) >= 15 and set(sizes) <= set(range(16))  # nothing lies below a lowest value
    assert max(sizes.values()) < 2 * 4000 / 16


def test_ties_of_every_kind(spark):
    day = dt.date(2020, 1, 1)
    base = dt.datetime(2020, 1, 1, tzinfo=dt.UTC)
    rows = [(day, None if n < 100 else n % 5 / 4, base + dt.timedelta(microseconds=n * 37), bytes([n % 256, n // 256])) for n in range(1000)]
    df = spark.createDataFrame(rows, "d date, x double, t timestamp, b binary").repartition(3)
    sizes, got = placed(df, "d", ["x", "t", "b"], 10)
    expected = sorted(range(1000), key=lambda n: (n >= 100, rows[n][1] or 0, n))
    assert [bytes(r.b) for r in got] == [rows[n][3] for n in expected]
    assert len(sizes) >= 9 and max(sizes.values()) < 2 * 1000 / 10


def test_close_numbers_beyond_doubles(spark):
    first = 1 << 60
    df = spark.range(first, first + 500).withColumnRenamed("id", "v").repartition(4)
    sizes, got = placed(df, "v", [], 8)
    assert [r.v for r in got] == list(range(first, first + 500))
    assert len(sizes) >= 7 and max(sizes.values()) < 2 * 500 / 8


def test_splitters_are_constants_of_the_plan(spark):
    df = spark.range(1000).select(F.lit(1).alias("v"), F.col("id").alias("k"))
    plan = by_value(df, "v", ["k"], 8).add_bucket(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan and "JsonToStructs" not in plan


def test_empty_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "v long, k string")
    assert ordinal(empty, by_value(empty, "v", ["k"], 4)).count() == 0
    same = spark.createDataFrame([(1, "a")] * 200, "v long, k string")
    assert sorted(r.row_idx for r in ordinal(same, by_value(same, "v", ["k"], 4)).collect()) == list(range(200))
