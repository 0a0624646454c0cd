"""Rows picked by a bit field against plain sets, and what the near-copy stage shuffles."""

import pytest

import corpus_pipeline as cp
from seqloom.llm import bit_fields, near_copies


@pytest.mark.parametrize("bits", [1, bit_fields.FIELD_BITS])
def test_rows_are_those_of_a_set(spark, bits):
    rows = [(None if n % 9 == 4 else n * 7919, n, f"t{n}") for n in [*range(60), 3, 3]]
    docs = spark.createDataFrame(rows, "key long, word long, `a.b` string").withColumnRenamed("word", "go")
    picked = [7919 * n for n in range(0, 60, 3) if n % 9 != 4]
    found = spark.createDataFrame([(k, -k) for k in [*picked, 5]], "key long, root long")
    for some, keys in ((found, {*picked}), (found.limit(0), set())):
        stay = bit_fields.without(docs, "key", some.select("key"), bits)
        assert stay.columns == docs.columns
        assert sorted(map(str, map(tuple, stay.collect()))) == sorted(str(r) for r in rows if r[0] not in keys)
        got = bit_fields.joined(docs.select("key", "`a.b`"), "key", some, bits).collect()
        assert sorted(map(tuple, got)) == sorted((k, t, -k) for k, _, t in rows if k in keys)


def texts_below_exchanges(df):
    """For each shuffle above a scan of texts, whether the rows were asked by a broadcast field before."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    for n, line in enumerate(lines):
        if "Exchange hashpartitioning" in line or "Exchange SinglePartition" in line:
            end = next((m for m in range(n + 1, len(lines)) if depth[m] <= depth[n]), len(lines))
            if any("FileScan" in below and "text#" in below for below in lines[n:end]):
                yield any("BroadcastHashJoin" in below for below in lines[n:end])


def test_only_texts_that_may_be_linked_are_shuffled(spark, sf_dir, monkeypatch):
    made = [" ".join(f"w{n}x{i}" for i in range(40)) for n in range(20)]
    docs = spark.createDataFrame([*enumerate(made), (50, made[3] + " more"), (51, made[4])], "doc_id long, text string")
    seen, write = {}, near_copies.written

    def noted(df, label):
        seen[label] = list(texts_below_exchanges(df))
        return write(df, label)

    monkeypatch.setattr(near_copies, "written", noted)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stay = cp.one_of_each_group(spark, docs, sf_dir)
        seen["stay"] = list(texts_below_exchanges(stay))
        assert sorted(r.doc_id for r in stay.collect()) == list(range(20))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert seen["candidates"] == seen["stay"] == [True]
