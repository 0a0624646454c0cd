"""The pipeline against plain loops over the documents."""

import re

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_near_copies import plain_groups
from test_rules_and_decontamination import plain_hits
from test_spans import SECRETS, plain
from tokenizers import Tokenizer

import corpus_pipeline as cp
from seqloom.llm import language_id
from seqloom.llm.common import table, trains
from seqloom.session import SMALL_BATCHES


@pytest.fixture(autouse=True)
def sizes_unset(spark):
    """Each test starts without the sizes that stages leave set, and the session ends as it began."""
    before = {key: spark.conf.get(key, None) for key in SMALL_BATCHES}
    for key in SMALL_BATCHES:
        spark.conf.unset(key)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plain_run(rows, predict, items):
    """(doc_id, n_tokens) of what all stages keep."""
    kept = [(k, t) for k, t in rows if (found := predict(t))[0] != "und" and found[1] >= 0.5]
    groups, least = plain_groups([t for _, t in kept]), {}
    rank = lambda row: (row[0] is None, row[0] or 0)
    for n, row in enumerate(kept):
        root = groups[n]
        if root not in least or rank(row) < rank(least[root]):
            least[root] = row
    kept = list(least.values())
    clean = {(k, n) for k, n, hit, *_ in plain_hits(kept, items, 10) if hit == 0}
    words = lambda t: len(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t))
    kept = [(k, t) for k, t in kept if (k, words(t)) in clean and not plain(SECRETS, t)]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return sorted((str(k), len(library.encode(t, add_special_tokens=False).ids)) for k, t in kept)


def test_stages_on_the_small_tables(spark, sf_dir):
    docs, bench = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    model = language_id.train(docs, trains(F.col("doc_id"), 4))
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    items = [tuple(r) for r in bench.select("item_id", "text").collect()]
    expected = plain_run(rows, language_id.predictor(model), items)
    got = sorted((str(r.doc_id), r.n_tokens) for r in cp.run(spark, sf_dir).collect())
    assert got == expected
    assert 0.5 * len(rows) < len(got) < len(rows)


def test_odd_rows_pass_every_stage(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    some = docs.limit(3).collect()
    odd = spark.createDataFrame(
        [*some, some[0], (None, some[1].text, None, None, None), (900, None, "en", None, 0), (901, "", None, "s", 0), (902, "the of and " * 30_000, "en", "s", None)],
        docs.schema,
    ).withColumn("row", F.lit("x")).withColumn("fp", F.lit(1))
    for source in (odd, odd.limit(0)):
        now = source
        for name, stage in cp.STAGES[:-1]:
            now = cp.written(stage(spark, now, sf_dir), name)
            assert now.columns == source.columns
        assert cp.STAGES[-1][1](spark, now, sf_dir).count() == now.count()
    assert 902 in {r.doc_id for r in cp.one_of_each_group(spark, odd, sf_dir).collect()}


def test_copies_by_fingerprint_alone_are_one_group(spark, sf_dir):
    """Repeats outweigh the ends in a fingerprint, but not in a set of shingles."""
    ends = [" ".join(f"{c}{n}" for n in range(20)) for c in "xyz"]
    rows = [(n, "the of and " * 300 + end) for n, end in enumerate(ends)] + [(7, ends[0]), (8, ends[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in cp.one_of_each_group(spark, docs, sf_dir).collect()) == [0, 7, 8]


def test_stages_move_texts_in_small_batches(spark, sf_dir, monkeypatch):
    """Whatever the texts' sizes, a Python task gets about a megabyte at a time, or a longer text."""
    rows = [(0, "of the " * 500_000)] + [(n, "the of and to in " * 1200) for n in range(1, 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "size": [batch.nbytes]})

    monkeypatch.setattr(cp.secret_scan, "keep_clean", lambda docs: docs.mapInArrow(sizes, "n long, size long"))
    found = cp.no_secrets(spark, docs, sf_dir).collect()
    assert sum(r.n for r in found) == len(rows)
    assert all(r["size"] < 2 << 20 for r in found if r.n > 1), found


def test_run_leaves_the_session_as_it_was(spark, sf_dir, monkeypatch):
    seen = []
    stage = lambda spark, docs, sf_dir: seen.append({k: spark.conf.get(k, None) for k in SMALL_BATCHES}) or docs.limit(1)
    monkeypatch.setattr(cp, "STAGES", [("one", stage)])
    monkeypatch.setattr(cp, "table", lambda spark, *_: spark.range(3))
    arrow, *others = reversed(SMALL_BATCHES)
    spark.conf.set(arrow, "2m")
    assert cp.run(spark, sf_dir).count() == 1
    assert seen == [{arrow: "2m"} | {k: SMALL_BATCHES[k] for k in others}]
    assert spark.conf.get(arrow) in ("2m", "2097152b")
    assert all(spark.conf.get(k, None) is None for k in others)
