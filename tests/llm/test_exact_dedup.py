"""Exact deduplication against a dictionary of the texts."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from seqloom.llm import exact_dedup

ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def plain(text):
    return (text or "").translate(ASCII_LOWER)


def rows():
    draw = random.Random(5)
    made = [None, "", "", " ", "ABC", "abc", "abd", "É", "é", "é", "İ", "x" * 300_000, "X" * 300_000, "x" * 299_999 + "y"]
    made += ["the same start " * 10 + draw.choice("ab") + draw.choice("cd") for _ in range(40)]
    made += [draw.choice(["one", "two", "three words"]).title() for _ in range(40)]
    return [(n, t, "x") for n, t in enumerate(made)]


def expected(rows):
    groups = defaultdict(list)
    for key, text, *_ in rows:
        groups[plain(text)].append(key)
    for key, text, *_ in rows:
        own = groups[plain(text)]
        keep = max((k for k in own if k is not None), default=None)
        yield key, keep, len(own), hashlib.sha256(plain(text).encode()).hexdigest()


@pytest.mark.parametrize("bits", [8, exact_dedup.FILTER_BITS])
@pytest.mark.parametrize("prefix", [1, 64])
def test_groups_are_those_of_a_dictionary(spark, bits, prefix):
    made = rows()
    docs = spark.createDataFrame(made, "doc_id long, text string, size string")
    whole = {"text_sha256": F.sha2(exact_dedup.lowered(F.coalesce("text", F.lit(""))), 256)}
    got = exact_dedup.exact_groups(docs, carry=whole, prefix=prefix, filter_bits=bits).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == sorted(expected(made))
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def test_repeated_rows_and_null_keys(spark):
    made = [(1, "a", 0), (1, "a", 0), (1, "A", 0), (None, "a", 0), (None, "b", 0), (None, "b", 0), (None, None, 0), (2, "", 0)]
    docs = spark.createDataFrame(made, "doc_id long, text string, row int")
    got = exact_dedup.exact_groups(docs).collect()
    wanted = Counter((k, keep, n) for k, keep, n, _ in expected(made))
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in got) == wanted
    assert Counter((r.keep_id, r.group_size) for r in got if r.kept) == Counter({(1, 4): 1, (None, 2): 1, (2, 2): 1})
    stay = exact_dedup.keep_last(docs)
    assert stay.columns == docs.columns
    assert sorted(map(str, map(tuple, stay.collect()))) == sorted(map(str, [(r.doc_id, r.text, 0) for r in stay.collect()]))
    assert stay.count() == 3


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.exact_groups(docs).count() == 0
    assert exact_dedup.keep_last(docs).count() == 0


def test_only_rows_that_share_a_prefix_are_digested(spark, monkeypatch):
    seen = {}
    write = exact_dedup.written
    monkeypatch.setattr(exact_dedup, "written", lambda df, label: seen.setdefault(label, write(df, label)))
    texts = ["alone", "same length a", "same length b", "twice here", "Twice here", "longer than all"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    exact_dedup.exact_groups(docs).collect()
    assert {r.doc_id for r in seen["refined"].where("digest IS NOT NULL").collect()} == {3, 4}
