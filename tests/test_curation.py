"""Curation operators on odd rows, against plain definitions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from pathlib import Path
from urllib.parse import urlparse

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from seqloom.operators import bigrams, curation, dedup, filters, vocabulary, web
from seqloom.operators.components import components
from seqloom.plans import web_queries

TEXTS = [None, "", " \n\t", "one", "One  two", "a b c d e f g", "a b\tc d e f g ", "x " * 500, "the be to of, and that. 12 #$ é"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(n, t, None if n % 4 == 0 else f"s{n % 2}", "en" if n % 2 else None) for n, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")


def test_exact_copies(docs):
    got = {r.doc_id: r.copies for r in dedup.dedup_exact(docs).collect()}
    assert got == {0: 3, 3: 1, 4: 1, 5: 2, 7: 1, 8: 1}
    assert dedup.dedup_exact(docs.limit(0)).count() == 0


def test_minhash_links_copies_and_keeps_every_row(docs):
    got = {r.doc_id: r.cluster_id for r in dedup.minhash_clusters(docs).collect()}
    assert got == {n: 5 if n == 6 else n for n in range(len(TEXTS))}
    inside = {r.doc_id: r.cluster_id for r in dedup.minhash_clusters(docs, within=("source",)).collect()}
    assert inside[6] == 6  # another dump


def test_minhash_of_a_large_group(spark):
    words = random.Random(1).choices([f"w{n}" for n in range(500)], k=80)
    rows = [(n, " ".join(words)) for n in range(400)] + [(1000 + n, f"other {n} " + " ".join(map(str, range(n, n + 30)))) for n in range(5)]
    got = {r.doc_id: r.cluster_id for r in dedup.minhash_clusters(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {got[n] for n in range(400)} == {0}


def test_newest_dump_is_kept(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, "a")], "doc_id long, dump string")
    clusters = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 4)], "doc_id long, cluster_id long")
    kept = dedup.keep_newest(docs, clusters, "dump").where("kept").collect()
    assert sorted((r.cluster_id, r.doc_id) for r in kept) == [(1, 2), (4, 4)]


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(n, n + 1) for n in range(60)] + [(90, 91)], "u long, v long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {n: 0 for n in range(61)} | {90: 90, 91: 90}


def plain_repetition(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    for n in range(2, 11):
        grams = Counter(" ".join(words[i : i + n]) for i in range(len(words) - n + 1))
        whole = sum(k * len(g) for g, k in grams.items())
        many = {g: k * len(g) for g, k in grams.items() if k > 1}
        part = max(many.values(), default=0) if n < 5 else sum(many.values())
        yield f"{'top' if n < 5 else 'repeated'}_{n}", part / whole if whole else 0
    for kind, items in (("line", (text or "").split("\n")), ("paragraph", re.split(r"\n[\x20\x09-\x0D]*\n", text or ""))):
        items = [x for x in (re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", x) for x in items) if x]
        yield f"{kind}_share", (len(items) - len(set(items))) / len(items) if items else 0
        chars = sum(map(len, items))
        yield f"{kind}_char_share", (chars - sum(map(len, set(items)))) / chars if items else 0


def test_repetition_shares(spark, docs, monkeypatch):
    draw = random.Random(8)
    odd = [None, "", " \n", "é", "a b", "x y z " * 20_000, "same\n\nother line\n \t\nsame\n\n\n\nlast", "a\xa0b a\xa0b a\xa0b"]
    odd += [draw.choice([" ", "\n", "\n\n"]).join(draw.choices(["ab", "é", "cde", "f"], k=draw.choice([1, 9, 40, 200]))) for _ in range(60)]
    odd += TEXTS
    rows = [(n, t, 1) for n, t in enumerate(odd)] + [(None, odd[9], 1), (9, odd[9], 1)]
    monkeypatch.setattr("seqloom.functions.batches.CHARACTERS", 1000)
    found = filters.repetition_filters(spark.createDataFrame(rows, "doc_id long, text string, k int").coalesce(1))
    got = found.collect()
    assert len(got) == len(rows)
    for (key, text, _), r in zip(rows, got, strict=True):
        assert r.doc_id == key
        if len(text or "") < 10_000:
            for name, share in plain_repetition(text):
                assert r[name] == pytest.approx(share, abs=1e-6), (name, text)
    assert not got[5].kept and got[5].repeated_10 == 1
    assert filters.repetition_filters(docs.limit(0)).count() == 0


def test_repetition_has_no_shuffle(docs):
    plan = filters.repetition_filters(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "MapInArrow" in plan


def test_filters_take_any_row(docs):
    for found in (filters.quality_filters(docs), filters.heuristic_filters(docs), filters.heuristic_score(filters.heuristic_filters(docs))):
        assert sorted(r.doc_id for r in found.collect()) == list(range(len(TEXTS)))


#: Pages and their text; the query's SQL must agree too.
PAGES = {
    "<navbar>x</navbar><p>keep me</p><nav>y</nav>": "x keep me",
    "<nav>a<nav>b</nav>c</nav>d": "d",
    "<nav>a<head>b</nav>c</head>d</nav>e": "d e",
    "caf&eacute; &#8217;&#x41;&#X1F600; &bogus; &amp;lt; &apos; &; & &#0;&#xD800;": "café ’A😀 &bogus; &lt; ' &; & \ufffd\ufffd",
    "1 < 2 and 3 > 1 <b>x</b>": "1 < 2 and 3 > 1 x",
    '<script>var t="</p><nav>";</script >seen<STYLE x>p{}</STYLE><!-- <p> --> too': "seen too",
    "open <noscript>gone": "open",
    "a<script>gone": "a",
    "a<!-- gone": "a",
    "a</nav>b<nav/>c<nav class='x'>d</nav >e": "a b c e",
    "<?xml v?><!DOCTYPE html>x<br/>y&nbsp;z\n\t w": "x y z w",
    "": "",
    "<": "<",
}


def test_text_of_pages(spark):
    pages = spark.createDataFrame([(n, "u", h) for n, h in enumerate(PAGES)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in web.extract_text(pages).collect()}
    assert got == dict(enumerate(PAGES.values()))
    connection = duckdb.connect()
    connection.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    connection.executemany("INSERT INTO pages VALUES (?, 'u', ?)", list(enumerate(PAGES)))
    assert {k: t for k, _, t in connection.execute(web_queries.ORACLES["extract_text"]).fetchall()} == got
    with pytest.raises(ValueError):
        web.extract_text(pages.withColumn("text", pages["url"]))
    assert web.extract_text(pages.limit(0)).count() == 0


def test_pages(spark):
    rows = [
        (1, "http://A.b.com:80/x", "<head><title>t</title></head><p>a &lt;b&gt;<!-- x --> c<SCRIPT>1</SCRIPT></p>"),
        (2, "https://u@sub.bad.org/?q=http://ok.com", None),
        (3, None, ""),
        (4, "no url", "<b"),
        (5, "https://notbad.org", "x"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in web.extract_text(pages).collect()} == {1: "a <b> c", 2: "", 3: "", 4: "<b", 5: "x"}
    blocked = spark.createDataFrame([("BAD.org",), (None,)], "host string")
    assert {r.page_id for r in web.url_blocklist(pages, blocked).collect()} == {1, 3, 4, 5}


def test_languages_of_odd_texts(docs):
    got = {r.doc_id: r.predicted for r in web.language_id(docs, web.language_profiles(docs)).collect()}
    assert len(got) == len(TEXTS) and got[0] is None and got[3] == got[5] == "en"


def test_vocabulary_round_trip(docs):
    vocab = vocabulary.build_vocab(docs, min_count=1, max_size=100).cache()
    assert [r.token for r in vocab.where("id < 4").orderBy("id").collect()] == list(vocabulary.SPECIALS)
    coded = vocabulary.encode_vocab(docs, vocab)
    got = {r.doc_id: r.text for r in vocabulary.decode_vocab(coded, vocab).collect()}
    assert got[0] == got[1] == "" and got[5] == got[6] == "a b c d e f g"
    tiny = vocabulary.encode_vocab(docs, vocabulary.build_vocab(docs, max_size=4))
    assert {i for r in tiny.collect() for i in r.ids} == {vocabulary.UNKNOWN}


def test_word_index_is_cut_into_shards(docs):
    got = [(r.word, r.shard, r.postings) for r in vocabulary.word_index(docs, width=6).where("word = 'b'").collect()]
    assert sorted(got) == [("b", 0, [5]), ("b", 1, [6])]


def test_lookup_equals_a_search_of_all_texts(spark, tmp_path):
    rng = random.Random(5)
    words = [f"w{n}" for n in range(12)] + ["all"]
    rows = [(n * 7 - 500, " ".join({*rng.choices(words, k=5), "All"}) + ".") for n in range(300)]
    rows += [(None, "all w1"), (2000, None), (2001, ""), (rows[0][0], "w3 extra"), (-(2**62), "all w2"), (2**62, "all w2")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("clash"))
    path = str(tmp_path / "index")
    vocabulary.write_word_index(df, path, width=16, buckets=5)
    queries = {"a": ["w1"], "b": ["W1", "w2", "w1"], "c": ["ALL"], "d": ["all", "none"], "e": [], "f": ["w3", "extra"], "g": ["w1 w2"], "h": ["w"], "i": [".", "w4"]}
    got = [tuple(r) for r in vocabulary.word_lookup(spark, path, queries).collect()]
    held = {}
    for key, text in rows:
        if key is not None:
            held.setdefault(key, set()).update(re.findall(r"\w+|[^\w\s]", (text or "").lower()))
    expected = [(q, k) for q, asked in queries.items() if asked for k, own in held.items() if own >= {w.lower() for w in asked}]
    assert sorted(got) == sorted(expected) and {q for q, _ in got} == set("abcfi")


def test_lookup_reads_the_buckets_of_its_words_only(spark, docs, tmp_path):
    path = str(tmp_path / "index")
    vocabulary.write_word_index(docs, path, buckets=16)
    own = spark.sql("SELECT pmod(xxhash64('b'), 16)").first()[0]
    others = [f for f in (tmp_path / "index").glob("buckets=16/bucket=*/*.parquet") if f.parent.name != f"bucket={own}"]
    assert len(others) > 4
    for file in others:
        file.write_bytes(b"no table")  # reading one fails
    found = vocabulary.word_lookup(spark, path, {"q": ["b"]})
    assert sorted(r.doc_id for r in found.collect()) == [5, 6]
    vocabulary.write_word_index(docs.limit(0), str(tmp_path / "none"))
    assert vocabulary.word_lookup(spark, str(tmp_path / "none"), {"q": ["b"]}).count() == 0
    assert vocabulary.word_lookup(spark, path, {}).count() == 0


def test_classifier_learns_nothing_from_held_out_rows(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for n in range(400):
        good = n % 2
        common = rng.choices(["the", "of", "a"], k=6)
        rows.append((n, " ".join(common + rng.choices(["fine", "well", "so"] if good else ["bad", "worse", "so"], k=3))))
        labels.append((n, good if n % 9 else None))
    rows += [(None, "fine well"), (5000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    held = {n for n in range(400) if zlib.crc32(str(n).encode()) % 4 == 2}
    known = spark.createDataFrame(labels, "doc_id long, good int")
    turned = known.withColumn("good", F.when(F.col("doc_id").isin(sorted(held)), 1 - F.col("good")).otherwise(F.col("good")))
    first = curation.quality_classifier(docs, known, "good")
    scores = {r.doc_id: (r.held_out, r.score) for r in first.collect()}
    assert len(scores) == 402 and {n for n, (h, _) in scores.items() if h} - {5000} == held and not scores[None][0]
    again = {r.doc_id: r.score for r in curation.quality_classifier(docs, turned, "good").collect()}
    assert {n: pytest.approx(s, abs=1e-9) for n, (_, s) in scores.items()} == again
    got = {r.held_out: r for r in curation.classifier_quality(first, known, "good").collect()}
    for side in (True, False):
        ups = [scores[n][1] for n, good in labels if good == 1 and scores[n][0] == side]
        downs = [scores[n][1] for n, good in labels if good == 0 and scores[n][0] == side]
        wins = sum((u > d) + (u == d) / 2 for u in ups for d in downs)
        assert (got[side].documents, got[side].positives) == (len(ups) + len(downs), len(ups))
        assert got[side].auc == pytest.approx(wins / len(ups) / len(downs)) and got[side].auc > 0.9
    assert curation.classifier_quality(first.limit(0), known, "good").count() == 0


def test_perplexity(spark):
    base = spark.createDataFrame([("a b a b",)], "text string")
    docs = spark.createDataFrame([(1, "a b"), (2, "z"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r.perplexity for r in vocabulary.ngram_perplexity(base, docs).collect()}
    first, second = (1 + 0.1) / (1 + 0.3), (2 + 0.1) / (2 + 0.3)
    assert got == {1: pytest.approx(math.exp(-(math.log(first) + math.log(second)) / 2)), 2: pytest.approx(1.3 / 0.1)}


def test_perplexity_of_small_blocks_and_its_shuffle(spark, monkeypatch):
    """Small blocks and shards change no chance, and a document's bigrams do not travel row by row."""
    made = np.random.default_rng(3)
    words = ["a", "b", "É", ".", "straße", "x1"]
    rows = [(int(n) if n % 9 else None, " ".join(made.choice(words, n % 40))) for n in range(200)] + [(5, "a b"), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    base = docs.where("doc_id % 2 = 0")
    texts = [(key, (text or "").lower().split()) for key, text in rows]
    learned = [w for key, w in texts if key is not None and key % 2 == 0]
    pairs, single = Counter(p for w in learned for p in zip(["", *w], w)), Counter(b for w in learned for b in ["", *w][: len(w)])
    size, logs = len({x for w in learned for x in w}) + 1, {}
    for key, own in texts:
        for before, word in zip(["", *own], own):
            logs.setdefault(key, []).append(math.log((pairs[before, word] + 0.1) / (single[before] + 0.1 * size)))
    want = {key: (len(x), pytest.approx(math.exp(-sum(x) / len(x)))) for key, x in logs.items()}
    monkeypatch.setattr(bigrams.log_chances, "__defaults__", (50, 200))
    found = vocabulary.ngram_perplexity(base, docs)
    assert {r.doc_id: (r.tokens, r.perplexity) for r in found.collect()} == want
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and plan.count("Join") == 0


def test_pairs_of_turns_and_answers(spark):
    turns = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "r"), (2, 0, "assistant", "x"), (1, 3, "assistant", "b")]
    got = curation.sft_pairs(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"), context=2).collect()
    assert sorted(map(tuple, got)) == [(1, 0, "", "q", "a"), (1, 2, "user: q\nassistant: a", "r", "b")]
    answers = [("p", "x", 1.0), ("p", "y", 3.0), ("p", "z", 3.0), ("q", "x", 1.0), ("r", "a", 1.0), ("r", "b", 1.2)]
    got = curation.preference_pairs(spark.createDataFrame(answers, "prompt string, answer string, score double"), 1.0).collect()
    assert [tuple(r) for r in got] == [("p", "y", "x", 2.0)]


def test_strata_and_semantic_copies(spark):
    rows = [(n, "big" if n > 3 else None) for n in range(300)]
    got = curation.stratified_sample(spark.createDataFrame(rows, "doc_id long, part string"), ["part"], 5).collect()
    assert Counter(r.part for r in got) == {"big": 5, None: 4}
    vectors = [(1, 0, [1.0, 2.0, 3.0]), (2, 0, [2.0, 4.0, 6.0]), (3, 1, [1.0, 2.0, 3.0]), (4, 0, [0.0, 0.0, 0.0]), (5, 0, [-1.0, 0.0, 1.0])]
    found = curation.dedup_semantic(spark.createDataFrame(vectors, "vec_id long, label int, v array<float>"), "vec_id", "v", "label", 0.99)
    assert {r.vec_id: r.cluster_id for r in found.collect()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}


def _planted(count, copies, size=32):
    """Random vectors of one label, and copies of some of them at cosine 0.96 or more."""
    made = np.random.default_rng(7)
    base = made.normal(size=(count, size))
    near = base[:copies] + made.normal(size=(copies, size)) * np.linalg.norm(base[:copies], axis=1)[:, None] * 0.25 / math.sqrt(size)
    return np.concatenate([base, near]).astype("float32")[made.permutation(count + copies)]


@pytest.mark.parametrize("block", [64, 1 << 14])
def test_semantic_copies_are_all_pairs_of_the_label(spark, block):
    vectors = _planted(900, 300)
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1)[:, None]
    a, b = np.nonzero(unit @ unit.T >= 0.95)
    root = np.arange(len(vectors))
    while (root[a] != root[b]).any():
        np.minimum.at(root, a, root[b])
    assert (root != np.arange(len(root))).sum() > 250
    rows = [(n, n % 2, v.tolist()) for n, v in enumerate(vectors.repeat(2, axis=0))]
    rows += [(9000, 0, [float("nan")] * 32), (9001, 0, [float("nan")] * 32), (9002, 0, [1.0, None]), (9003, None, vectors[0].tolist()), (9004, 0, vectors[0, :5].tolist())]
    rows += [(9005, 1, (vectors[3] * 2).tolist()), (None, 1, vectors[3].tolist())]
    found = curation.dedup_semantic(spark.createDataFrame(rows, "vec_id long, label int, v array<float>"), "vec_id", "v", "label", 0.95, block=block)
    got = {r.vec_id: r.cluster_id for r in found.collect()}
    expected = {2 * n + part: 2 * int(root[n]) + part for n in range(len(root)) for part in (0, 1)}
    assert got == expected | {n: n for n in range(9000, 9005)} | {9005: expected[7], None: None}


def _all_pairs(vectors, least=0.95):
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1)[:, None]
    a, b = np.nonzero(unit @ unit.T >= least)
    root = np.arange(len(vectors))
    while (root[a] != root[b]).any():
        np.minimum.at(root, a, root[b])
    return root, int((a < b).sum())


@pytest.mark.parametrize("border", [0.5, None])
def test_semantic_copies_in_cells(spark, border):
    vectors = _planted(1500, 500)
    root, pairs = _all_pairs(vectors)
    rows = [(n, "one", v.tolist()) for n, v in enumerate(vectors)] + [(5000 + n, "two", vectors[n].tolist()) for n in range(40)]
    docs = spark.createDataFrame(rows, "vec_id long, label string, v array<float>")
    found = curation.dedup_semantic(docs, "vec_id", "v", "label", 0.95, block=64, cell=100, border=border)
    got = {r.vec_id: r.cluster_id for r in found.collect()}
    small, _ = _all_pairs(vectors[:40])
    assert [got[5000 + n] - 5000 for n in range(40)] == small.tolist()
    if border == 0.5:
        assert [got[n] for n in range(len(root))] == root.tolist()
    linked = sum(got[n] != n for n in range(len(root)))
    assert pairs >= 400 and linked >= 0.9 * (root != np.arange(len(root))).sum()
    assert all(root[n] == root[got[n]] for n in range(len(root)))


def test_semantic_copies_write_a_vector_once_with_its_cells(spark, monkeypatch):
    """Not once for each cell that it visits: what is written stays below the size of the vectors, and in parts of 16 all pairs are found."""
    tables, real = {}, curation.written
    monkeypatch.setattr(curation, "written", lambda df, label: tables.setdefault(label, real(df, label)))
    vectors = _planted(1500, 500, 64)
    root, _ = _all_pairs(vectors)
    docs = spark.createDataFrame([(n, 0, v.tolist()) for n, v in enumerate(vectors)], "vec_id long, label int, v array<float>")
    found = curation.dedup_semantic(docs, "vec_id", "v", "label", 0.95, block=16, cell=32, border=0.5)
    assert {r.vec_id: r.cluster_id for r in found.collect()} == dict(enumerate(root.tolist()))
    assert tables["cells"].count() == len(vectors)
    bytes_of = sum(Path(urlparse(f).path).stat().st_size for name in ("units", "cells") for f in tables[name].inputFiles())
    assert bytes_of < vectors.size * 8


@pytest.mark.parametrize("size", [2, 64, 300])
def test_pairs_that_sketches_cannot_tell_are_compared_exactly(spark, size):
    made, rows, expected = np.random.default_rng(5), [], {}
    for n, off in enumerate(s * 10.0**-e for e in range(3, 13) for s in (1, -1)):
        a, b = np.linalg.qr(made.normal(size=(size, 2)))[0].T
        cosine = 0.95 + off
        rows += [(2 * n, f"l{n}", (a * 7).tolist()), (2 * n + 1, f"l{n}", (cosine * a + math.sqrt(1 - cosine * cosine) * b).tolist())]
        expected |= {2 * n: 2 * n, 2 * n + 1: 2 * n + (off < 0)}
    rows.append((0, "l1", rows[2][2]))  # a key of two vectors: it is in the clusters of both
    docs = spark.createDataFrame(rows, "k long, l string, v array<double>")
    got = {r.k: r.cluster_id for r in curation.dedup_semantic(docs, "k", "v", "l", 0.95).collect()}
    assert got == expected | {2: 0}


def test_cells_are_few_pairs():
    """Ten times the vectors of one label, compared in cells, take far less than a hundred times the pairs."""
    draw = np.random.default_rng(3)
    themes = draw.normal(size=(400, 64))

    def compared(count):
        vectors = themes[draw.integers(0, 400, count)] + draw.normal(size=(count, 64)) * 0.4
        units = vectors / np.linalg.norm(vectors, axis=1)[:, None]
        centres = units[draw.permutation(count)[: count // 50]]
        homes, visits = np.zeros(len(centres)), np.zeros(len(centres))
        for _, cell, home in curation._visited(units, centres, 0.2 * math.sqrt(0.1)):
            homes += np.bincount(cell[home], minlength=len(centres))
            visits += np.bincount(cell[~home], minlength=len(centres))
        return (homes * (homes / 2 + visits)).sum()

    assert compared(10_000) < 40 * compared(1_000)


def test_whole_funnel_drops_other_languages_and_near_copies(spark, sf_dir):
    rows = {r.stage[2:]: r for r in web_queries.pipeline_funnel_whole(spark, sf_dir).collect()}
    assert rows["language"].pages < rows["allowed hosts"].pages and rows["near copies"].pages < rows["exact copies"].pages
    assert rows["tokenized"].pages == rows["score"].pages > 0 and rows["tokenized"].tokens > 0


def test_cluster_sizes(spark):
    rows = [(1, 1), (2, 1), (3, 1), (4, 4), (5, 5), (6, None)]
    found = dedup.cluster_sizes(spark.createDataFrame(rows, "doc_id long, cluster_id long")).collect()
    assert {tuple(r) for r in found} == {(3, 1, 3), (1, 3, 3)}


def test_signatures_are_a_row_for_each_row(spark):
    rows = [(1, "a b c d e f"), (1, "g h i j k l"), (None, "a b c d e f"), (4, None), (5, " ")]
    found = dedup.minhash_signature(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.doc_id for r in found] == [1, 1, None]
    assert found[0].signature == found[2].signature != found[1].signature
    shingles = ["a b c d e", "b c d e f"]
    hashed = [int(hashlib.md5(s.encode()).hexdigest()[:8], 16) % dedup.PRIME for s in shingles]
    assert found[0].signature == [min((h * a + b) % dedup.PRIME for h in hashed) for a, b in dedup.coefficients(112)]


def test_quantiles_of_a_sketch(spark):
    draw = np.random.default_rng(2).permutation(20_000).tolist()
    rows = [("many", float(x)) for x in draw] + [("few", 3.0), ("few", 1.0), ("few", None), (None, None)]
    scored = spark.createDataFrame(rows, "source string, perplexity double").repartition(7)
    found = {r.source: r for r in vocabulary.perplexity_distribution(scored, "source", accuracy=200).collect()}
    for name, share in (("p10", 0.1), ("p50", 0.5), ("p90", 0.9)):
        assert abs(found["many"][name] - share * 20_000) <= 20_000 / 200
    assert (found["few"].documents, found["few"].scored, found["few"].p10, found["few"].p90) == (3, 2, 1.0, 3.0)
    assert found[None].documents == 1 and found[None].p50 is None


def test_pairs_have_their_reasons(spark, tmp_path):
    rows = [("p", "good", 9.0, "clear"), ("p", "bad", 1.0, "wrong"), ("p", "odd", None, "x"), ("p", "nan", float("nan"), "y"), ("q", "one", 5.0, "z")]
    pairs = curation.preference_pairs(spark.createDataFrame(rows, "prompt string, answer string, score double, why string"), 2, reason="why")
    assert [tuple(r) for r in pairs.collect()] == [("p", "good", "bad", 8.0, "clear", "wrong")]
    curation.save_pairs(pairs, f"{tmp_path}/pairs")
    assert spark.read.json(f"{tmp_path}/pairs").first()["chosen_reason"] == "clear"


def test_language_scores_shuffle_no_groups_where_profiles_are_small(spark, monkeypatch):
    rows = [(1, "a the cat", "x"), (2, "der hund", "y"), (3, "the the hund", None), (4, None, "x"), (5, "qq", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = web.language_profiles(docs)
    small = web.language_scores(docs, profiles)
    plan = small._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.count("Exchange hashpartitioning") == 1
    monkeypatch.setattr(web, "PROFILE_ROWS", 0)
    plain = {(r.doc_id, r.lang): r.score for r in web.language_scores(docs, profiles).collect()}
    found = {(r.doc_id, r.lang): r.score for r in small.collect()}
    assert found.keys() == plain.keys() and all(abs(found[k] - plain[k]) < 1e-9 for k in plain)


def test_norms_are_made_once_for_each_vector(spark, monkeypatch):
    """Not for every element and by the filter again; odd vectors and nulls link to none."""
    plans, real = {}, curation.written

    def seen(df, label):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return real(df, label)

    monkeypatch.setattr(curation, "written", seen)
    nan, inf = float("nan"), float("inf")
    vectors = [(1, 0, [1.0, 2.0]), (2, 0, [2.0, 4.0]), (3, 0, [nan, 1.0]), (4, 0, [inf, 2.0]), (5, 0, [None, 2.0]), (6, 0, None), (7, None, [1.0, 2.0]), (8, 0, [0.0, 0.0]), (None, 0, [1.0, 2.0]), (9, 0, [])]
    rows = spark.createDataFrame(vectors, "k long, l int, v array<double>").repartition(2)
    found = curation.dedup_semantic(rows, "k", "v", "l", 0.99)
    assert {r.k: r.cluster_id for r in found.collect()} == {None: None, **{n: n for n in range(1, 10)}, 2: 1}
    assert plans["units"].count("aggregate(") == 1


def test_signatures_are_the_minima_and_their_steps_stay_in_cache():
    texts = [*TEXTS[1:], "a", "a b c d", "a b c d e", "\u00a0 é x\x0by", "u v w x y z " * 100]
    got = dedup.signatures_of(texts, 7)[0].to_pylist()
    for text, found in zip(texts, got, strict=True):
        words = re.split(r"[\x20\x09-\x0D]+", text.strip(" \t\n\v\f\r"))
        grams = {" ".join(words[n : n + 5]) for n in range(max(1, len(words) - 4))} if words != [""] else set()
        hashed = [int(hashlib.md5(g.encode()).hexdigest()[:8], 16) % dedup.PRIME for g in grams]
        assert found == ([min((a * h + b) % dedup.PRIME for h in hashed) for a, b in dedup.coefficients(7)] if grams else None)
    assert dedup._STEP * dedup.BANDS * dedup.BAND_ROWS * 8 <= 1 << 18


@pytest.mark.parametrize("most", [1 << 20, 2])
def test_profiles_are_counted_where_the_texts_are(spark, monkeypatch, most):
    """Neighbouring texts share no group, any characters count, and no group travels before it is counted."""
    texts = [(None, "x"), ("", "x"), ("Ab  c\t", "x"), ("abc", "x"), ("a😀É\x00", "y"), ("zz", None), ("q", "y")] * 3
    docs = spark.createDataFrame(texts, "text string, lang string").repartition(2)
    counts = Counter()
    for text, lang in texts:
        clean = f" {' '.join((text or '').lower().split())} "
        counts.update((lang, clean[n : n + 3]) for n in range(len(clean) - 2) if lang)
    totals = {lang: sum(n for (own, _), n in counts.items() if own == lang) for lang in "xy"}
    monkeypatch.setattr(web, "_GRAMS", most)
    found = web.language_profiles(docs)
    want = {(lang, gram): pytest.approx((counts[lang, gram] + 0.5) / (totals[lang] + 1)) for _, gram in counts for lang in "xy"}
    assert {(r.lang, r.gram): r.share for r in found.collect()} == want
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "gram-counts" in "".join(found.inputFiles()) and "documents" not in plan and "regexp_replace" not in plan


def test_codes_travel_as_flat_lists(spark):
    """A list of structs takes more than twice the bytes in a shuffle."""
    docs = spark.createDataFrame([(1, "a b a c"), (2, None), (3, "c . c")], "doc_id long, text string")
    vocab = vocabulary.build_vocab(docs, min_count=1)
    coded = vocabulary.encode_vocab(docs, vocab)
    words = vocabulary.decode_vocab(coded, vocab)
    for made in (coded, words):
        assert "collect_list(struct" not in made._jdf.queryExecution().optimizedPlan().toString()
    assert {r.doc_id: r.text for r in words.collect()} == {1: "a b a c", 2: "", 3: "c . c"}
