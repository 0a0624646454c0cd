"""The network's gradients, its windows, and what it learns."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqloom.llm import toxicity as tx
from seqloom.llm.common import narrow, table, trains


def test_gradients_match_differences():
    words = ["idiot", "the", "of", "ünder", "x"]
    p = {k: v.astype(np.float64) for k, v in tx.start(len(words) + 1).items()}
    own = np.arange(len(words)) % 3
    grams = tx.gram_rows(words)
    windows = np.array([[0, 1, 2, 3, 4], [2, 2, 1, -1, -1], [-1] * 5, [4, 0, -1, -1, -1]])
    slope = np.array([0.7, -1.1, 0.4, 0.9])

    def loss():
        return float(tx.forward(p, tx.gates(p, tx.type_vectors(p, own, *grams)), windows) @ slope)

    tape = {}
    tx.forward(p, tx.gates(p, tx.type_vectors(p, own, *grams)), windows, tape)
    grad, fed = tx.backward(p, tape, windows, slope)
    vectors = tx.type_vectors(p, own, *grams)
    for way in "fb":
        grad[f"in_{way}"] = vectors.T @ fed[way]
        grad[f"bias_{way}"] = fed[way].sum(axis=0)
    draw = np.random.default_rng(0)
    for name, g in grad.items():
        for _ in range(4):
            at = tuple(draw.integers(n) for n in p[name].shape)
            kept, step = p[name][at], 1e-3
            p[name][at] = kept + step
            above = loss()
            p[name][at] = kept - step
            below = loss()
            p[name][at] = kept
            assert g[at] == pytest.approx((above - below) / (2 * step), rel=0.05, abs=2e-3), name


def test_windows_cover_every_word():
    for length in (0, 1, 7, 8, 9, 12, 13, 500):
        windows = tx.windows_of(np.arange(length))
        assert set(windows.ravel()) - {-1} == set(range(length))
        inner = [set(w) for w in windows]
        assert all(a & b - {-1} for a, b in zip(inner, inner[1:], strict=False))


def plain_logit(p, vectors, words):
    """The network word by word and unit by unit, for the numbers of one window."""
    size, bend = tx.STATE, lambda x: x / (1 + abs(x))
    states = [[0.0] * (2 * size) for _ in words]
    for way, offset, steps in (("f", 0, range(len(words))), ("b", size, reversed(range(len(words))))):
        before = [0.0] * size
        for t in steps:
            fed = [float(b) + sum(float(x) * float(w) for x, w in zip(vectors[words[t]], c, strict=True)) for b, c in zip(p[f"bias_{way}"], p[f"in_{way}"].T, strict=True)]
            sent = [sum(x * float(w) for x, w in zip(before, c, strict=True)) for c in p[f"state_{way}"].T]
            z, r = ([0.5 + 0.5 * bend(fed[k + u] + sent[k + u]) for u in range(size)] for k in (0, size))
            new = [bend(fed[2 * size + u] + r[u] * sent[2 * size + u]) for u in range(size)]
            before = [new[u] + z[u] * (before[u] - new[u]) for u in range(size)]
            states[t][offset : offset + size] = before
    marks = []
    for state in states:
        hidden = [bend(sum(x * float(w) for x, w in zip(state, c, strict=True))) for c in p["attend"].T]
        marks.append(math.exp(sum(h * float(q) for h, q in zip(hidden, p["query"], strict=True))))
    pooled = [sum(m * s[u] for m, s in zip(marks, states, strict=True)) / sum(marks) for u in range(2 * size)] if words else [0.0] * (2 * size)
    return float(p["out_bias"][0]) + sum(x * float(w) for x, w in zip(pooled, p["out"], strict=True))


def test_scores_are_those_of_the_worst_of_all_windows():
    draw = np.random.default_rng(3)
    names = ["idiot", "the", "of", "ünder", "x", "and", "in", "a"]
    own = {"the": 1, "of": 2, "idiot": 3}
    p = tx.start(4)
    vectors = tx.type_vectors(p, np.array([own.get(w, 0) for w in names]), *tx.gram_rows(names))
    texts = [None, "", "#$%", *(" ".join(draw.choice(names, n)) for n in (1, 5, 7, 8, 9, 20, 8, 33, 3, 61))]
    for chunk in (1, 10, 4096):
        score = tx.scorer(p, own, 1.5, -0.25, chunk=chunk)
        for group in (texts, texts[:4], texts[8:9], texts[::-1]):
            expected = []
            for text in group:
                words = [names.index(w) for w in tx.words_of(text)]
                starts = range(max(1, len(words) - tx.WINDOW + 1))
                worst = max(plain_logit(p, vectors, words[i : i + tx.WINDOW]) for i in starts)
                expected.append(1 / (1 + math.exp(-(1.5 * worst - 0.25))))
            assert score(group) == pytest.approx(expected, abs=1e-5)


def test_grams_follow_their_words():
    rows, begins = tx.gram_rows(["ab", "x", "ab"])
    ends = [*begins[1:], len(rows)]
    parts = [rows[a:b].tolist() for a, b in zip(begins, ends, strict=True)]
    assert parts[0] == parts[2] and len(parts[0]) == 3 and len(parts[1]) == 1


def test_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = table(spark, sf_dir, "labels")
    got = tx.op4_toxicity(spark, sf_dir)
    assert got.count() == table(spark, sf_dir, "documents").count()
    rows = got.join(labels, "doc_id").where("held_out").select("score", "toxic").collect()
    toxic, clean = ([r.score for r in rows if r.toxic == kind] for kind in (1, 0))
    better = np.mean([(a > b) + 0.5 * (a == b) for a in toxic for b in clean])
    assert better > 0.65 and all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark):
    texts = ["the of and in " * (n % 9) + ("in" if n % 2 else "idiot") + " of and" * (n % 5) for n in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(n, 1 - n % 2) for n in range(80)] + [(3, None), (None, 1), (999, 1)], "doc_id long, toxic int")
    model = tx.train(docs, labels, trains(F.col("doc_id"), 4))
    rows = [(1, None, 0.0), (2, "", 0.0), (3, "#$% ", 0.0), (None, "idiot", 0.0), (5, "the of and in " * 20_000 + "idiot", 0.0), (6, "the of and", 0.0)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, score double")
    score = {r.doc_id: r.score for r in tx.score_documents(narrow(odd), model).collect()}
    assert score[1] == score[2] == score[3]
    assert min(score[None], score[5]) > 0.3 > score[6]
    assert tx.score_documents(narrow(odd).limit(0), model).count() == 0
    untrained = tx.train(docs, labels.where("toxic = 0"), F.lit(True))
    assert {round(r.score, 5) for r in tx.score_documents(narrow(odd), untrained).collect()} == {0.0}
