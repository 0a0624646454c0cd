"""Deleted interpolation against dictionaries and a plain loop."""

import math
import random
import re
import zlib
from collections import Counter

import pytest

from seqloom.llm import ngram_model as lm

ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def rows(count=160):
    draw = random.Random(3)
    vocabulary = [f"w{n}" for n in range(40)] + ["Ünder", "ünder", "THE", "the", "x\x00y"]
    weights = [1 / (n + 1) for n in range(len(vocabulary))]
    made = [" ".join(draw.choices(vocabulary, weights, k=draw.choice([1, 5, 60]))) for _ in range(count)]
    made[1], made[2], made[4], made[9] = None, "", " \t\n", "the " * 3000
    keyed = list(enumerate(made))
    return [*keyed, (7, made[7]), (7, made[7]), (None, made[8])]


def plain(docs, rounds=lm.ROUNDS, close=lm.CLOSE):
    def fold(key):
        return None if key is None else zlib.crc32(str(key).encode()) % 7

    def tokens(text):
        return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER)), ""]

    one, two = {k: Counter() for k in "md"}, {k: Counter() for k in "md"}
    for key, text in docs:
        if fold(key) in (None, 2):
            continue
        part = "d" if fold(key) == 3 else "m"
        words = tokens(text)
        one[part].update(words)
        two[part].update(zip(["", *words], words, strict=False))
    bucket = lambda n: 0 if n == 0 else int(math.log2(n)) + 1
    all_one, all_two = one["m"] + one["d"], two["m"] + two["d"]
    total, main, types = sum(all_one.values()), sum(one["m"].values()), len(all_one)
    weights = {}
    for _ in range(rounds):
        sums = {}
        for (h, w), n in two["d"].items():
            c = one["m"][h]
            parts = [two["m"][h, w] / max(c, 1), one["m"][w] / max(main, 1), 1 / (types + 1)]
            parts = [p * q for p, q in zip(parts, weights.get(bucket(c), [1 / 3] * 3), strict=True)]
            old = sums.get(bucket(c), [0, 0, 0])
            sums[bucket(c)] = [o + n * p / sum(parts) for o, p in zip(old, parts, strict=True)]
        new = {b: [x / sum(s) for x in s] for b, s in sums.items()}
        pooled = [sum(s[k] for s in sums.values()) for k in range(3)]
        rest = [p / sum(pooled) for p in pooled] if sums else [1 / 3] * 3
        gap = max(
            [abs(a - b) for k in range(lm.BUCKETS) for a, b in zip(new.get(k, rest), weights.get(k, [1 / 3] * 3), strict=True)]
        )
        weights = {k: new.get(k, rest) for k in range(lm.BUCKETS)}
        if gap < close:
            break
    for key, text in docs:
        words, model, base = tokens(text), 0.0, 0.0
        for h, w in zip(["", *words], words, strict=False):
            a, b, c = weights.get(bucket(all_one[h]), [1 / 3] * 3)
            model += math.log10(a * all_two[h, w] / max(all_one[h], 1) + b * all_one[w] / max(total, 1) + c / (types + 1))
            base += math.log10((all_one[w] + 1) / (total + types + 1))
        yield key, fold(key) == 2, len(words), sum(all_one[w] > 0 for w in words), total, base, model


@pytest.mark.parametrize(("block_tokens", "shard_keys"), [(1 << 20, 1 << 20), (300, 64)])
def test_scores_are_those_of_the_plain_model(spark, block_tokens, shard_keys):
    made = rows()
    docs = spark.createDataFrame([(k, t, 0.0) for k, t in made], "doc_id long, text string, score double").repartition(3)
    got = lm.score_documents(docs, block_tokens=block_tokens, shard_keys=shard_keys).collect()
    expected = sorted(plain(made), key=lambda r: (str(r[0]), r[5]))
    got = sorted(map(tuple, got), key=lambda r: (str(r[0]), r[5]))
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    for g, e in zip(got, expected, strict=True):
        assert g[5] == pytest.approx(e[5], rel=1e-9, abs=1e-9)
        assert g[6] == pytest.approx(e[6], rel=1e-6, abs=1e-9)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    got = lm.score_documents(docs).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.held_out) for r in got) == [
        (1, 0, 0, 0.0, False),
        (3, 0, 0, 0.0, False),
    ]
    assert lm.score_documents(docs.limit(0)).count() == 0


def test_the_model_beats_its_base_on_unseen_documents(spark, sf_dir):
    got = lm.op10_ngram_model(spark, sf_dir).where("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert got["sum(score)"] > got["sum(base_score)"]
