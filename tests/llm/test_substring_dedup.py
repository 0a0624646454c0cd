"""Repeated windows against a dictionary over all documents."""

import random
import re

import pytest

from seqloom.llm import substring_dedup as sd


def rows():
    draw = random.Random(8)
    vocabulary = [f"w{n}" for n in range(400)] + ["É", "é", "x\x1cy", "中文"]
    passage = draw.choices(vocabulary, k=70)
    made = [None, "", " \t\n", "a " * 300]
    for n in range(80):
        words = draw.choices(vocabulary, k=draw.choice([5, 19, 20, 21, 200]))
        if n % 3 == 0:
            at, cut = draw.randrange(len(words)), draw.randrange(40)
            words[at:at] = passage[cut : cut + draw.choice([10, 20, 25, 70])]
        made.append(draw.choice([" ", "\n", "\t "]).join(words))
        if n % 10 == 0:
            made.append(made[-1])
    keys = list(range(len(made)))
    draw.shuffle(keys)
    keyed = [*zip(keys, made, strict=True)]
    return [*keyed, (-3, made[5]), (keys[7], made[7]), (None, made[8]), (None, "new " * 3)]


def plain(docs, window):
    words = [(key, re.findall(r"[^\x20\x09-\x0D]+", text or "")) for key, text in docs]
    first = {}
    rank = lambda key: (key is None, key or 0)
    for key, own in words:
        for i in range(len(own) - window + 1):
            phrase, place = tuple(own[i : i + window]), (rank(key), i)
            first[phrase] = min(first.get(phrase, place), place)
    for key, own in words:
        gone = set()
        for i in range(len(own) - window + 1):
            if first[tuple(own[i : i + window])] != (rank(key), i):
                gone.update(range(i, i + window))
        yield key, len(own), len(gone), " ".join(w for k, w in enumerate(own) if k not in gone)


@pytest.mark.parametrize(("window", "gram", "block_words", "shard_keys"), [(20, 6, 1 << 18, 1 << 20), (20, 6, 500, 64), (5, 2, 900, 256)])
def test_kept_words_are_those_of_the_definition(spark, window, gram, block_words, shard_keys):
    made = rows()
    docs = spark.createDataFrame([(k, t, "x") for k, t in made], "doc_id long, text string, kept string").repartition(4)
    got = sd.remove_repeats(docs, window, gram, block_words, shard_keys).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, plain(made, window)))


def test_empty_table(spark):
    assert sd.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
