"""Near copies against the Jaccard similarity of all pairs."""

import random
import re

import pytest
from test_simhash import ASCII_LOWER, plain_components

import corpus_pipeline as cp
from seqloom.llm import near_copies


def plain_shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))
    return frozenset(" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def texts():
    draw = random.Random(3)
    made = [None, "", " \t\n", "one", "ONE", "One two", "a b c d e", "a b c d e f", "ÉTÉ x", "été x"]
    for _ in range(50):
        words = draw.choices([f"w{n}" for n in range(200)], k=draw.choice([12, 60, 400]))
        made.append(" ".join(words))
        for changes in draw.choice([[], [1], [1, 2, 5], [4, 9]]):
            for _ in range(changes):
                words[draw.randrange(len(words))] = draw.choice(["new", "w1", "W2"])
            made.append("\t".join(words))
    return made


def plain_groups(made):
    sets = [plain_shingles(t) for t in made]
    near = [(a, b) for b in range(len(sets)) for a in range(b) if len(sets[a] & sets[b]) * 5 >= len(sets[a] | sets[b]) * 4]
    return plain_components(range(len(made)), near)


@pytest.mark.parametrize("block", [2, 2048])
def test_groups_are_those_of_all_pairs(spark, block):
    made = texts()
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_copies.near_copies(docs, block=block).collect()}
    assert got == plain_groups(made)
    assert near_copies.near_copies(docs.limit(0)).count() == 0


def test_stage_keeps_one_of_each_group(spark, sf_dir):
    made = texts()
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    assert {r.doc_id for r in cp.one_of_each_group(spark, docs, sf_dir).collect()} == set(plain_groups(made).values())
