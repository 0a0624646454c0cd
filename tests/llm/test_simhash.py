"""SimHash near-duplicates against plain definitions."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from seqloom.llm import simhash
from seqloom.operators.components import components

ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def plain_components(keys, near):
    roots = {k: k for k in keys}
    changed = True
    while changed:
        changed = False
        for a, b in near:
            low = min(roots[a], roots[b])
            for k in (a, b):
                if roots[k] != low:
                    roots[k], changed = low, True
    return roots


def texts():
    draw = random.Random(5)
    vocabulary = [f"w{n}" for n in range(300)] + ["ÉTÉ", "Été", "İx", " ", "a\x1cb"]
    made = [None, "", " \t\n\x0b\x0c\r", "one", "One two", "ONE TWO", "a b c"]
    for _ in range(60):
        words = draw.choices(vocabulary, k=draw.choice([3, 40, 900]))
        made.append(" ".join(words))
        for _ in range(draw.choice([0, 1, 3])):
            copy = list(words)
            copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            made.append("\t".join(copy))
    return made


@pytest.fixture(scope="module")
def found(spark):
    made = texts()
    rows = [(10 * n, t, "x") for n, t in enumerate(made)] + [(5, made[8], "y"), (5, made[8], "y"), (None, made[9], "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    return rows, simhash.near_duplicates(docs, block=16).collect()


def test_fingerprints_follow_the_definition(found):
    rows, got = found
    expected = sorted((str(key), plain_fingerprint(text)) for key, text, _ in rows)
    assert sorted((str(r.doc_id), r.fp % 2**64) for r in got) == expected


def test_components_are_those_of_all_pairs(found):
    rows, got = found
    assert len(got) == len(rows)
    prints = {r.fp % 2**64 for r in got}
    near = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2]
    assert near
    roots = plain_components(prints, near)
    least = {}
    for r in got:
        if r.doc_id is not None:
            root = roots[r.fp % 2**64]
            least[root] = min(least.get(root, r.doc_id), r.doc_id)
    assert all(r.component_id == least[roots[r.fp % 2**64]] for r in got)


def test_spark_hash_agrees(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("one two trois été"))).first()[0]
    assert row % 2**64 == xxhash.xxh64("one two trois été".encode(), seed=42).intdigest()


@pytest.mark.parametrize("parts", [1, 2, 4, 8])
def test_links_between_random_fingerprints(spark, parts):
    draw = random.Random(parts)
    prints = [draw.getrandbits(64) for _ in range(150)]
    for p in prints[:60]:
        for _ in range(4):
            p ^= 1 << draw.randrange(64)
            prints.append(p)
    prints = sorted(set(prints) | {0, 2**64 - 1, 1, 3, 7})
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in prints]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), parts=parts, block=20)
    got = {r.node % 2**64: r.root % 2**64 for r in components(edges).collect()}
    near = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2]
    roots = plain_components(prints, near)
    classes = lambda f: {frozenset(k for k in prints if f(k) == f(p)) for p in prints}
    assert classes(lambda k: got.get(k, k)) == classes(roots.get)


def test_components_of_paths_and_stars(spark):
    pairs = [(n, n + 1) for n in range(100)] + [(500, n) for n in range(501, 560)] + [(700, 700)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert all(got[n] == 0 for n in range(101)) and all(got[n] == 500 for n in range(500, 560))


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
