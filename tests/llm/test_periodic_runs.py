"""Periodic runs against all stretches of a text."""

import hashlib
import random
import re
import zlib

import pytest

from seqloom.llm import periodic_runs as pr
from seqloom.llm.common import long_field, per_slice


def plain_runs(words):
    """Every (start, length, period) by trying each period at each word."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i:
                length = j + q - i
                if length >= max(6, 4 * q):
                    found.setdefault((i, length), q)
            i = max(j, i) + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_words(key, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(key).encode()), len(words)
    if key is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    return words


def plain_row(key, text):
    words = plain_words(key, text)
    runs = plain_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    shown = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return key, len(runs), start, length, period, length and 1000 * length // period, sha(shown), sha(kept)


def random_words(draw):
    kind = draw.randrange(4)
    if kind == 0:
        return draw.choices("ab", k=draw.choice([0, 1, 5, 6, 20, 60]))
    if kind == 1:
        root = draw.choices("abc", k=draw.choice([1, 2, 3, 5, 8, 13]))
        return draw.choices("abc", k=3) + root * draw.choice([3, 4, 7, 20]) + root[: draw.randrange(len(root) + 1)] + draw.choices("abcd", k=4)
    if kind == 2:  # powers of powers
        root = draw.choices("ab", k=2) * draw.choice([2, 4])
        return (root + ["c"] * draw.choice([0, 1, 6])) * draw.choice([4, 5, 9])
    return draw.choices([f"w{n}" for n in range(50)], k=draw.choice([3, 40, 300]))


@pytest.mark.parametrize("seed", range(6))
def test_runs_are_those_of_all_stretches(seed):
    draw = random.Random(seed)
    texts = [random_words(draw) for _ in range(60)]
    found = pr.runs_of([[w.encode() for w in words] for words in texts])
    for words, runs in zip(texts, found, strict=True):
        assert [tuple(r) for r in runs.tolist()] == plain_runs(words), words
    assert any(len(r) > 1 for r in found)


def test_long_periods_and_neighbouring_texts():
    draw = random.Random(1)
    root = [f"w{draw.randrange(40)}" for _ in range(257)]
    long = ["x"] + root * 5 + ["y"]
    one = [["a"] * 3, ["a"] * 3, long, long, ["a"] * 5000, []]
    found = [[tuple(r) for r in runs.tolist()] for runs in pr.runs_of([[w.encode() for w in t] for t in one])]
    assert found == [[], [], plain_runs(long), plain_runs(long), [(0, 5000, 1)], []]
    assert (1, 257 * 5, 257) in found[2]


def test_query(spark, tmp_path):
    draw = random.Random(3)
    made = [(0, None, "x"), (1, "", "x"), (2, " \n\t", "x"), (3, "é " * 9 + "é\xa0é", "x"), (4, "a b " * 20_000, "x")]
    made += [(n, draw.choice([" ", "\n "]).join(random_words(draw)), "x") for n in range(5, 150)]
    made += [(None, "a " * 7, "x"), made[9], made[9], (10_000_019, None, "x")]
    planted = [k for k in range(5, 150) if zlib.crc32(str(k).encode()) % 10 == 0]
    assert planted
    spark.createDataFrame(made, "doc_id long, text string, runs string").write.parquet(f"{tmp_path}/documents.parquet")
    got = pr.op11_periodic_runs(spark, str(tmp_path)).collect()
    wanted = [plain_row(key, text if key != 4 else None) for key, text, _ in made]
    assert sorted(map(str, (tuple(r) for r in got if r.doc_id != 4))) == sorted(map(str, (w for w in wanted if w[0] != 4)))
    long = next(r for r in got if r.doc_id == 4)
    assert (long.n_runs, long.start, long.length) == (1, 0, 40_000) and long.period == 2
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert pr.periodic_runs(docs.limit(0)).count() == 0


def test_slices_hold_few_characters(spark):
    docs = spark.createDataFrame([(n, "x" * n) for n in range(20)], "doc_id long, text string").coalesce(1)
    sizes = per_slice(docs, lambda: lambda texts: [(len(texts),) for _ in texts], [long_field("n")], 10).collect()
    assert [r.doc_id for r in sizes] == list(range(20))
    assert [r.n for r in sizes][:6] == [5, 5, 5, 5, 5, 1]
    assert all(r.n == 1 for r in sizes[6:])
