"""The two native operators on odd rows, against plain loops."""

import random
import re
from collections import Counter

import pytest

from seqloom.llm import decontaminate, quality_rules

SPACE_WORDS, ITEM_WORDS = r"[^\x20\x09-\x0D]+", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def texts():
    draw = random.Random(2)
    made = [None, "", " \n\t", "a b c d e", "x " * 4000, "\n".join(["same line"] * 30), "### $$$ | <a> &", "é\x1c É　ü b"]
    for _ in range(40):
        words = draw.choices(["the", "of", "wa", "wb", "WC", "w#d", "é"], k=draw.choice([4, 5, 9, 60]))
        made.append(draw.choice([" ", "\n", "  "]).join(words))
    return made


def plain_counts(text):
    text = text or ""
    words = re.findall(SPACE_WORDS, text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if re.search(SPACE_WORDS, line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_counts(spark):
    made = texts()
    rows = [(n, t, 1) for n, t in enumerate(made)] + [(None, made[9], 1), (3, made[3], 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    got = quality_rules.apply_rules(docs).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for key, text, _ in rows:
        r, expected = by_id[key], plain_counts(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected, text
        assert r.base_failed == (expected[0] < 10 or 100 * expected[4] > 20 * expected[0])
        assert not (r.base_failed and r.kept)
    assert quality_rules.apply_rules(docs.limit(0)).count() == 0


def test_quality_rules_are_one_projection(spark, sf_dir):
    plan = quality_rules.op5_quality_rules(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def plain_hits(docs, items, size):
    words = lambda t: re.findall(ITEM_WORDS, (t or "").translate(ASCII_LOWER))
    windows = {}
    for item, text in items:
        own = words(text)
        width = min(size, len(own))
        for i in range(len(own) - width + 1 if own else 0):
            windows.setdefault(tuple(own[i : i + width]), set()).add(str(item))
    widths = {len(w) for w in windows}
    for key, text in docs:
        own, hit, found = words(text), set(), set()
        for width in widths:
            for i in range(len(own) - width + 1):
                if (phrase := tuple(own[i : i + width])) in windows:
                    hit.update(range(i, i + width))
                    found |= windows[phrase]
        yield key, len(own), len(hit), len(found), ",".join(sorted(found))


@pytest.mark.parametrize("broadcast_bytes", [1 << 25, -1])
def test_contamination(spark, broadcast_bytes):
    draw = random.Random(4)
    vocabulary = ["the", "of", "a1", "İx", "Éé", "é", "b2", "cc", "dd", "E"]
    items = [(n, " ".join(draw.choices(vocabulary, k=draw.choice([1, 3, 10, 12, 30])))) for n in range(25)]
    items += [(25, items[3][1].upper()), (26, None), (27, "--"), (28, "never seen word"), (3, items[3][1])]
    made = [(0, None), (1, ""), (2, "!"), (None, items[4][1]), (4, items[5][1] + ", " + items[6][1])]
    for n in range(5, 40):
        words = draw.choices(vocabulary + [f"z{k}" for k in range(40)], k=draw.choice([1, 20, 200]))
        words[3:3] = (items[draw.randrange(25)][1]).split() * (n % 2)
        made.append((n, "-".join(words)))
    made += [(7, made[7][1]), (7, made[8][1]), (None, made[9][1])]
    docs = spark.createDataFrame([(k, t, "x") for k, t in made], "doc_id long, text string, phrase string")
    bench = spark.createDataFrame([(k, t, "x") for k, t in items], "item_id long, text string, word string")
    got = decontaminate.contamination(docs, bench, broadcast_bytes=broadcast_bytes).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, plain_hits(made, items, 10)))
    hit = {str((k, t)) for (k, t), (_, _, n, *_) in zip(made, plain_hits(made, items, 10), strict=True) if n}
    clean = decontaminate.keep_clean(docs, bench, broadcast_bytes=broadcast_bytes)
    assert clean.columns == docs.columns
    assert sorted(str((r.doc_id, r.text)) for r in clean.collect()) == sorted(str(x) for x in made if str(x) not in hit)
    if broadcast_bytes > 0:
        assert decontaminate.keep_clean(docs, bench.limit(0)).count() == len(made)
        assert decontaminate.keep_clean(docs.limit(0), bench).count() == 0
        assert {r.n_hit for r in decontaminate.contamination(docs, bench.limit(0)).collect()} == {0}
        assert decontaminate.contamination(docs.limit(0), bench).count() == 0


def test_decontamination_is_native(spark, sf_dir):
    plan = decontaminate.op7_decontaminate(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
