"""Quality, repetition and heuristic filters: over one text each, no shuffle."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from seqloom.functions.batches import Words, doubled, ranked, with_columns_of_texts

_SPACE = r"\x20\x09-\x0D"
#: Stop words and thresholds of the published rules.
STOP_WORDS = ("the", "be", "to", "of", "and", "that", "have", "with")
TOP_GRAMS = {2: 0.20, 3: 0.18, 4: 0.16}
REPEATED_GRAMS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
ADVERTS = ("click here", "buy now", "subscribe", "licensed under", "all rights reserved")
WEIGHTS = {"terminal": 0.3, "repeated": 0.2, "short": 0.2, "symbols": 0.2, "adverts": 0.1}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, which is computed once however often `body` names it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{_SPACE}]+"), lambda w: w != "")


def lines_of(text: Column) -> Column:
    """Lines with something on them, without white space at their ends."""
    trimmed = F.transform(
        F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.regexp_replace(x, f"^[{_SPACE}]+|[{_SPACE}]+$", "")
    )
    return F.filter(trimmed, lambda x: x != "")


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _how_many(items: Column, test: Callable[[Column], Column]) -> Column:
    return F.size(F.filter(items, test))


def _chars(items: Column) -> Column:
    return F.aggregate(items, F.lit(0), lambda n, x: n + F.length(x))


def quality_filters(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, one flag per rule (true: passed), `reasons` (rules that failed, comma-joined) and `kept`."""
    t = F.coalesce(text, F.lit(""))

    def flags(w: Column, lines: Column) -> Column:
        n = F.size(w)
        symbols = F.length(t) - F.length(F.regexp_replace(t, "#", ""))
        symbols = symbols + F.size(F.split(t, r"\.\.\.|…")) - 1
        return F.struct(
            ((n >= 50) & (n <= 100_000)).alias("word_count"),
            ((_chars(w) >= n * 3) & (_chars(w) <= n * 10)).alias("word_length"),
            (symbols * 10 <= n).alias("symbols"),
            (_how_many(lines, lambda x: x.rlike("^[-*•]")) * 10 <= F.size(lines) * 9).alias("bullets"),
            (_how_many(lines, lambda x: x.rlike(r"(\.\.\.|…)$")) * 10 <= F.size(lines) * 3).alias("ellipsis"),
            (_how_many(w, lambda x: x.rlike(r"\p{L}")) * 10 >= n * 8).alias("letters"),
            (_how_many(F.array(*map(F.lit, STOP_WORDS)), lambda s: F.array_contains(w, s)) >= 2).alias("stop_words"),
        )

    found = docs.select(
        key, let(words_of(F.col(text)), lambda w: let(lines_of(F.col(text)), lambda x: flags(w, x))).alias("f")
    ).select(key, "f.*")
    rules = found.columns[1:]
    reasons = F.array_compact(F.array(*(F.when(~F.col(rule), F.lit(rule)) for rule in rules)))
    return found.withColumn("reasons", F.array_join(reasons, ",")).withColumn("kept", F.col("reasons") == "")


def paragraphs_of(text: Column) -> Column:
    """Stretches between blank lines, without white space at their ends."""
    trimmed = F.transform(
        F.split(F.coalesce(text, F.lit("")), f"\n[{_SPACE}]*\n"), lambda x: F.regexp_replace(x, f"^[{_SPACE}]+|[{_SPACE}]+$", "")
    )
    return F.filter(trimmed, lambda x: x != "")


def group_shares(texts: list[str]) -> list[np.ndarray]:
    """For each size of `TOP_GRAMS` and `REPEATED_GRAMS` the share of each text, by rank doubling.

    Words are numbered by their text; groups of two, four and eight words by the numbers of their
    halves; the sizes between by two groups that overlap. A group that holds a part which occurs once
    occurs once, and is never sorted again.
    """
    words = Words(texts)
    size = len(words.numbers)
    ranks = {1: ranked(words.numbers, np.arange(size), size)}
    before = np.concatenate([[0], np.cumsum(words.lengths)])
    place = np.arange(size) - np.repeat(np.cumsum(words.counts + 1) - words.counts - 1, words.counts + 1)
    rest = words.counts[words.text] - place  # words of the text from here on
    shares = []
    for n in range(2, max(REPEATED_GRAMS) + 1):
        half = 1 << ((n - 1).bit_length() - 1)
        ranks[n] = doubled(ranks[half], ranks[half], n - half)
        starts = np.flatnonzero(rest >= n)
        chars = before[np.minimum(np.arange(size) + n, size)] - before[:size] + n - 1
        whole = np.bincount(words.text[starts], chars[starts], len(texts))
        at = np.flatnonzero(ranks[n] >= 0)
        part = np.bincount(words.text[at], chars[at], len(texts))
        if n in TOP_GRAMS:
            part = np.zeros(len(texts))
            np.maximum.at(part, words.text[at], np.bincount(ranks[n][at], chars[at])[ranks[n][at]] if len(at) else chars[at])
        shares.append(np.divide(part, whole, out=np.zeros(len(texts)), where=whole > 0))
    return shares


def repetition_filters(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, shares of repeated lines, paragraphs and word groups (rounded to 6 digits) and `kept`.

    Groups of 2 to 4 words count the characters of the commonest one that repeats; groups of 5 to 10
    those of all that repeat, as a share of the characters of all groups of that size. Nothing is
    shuffled; word groups are ranked in Arrow batches, as numbers.

    Null, empty and blank texts repeat nothing; very long texts are read whole; repeated rows give
    repeated results; null keys are kept; an empty table gives an empty table; other columns are
    never looked at.
    """

    def shares(kind: str, items: Column) -> list[Column]:
        once = F.array_distinct(items)
        return [
            _share(F.size(items) - F.size(once), F.size(items)).alias(f"{kind}_share"),
            _share(_chars(items) - _chars(once), _chars(items)).alias(f"{kind}_char_share"),
        ]

    t = F.col(text)
    both = let(lines_of(t), lambda x: let(paragraphs_of(t), lambda y: F.struct(*shares("line", x), *shares("paragraph", y))))
    groups = [f"top_{n}" for n in TOP_GRAMS] + [f"repeated_{n}" for n in REPEATED_GRAMS]
    slim = docs.select(F.col(key).alias("k"), t.alias("t"), both.alias("f")).select("k", "t", "f.*")
    found = with_columns_of_texts(slim, "t", group_shares, [StructField(name, DoubleType()) for name in groups])
    limits = {"line_share": 0.30, "line_char_share": 0.20, "paragraph_share": 0.30, "paragraph_char_share": 0.20}
    limits |= {f"top_{n}": limit for n, limit in TOP_GRAMS.items()}
    limits |= {f"repeated_{n}": limit for n, limit in REPEATED_GRAMS.items()}
    rounded = found.select(F.col("k").alias(key), *(F.round(name, 6).alias(name) for name in limits))
    kept = reduce(lambda a, b: a & b, (F.col(name) <= limit for name, limit in limits.items()))
    return rounded.withColumn("kept", kept)


def heuristic_filters(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, five signals between 0 and 1 (rounded to 6 digits) and `kept`.

    terminal: lines that end like a sentence; repeated: characters of lines seen before; short: lines
    under 30 characters; symbols: characters neither letters nor white space; adverts: advert lines.
    """
    t = F.coalesce(text, F.lit(""))

    def signals(lines: Column) -> Column:
        n, seen = F.size(lines), F.array_distinct(lines)
        advert = lambda x: F.lower(x).rlike("|".join(ADVERTS))
        odd = F.length(F.regexp_replace(t, rf"[\p{{L}}{_SPACE}]+", ""))
        return F.struct(
            _share(_how_many(lines, lambda x: x.rlike("[.!?\"']$")), n).alias("terminal"),
            _share(_chars(lines) - _chars(seen), _chars(lines)).alias("repeated"),
            _share(_how_many(lines, lambda x: F.length(x) < 30), n).alias("short"),
            _share(odd, F.length(t)).alias("symbols"),
            _share(_how_many(lines, advert), n).alias("adverts"),
        )

    found = docs.select(key, let(lines_of(F.col(text)), signals).alias("f")).select(key, "f.*")
    found = found.select(key, *(F.round(name, 6).alias(name) for name in WEIGHTS))
    kept = (F.col("terminal") > 0.12) & (F.col("repeated") < 0.1) & (F.col("short") < 0.67)
    return found.withColumn("kept", kept & (F.col("symbols") < 0.3) & (F.col("adverts") < 0.5))


def heuristic_score(signals: DataFrame, key: str = "doc_id") -> DataFrame:
    """key and `score`, the weighted sum of the signals: 1 is best."""
    good = {name: F.col(name) if name == "terminal" else 1 - F.col(name) for name in WEIGHTS}
    total = sum((good[name] * weight for name, weight in WEIGHTS.items()), F.lit(0.0))
    return signals.select(key, F.round(total, 6).alias("score"))
