"""Operator 5, quality rules: a table of thresholds compiled into one projection.

Every feature is a built-in expression over one text, so the whole operator is a single projection
over the scan: no user function, no shuffle, memory of one text. Ratios are compared as integers.

Defined results: null and blank texts have no words and fail the base rule; very long texts are
read whole (work n log n in their words); a repeated row gives a repeated result; a null key is
returned as null. Windows are compared by a 64-bit hash of their five words.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.llm.common import SPACE, narrow, table

#: Frequent function words.
STOP_WORDS = (
    "the of and to in is that it for with was on as by at from this "  # English
    "der die das und den von zu mit ist nicht ein eine auf "  # German
    "le la les des et de du un une que est pour dans "  # French
    "el los las del que y en por se con una para "  # Spanish
).split()
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """`low` to `high` per cent of `part` in `whole`; None leaves a side open.

    `grace` is added to `part` for the lower side, so that short texts need not have any.
    """

    name: str
    part: str
    whole: str
    low: int | None = None
    high: int | None = None
    grace: int = 0

    def holds(self) -> Column:
        part, whole = F.col(self.part), F.col(self.whole)
        sides = [F.lit(True)]
        if self.low is not None:
            sides.append((part + self.grace) * 100 >= whole * self.low)
        if self.high is not None:
            sides.append(part * 100 <= whole * self.high)
        both = sides[0]
        for side in sides[1:]:
            both = both & side
        return both

    def sql(self) -> str:
        low = [f"100 * ({self.part} + {self.grace}) >= {self.low} * {self.whole}"] if self.low is not None else []
        high = [f"100 * {self.part} <= {self.high} * {self.whole}"] if self.high is not None else []
        return " AND ".join(low + high)


#: The thresholds. Length of words, symbols to words, stop words to words, repeated lines to lines.
RULES = (
    Rule("word_length", "word_chars", "n_words", 150, 2000),
    Rule("symbols", "n_symbols", "n_words", None, 30),
    Rule("stop_words", "n_stop_words", "n_words", 2, None, grace=1),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 50),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, which is computed once however often `body` names it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """Words inside five-word windows that the text has twice or more."""

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.aggregate(
            let(placed, starts),
            F.struct(F.lit(0).alias("total"), F.lit(0).alias("end")),
            lambda seen, i: F.struct(
                (seen["total"] + i + WINDOW - F.greatest(seen["end"], i)).alias("total"), (i + WINDOW).alias("end")
            ),
        )["total"]

    def starts(placed: Column) -> Column:
        def twice(x: Column, n: Column) -> Column:
            before = (n > 0) & (F.get(placed, n - 1)["h"] == x["h"])
            after = (n < F.size(placed) - 1) & (F.get(placed, n + 1)["h"] == x["h"])
            return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

        return F.sort_array(F.transform(F.filter(placed, twice), lambda x: x["i"]))

    windows = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - (WINDOW - 1), F.lit(0))),
        lambda _, i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))),
    )
    return let(
        windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))
    )


def features(text: Column) -> Column:
    """All counts of a text as one struct of longs."""
    text = F.coalesce(text, F.lit(""))
    symbols = F.length(F.regexp_replace(text, "[^#*$%&|<>]+", ""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    line_counts = let(
        lines, lambda x: F.struct(F.size(x).alias("all"), (F.size(x) - F.size(F.array_distinct(x))).alias("twice"))
    )

    def counts(words: Column) -> Column:
        chars = F.aggregate(words, F.lit(0), lambda n, w: n + F.length(w))
        stops = F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS)))
        return let(
            line_counts,
            lambda line: F.struct(
                F.size(words).cast("long").alias("n_words"),
                chars.cast("long").alias("word_chars"),
                symbols.cast("long").alias("n_symbols"),
                line["twice"].cast("long").alias("n_dup_lines"),
                repeated_words(words).cast("long").alias("n_repeat_words"),
                line["all"].cast("long").alias("n_lines"),
                stops.cast("long").alias("n_stop_words"),
            ),
        )

    return let(words_of(text), counts)


def apply_rules(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, the counts, base_failed, kept, and the names of the rules that failed."""
    counted = narrow(docs, id_col, text_col).select("doc_id", features(F.col("text")).alias("f")).select("doc_id", "f.*")
    base_failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    failed = F.filter(F.array(*(F.when(~rule.holds(), F.lit(rule.name)) for rule in rules)), lambda name: name.isNotNull())
    return counted.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "n_lines",
        "n_stop_words",
        base_failed.alias("base_failed"),
        (~base_failed & (F.size(failed) == 0)).alias("kept"),
        F.array_join(failed, ",").alias("failed_rules"),
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "documents"))


def _sql() -> str:
    stops = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    failed = ", ".join(f"CASE WHEN NOT ({rule.sql()}) THEN '{rule.name}' END" for rule in RULES)
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^{SPACE}]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^{SPACE}]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i + 1:i + {WINDOW}], ' ') AS p
  FROM (SELECT doc_id, w, unnest(range(0, len(w) - {WINDOW - 1})) AS i FROM d)
), repeated AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, p) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated, range(0, {WINDOW}) AS r(k) GROUP BY doc_id
), f AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[{SPACE}]', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
         len(lines) AS n_lines, len(list_filter(w, lambda x: lower(x) IN ({stops}))) AS n_stop_words
  FROM d LEFT JOIN covered USING (doc_id)
), v AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         array_to_string(list_filter([{failed}], lambda x: x IS NOT NULL), ',') AS failed_rules
  FROM f
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_stop_words, base_failed,
       NOT base_failed AND failed_rules = '' AS kept, failed_rules
FROM v"""


ORACLE = _sql()
