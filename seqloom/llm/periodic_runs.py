"""Operator 11, periodic runs of words by a dictionary of basic factors.

The basic factors of a text are its stretches of 2**k words. Level k of the dictionary numbers them,
equal stretches alike, from pairs of numbers of level k - 1. A factor that occurs once is never
looked at again: nothing longer that starts there can occur twice.

Inside a run of period q that is long enough (four periods), every factor of the level whose length
is q or up to 2q - 1 has its next occurrence exactly q words on, and that one again: a progression of
three. So each level proposes the distances of such progressions, within twice its length, and each
block of neighbouring starts with one distance proposes it once. A proposal is extended to both
sides by comparing factors of the dictionary, the longest first, and is then a run that no neighbour
extends. Runs proposed by several levels, or with a multiple of their period, cover the same
stretch: the smallest period stays.

Texts of a slice are searched together, each word numbered with its text, so that no factor occurs in
two. Work is n log n in the words of a text and near to linear where little repeats; memory is that
of the levels, of one slice or one longer text. Nothing is shuffled.

Defined results: null and blank texts have no words and no runs; very long texts are read whole;
a repeated row gives a repeated result; a null key is returned as null; an empty table gives an empty
table; other columns are never looked at.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from seqloom.llm.common import SPACE, narrow, per_slice, string_field, table
from seqloom.llm.quality_rules import let

#: A run has at least so many words, and so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4

RUN = StructType([StructField(name, LongType()) for name in ("start", "length", "period")])


class Factors:
    """The dictionary: `levels[k][i]` is the number of the 2**k words from i, negative if they occur once."""

    def __init__(self, words: np.ndarray, longest: int):
        """`words` numbers the words; no factor crosses a number that occurs once. `longest` bounds the periods."""
        self.levels: list[np.ndarray] = []
        self.proposals: list[tuple[np.ndarray, np.ndarray]] = []
        at, pairs, size = np.arange(len(words)), words, 1
        while True:
            order = np.argsort(pairs, kind="stable")
            ranked, place = pairs[order], at[order]
            new = np.ones(len(order), bool)
            new[1:] = ranked[1:] != ranked[:-1]
            number = np.cumsum(new) - 1
            often = np.bincount(number, minlength=1)[number] > 1 if len(number) else np.empty(0, bool)
            level = -1 - np.arange(len(words))
            level[place[often]] = number[often]
            self.levels.append(level)
            self._propose(place, new, size)
            if size >= longest or not often.any():
                return
            at = np.flatnonzero((level[: len(words) - size] >= 0) & (level[size:] >= 0))
            pairs = level[at] * len(words) + level[at + size]
            size *= 2

    def _propose(self, place: np.ndarray, new: np.ndarray, size: int) -> None:
        """`place` has the starts of the factors of a level, equal ones together in order; `new` marks the first."""
        step = np.zeros(len(self.levels[0]) + 1, np.int64)  # to the next occurrence, 0 if there is none near
        near = np.diff(place) * ~new[1:]
        step[place[:-1]] = np.where(near <= 2 * size, near, 0)
        starts = np.flatnonzero(step)
        distance = step[starts]
        three = step[starts + distance] == distance
        starts, distance = starts[three], distance[three]
        if len(starts):
            follows = np.zeros(len(starts), bool)
            follows[1:] = (np.diff(starts) == 1) & (np.diff(distance) == 0)
            self.proposals.append((starts[~follows], distance[~follows]))

    def common(self, left: np.ndarray, right: np.ndarray, forward: bool) -> np.ndarray:
        """How many words from `left` and `right` on (or before them, backwards) are equal."""
        total = np.zeros(len(left), np.int64)
        end = len(self.levels[0])
        for k in reversed(range(len(self.levels))):
            level, size = self.levels[k], 1 << k
            going = np.arange(len(left))
            while len(going):
                if forward:
                    a, b = left[going] + total[going], right[going] + total[going]
                    inside = b < end
                else:
                    a, b = left[going] - total[going] - size, right[going] - total[going] - size
                    inside = a >= 0
                a, b, going = a[inside], b[inside], going[inside]
                going = going[level[a] == level[b]]
                total[going] += size
        return total

    def runs(self) -> np.ndarray:
        """(start, length, period) of every run, by start and then period."""
        if not self.proposals:
            return np.empty((0, 3), np.int64)
        starts, periods = (np.concatenate(x) for x in zip(*self.proposals, strict=True))
        after = self.common(starts, starts + periods, forward=True)
        before = self.common(starts, starts + periods, forward=False)
        starts = starts - before
        lengths = before + after + periods
        found = np.stack([starts, lengths, periods], axis=1)
        found = np.unique(found[lengths >= np.maximum(LEAST_WORDS, LEAST_PERIODS * periods)], axis=0)
        first = np.ones(len(found), bool)
        first[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
        found = found[first]  # sorted: the smallest period of a stretch comes first
        return found[np.lexsort((found[:, 2], found[:, 0]))]


def word_numbers(texts: list[list[bytes]]) -> np.ndarray:
    """A number for each word of each text, equal inside a text only, and one of its own behind each text."""
    import pyarrow as pa

    counts = np.array([len(words) for words in texts], np.int64)
    flat = pa.array([word for words in texts for word in words], pa.large_binary()).dictionary_encode()
    own = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    own += np.repeat(np.arange(len(texts)), counts) * (len(flat.dictionary) + 1)
    ends = np.cumsum(counts)
    return np.insert(own, ends, -1 - np.arange(len(texts)))


def runs_of(texts: list[list[bytes]]) -> list[np.ndarray]:
    """The runs of each text, as rows (start, length, period)."""
    counts = np.array([len(words) for words in texts], np.int64)
    if not counts.sum():
        return [np.empty((0, 3), np.int64)] * len(texts)
    found = Factors(word_numbers(texts), int(counts.max()) // LEAST_PERIODS).runs()
    begins = np.cumsum(counts + 1) - counts - 1
    edges = np.searchsorted(found[:, 0], [*begins, begins[-1] + counts[-1] + 1])
    found = found - np.repeat(begins, np.diff(edges))[:, None] * np.array([1, 0, 0])
    return [found[a:b] for a, b in zip(edges, edges[1:], strict=False)]


def collapsed(words: list[bytes], runs: np.ndarray) -> str:
    """The words outside the repetitions of the runs, joined by a space: of each run its first period stays."""
    if len(runs):
        depth = np.zeros(len(words) + 1, np.int64)
        np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
        np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
        words = [words[n] for n in np.flatnonzero(np.cumsum(depth)[:-1] == 0)]
    return b" ".join(words).decode()


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, `runs` (start, length and period in words, by start, then period) and the `collapsed` text."""

    def prepare():
        def work(texts: list[str | None]) -> list[tuple]:
            words = [(text or "").encode().split() for text in texts]  # bytes: ASCII white space only
            return [
                ([{"start": s, "length": n, "period": p} for s, n, p in found.tolist()], collapsed(own, found))
                for own, found in zip(words, runs_of(words), strict=True)
            ]

        return work

    fields = [StructField("runs", ArrayType(RUN)), string_field("collapsed")]
    return per_slice(narrow(docs, id_col, text_col), prepare, fields)


def with_repetition(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the texts gets a repeated end, as its key's crc32 says."""
    words = F.filter(F.split("text", f"[{SPACE}]+"), lambda w: w != "")
    spread = F.floor(F.col("h") / 10)

    def planted(w: Column) -> Column:
        n = F.size(w)
        first = (spread % n).cast("int")
        period = (1 + F.floor((n - first) / (3 + spread % 8))).cast("int")

        def repeated(n: Column, first: Column, period: Column) -> Column:
            tail = F.transform(F.sequence(first, n - 1), lambda i: F.get(w, first + (i - first) % period))
            return F.array_join(F.concat(F.slice(w, 1, first), tail), " ")

        return F.when(n > 0, let(F.struct(n.alias("n"), first.alias("a"), period.alias("p")), lambda x: repeated(x["n"], x["a"], x["p"])))

    slim = narrow(docs).withColumn("h", F.crc32(F.col("doc_id").cast("string")))
    text = F.when(F.col("h") % 10 == 0, let(words, planted)).otherwise(F.col("text"))
    return slim.select("doc_id", text.alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_repetition(table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    shown = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    longest = found.withColumn("best", best)
    length, period = F.col("best.n"), -F.col("best.p")
    return longest.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(length * 1000 / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(shown, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


#: Bit by bit, as DuckDB has no crc32.
_CRC = """xor(list_reduce([4294967295::BIGINT] || [((ascii(k[i // 8 + 1]) >> (i % 8)) & 1)::BIGINT for i in range(8 * len(k))],
  lambda crc, b: xor(crc >> 1, 3988292384::BIGINT * (xor(crc, b) & 1))), 4294967295::BIGINT)"""

ORACLE = rf"""
WITH keyed AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS k, regexp_extract_all(coalesce(text, ''), '[^{SPACE}]+') AS w FROM documents
), hashed AS (
  SELECT doc_id, w, len(w) AS n, {_CRC} AS h FROM keyed
), planned AS (
  SELECT *, CASE WHEN n > 0 THEN (h // 10) % n END AS a,
         CASE WHEN n > 0 THEN 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8) END AS p
  FROM hashed
), d AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN [w[CASE WHEN i >= a THEN a + (i - a) % p ELSE i END + 1] for i in range(n)] ELSE w END AS w
  FROM planned
), placed AS (
  SELECT doc_id, n, unnest(range(n)) AS i, unnest(w) AS word FROM d
), same AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q
  FROM placed x JOIN placed y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), islands AS (
  SELECT doc_id, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same)
  GROUP BY doc_id, q, island
), runs AS (
  SELECT doc_id, start, length, min(q) AS period FROM islands WHERE length >= greatest({LEAST_WORDS}, {LEAST_PERIODS} * q)
  GROUP BY doc_id, start, length
), listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS shown,
         min(struct_pack(l := -length, s := start, p := period)) AS best
  FROM runs GROUP BY doc_id
), dropped AS (
  SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS words FROM placed ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, -best.l AS length, best.p AS period,
       CAST((-best.l * 1000) // best.p AS BIGINT) AS exponent_milli,
       sha256(coalesce(shown, '')) AS runs_sha256, sha256(coalesce(words, '')) AS collapsed_sha256
FROM d LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)"""
