"""Operator 8, language identification: words first, then shorter and shorter character n-grams.

A known word scores by its log frequency in each language. An unknown one scores by the mean log
frequency of its longest character n-grams that are known, from `order` letters down to one, the
ends of the word being part of it.

The model is fitted on a sample of labelled documents, about `docs_per_language` of each language,
none over `most_chars` characters, chosen by a hash of key and text; these bounds also bound the
model, which goes to all tasks as one broadcast. Words and n-grams seen only once in the sample are left to back off. Prediction reads
every text whole, next to its key, without a shuffle.

Defined results: null, blank and letterless texts are `und` with score zero; so is everything where
no document could be learned from; repeated rows repeat; a null key is neither held out nor learned.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from seqloom.llm.common import held_out, narrow, per_document, string_field, table, trains

UNKNOWN = "und"
FOLDS = 4
DOCS_PER_LANGUAGE, MOST_CHARS = 1500, 100_000
ORDER = 5
#: Words of evidence at which the score stops growing more certain.
EVIDENCE = 20
_CACHE = 60_000


_LETTERS_AND_SIGNS = re.compile(r"[^\W\d_]+")


@cache
def _letters() -> re.Pattern:
    """Runs of letters alone: signs like ½, ² and Ⅷ count as word characters, but are none."""
    signs = (chr(c) for c in range(sys.maxunicode + 1) if chr(c).isalnum() and not (chr(c).isalpha() or chr(c).isdecimal()))
    return re.compile(rf"[^\W\d_{''.join(map(re.escape, signs))}]+")


def letter_words(text: str) -> list[str]:
    r"""The matches of `\p{L}+`; the slow expression sees only the words that hold a sign."""
    found = _LETTERS_AND_SIGNS.findall(text)
    if found and not "".join(found).isalpha():
        found = [part for word in found for part in ([word] if word.isalpha() else _letters().findall(word))]
    return found


@dataclass(frozen=True)
class Model:
    """Log frequencies by language, a row for each known word and each known n-gram."""

    languages: tuple[str, ...]
    order: int
    words: dict[str, int]
    word_logs: np.ndarray
    grams: dict[str, int]
    gram_logs: np.ndarray


def _logs(rows: list, languages: tuple[str, ...]) -> tuple[dict[str, int], np.ndarray]:
    place = {name: n for n, name in enumerate(languages)}
    index: dict[str, int] = {}
    cells = [(index.setdefault(key, len(index)), place[lang], count) for lang, key, count in rows]
    counts = np.zeros((len(index), len(languages)))
    if cells:
        row, column, count = map(np.array, zip(*cells, strict=True))
        counts[row, column] = count
    logs = np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * len(index) + 1.0))
    return index, logs.astype(np.float32)


def _sample(labelled: DataFrame, size: int) -> DataFrame:
    """About `size` rows of each language, by a hash; all rows of a language that has fewer."""
    # One row per language, as the model has; a join would shuffle every text.
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not counts:
        return labelled.select("lang", "text")
    shares = F.create_map(*(F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, size / n)))
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return labelled.where(drawn < shares[F.col("lang")]).select("lang", "text")


def train(
    docs: DataFrame,
    learn: Column,
    docs_per_language: int = DOCS_PER_LANGUAGE,
    most_chars: int = MOST_CHARS,
    order: int = ORDER,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> Model:
    """Fit on the rows where `learn` holds, label and text are not null."""
    labelled = docs.where(learn).select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )
    usable = F.col("lang").isNotNull() & (F.length("text") <= most_chars)
    texts = _sample(labelled.where(usable), docs_per_language)
    letters = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))
    words = texts.select("lang", F.explode(letters).alias("key")).groupBy("lang", "key").agg(F.count("*").alias("n"))
    padded = F.concat(F.lit(" "), "key", F.lit(" "))
    sizes = F.array(*(F.lit(n) for n in range(1, order + 1)))
    starts = F.sequence(F.lit(1), F.length(padded))
    cut = F.flatten(F.transform(sizes, lambda n: F.transform(starts, lambda i: F.substring(padded, i, n))))
    grams = words.select("lang", "n", F.explode(cut).alias("key")).groupBy("lang", "key").agg(F.sum("n").alias("n"))

    def repeated(counts: DataFrame) -> list:
        total = F.sum("n").over(Window.partitionBy("key"))
        return [tuple(r) for r in counts.withColumn("all", total).where("all > 1").select("lang", "key", "n").collect()]

    known, pieces = repeated(words), repeated(grams)
    languages = tuple(sorted({lang for lang, *_ in pieces}))
    word_index, word_logs = _logs(known, languages)
    gram_index, gram_logs = _logs(pieces, languages)
    return Model(languages, order, word_index, word_logs, gram_index, gram_logs)


def predictor(model: Model) -> Callable[[str | None], tuple[str, float]]:
    """A function from a text to its language and score; it remembers the words it has backed off."""
    languages, known = model.languages, model.words
    backed: dict[str, np.ndarray] = {}

    def back_off(word: str) -> np.ndarray:
        padded = f" {word} "
        for size in range(model.order, 0, -1):
            rows = [r for i in range(len(padded) - size + 1) if (r := model.grams.get(padded[i : i + size])) is not None]
            if rows:
                return model.gram_logs[rows].mean(axis=0)
        return np.zeros(len(languages), dtype=np.float32)

    def predict(text: str | None) -> tuple[str, float]:
        words = letter_words((text or "").lower())
        if not words or not languages:
            return UNKNOWN, 0.0
        total = np.zeros(len(languages))
        rows = []
        for word in words:
            row = known.get(word)
            if row is not None:
                rows.append(row)
                continue
            logs = backed.get(word)
            if logs is None:
                if len(backed) >= _CACHE:
                    backed.clear()
                logs = backed[word] = back_off(word)
            total += logs
        total += model.word_logs[rows].sum(axis=0, dtype=np.float64)
        best = int(total.argmax())
        weights = np.exp((total - total[best]) * min(1.0, EVIDENCE / len(words)))
        return languages[best], float(1.0 / weights.sum())

    return predict


def _shared(docs: DataFrame, model: Model) -> Callable[[], Callable]:
    """The predictor of the model from a broadcast of its plain parts, once per task."""
    parts = docs.sparkSession.sparkContext.broadcast(
        (model.languages, model.order, model.words, model.word_logs, model.grams, model.gram_logs)
    )
    return lambda: predictor(Model(*parts.value))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score."""
    fields = [string_field("lang_pred"), StructField("score", DoubleType())]
    return per_document(narrow(docs, id_col, text_col), _shared(docs, model), fields)


def keep_identified(docs: DataFrame, model: Model, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows, all their columns unchanged, whose language is known with a score of `least`."""
    prepare, place = _shared(docs, model), docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = prepare()
        for batch in batches:
            found = map(predict, batch.column(place).to_pylist())
            yield batch.filter(pa.array([lang != UNKNOWN and score >= least for lang, score in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, trains(F.col("doc_id"), FOLDS))
    found = identify(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id"), FOLDS).alias("held_out"), "lang_pred", "score")
