"""Language identification on unseen documents and odd texts."""

import math
from collections import Counter, defaultdict

import pytest
import regex
from pyspark.sql import functions as F

from seqloom.llm import language_id as li
from seqloom.llm.common import table, trains


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return li.train(table(spark, sf_dir, "documents"), trains(F.col("doc_id"), 4))


def test_unseen_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = li.op8_language_id(spark, sf_dir).join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    row = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert row[0] > 0.97 and row[1] > 200


def test_odd_texts(spark, model):
    rows = [(1, None, 0), (2, "", 0), (3, " 12 #$%", 0), (None, "the of and in", 0), (5, "the of and in " * 50_000, 0), (5, "la de que", 0), (6, "½ ² ① Ⅷ ৴", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    got = {(r.doc_id, r.lang_pred) for r in li.identify(docs, model).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (None, "en"), (5, "en"), (6, "und")} < got and len(got) == 7
    assert li.identify(docs.limit(0), model).count() == 0
    assert li.keep_identified(docs, model).columns == docs.columns
    assert li.keep_identified(docs, model).count() == 3


def plain_model(rows, order):
    """Log frequencies of words and n-grams by language, from plain dictionaries."""
    words, grams = defaultdict(Counter), defaultdict(Counter)
    for text, lang in rows:
        for word in regex.findall(r"\p{L}+", text.lower()):
            words[word][lang] += 1
            padded = f" {word} "
            for size in range(1, order + 1):
                for i in range(len(padded)):  # the cuts at the end are shorter
                    grams[padded[i : i + size]][lang] += 1
    languages = sorted({lang for _, lang in rows})

    def logs(table):
        kept = {k: c for k, c in table.items() if sum(c.values()) > 1}
        total = {lang: sum(c[lang] for c in kept.values()) for lang in languages}
        return {k: [math.log((c[lang] + 0.5) / (total[lang] + 0.5 * len(kept) + 1)) for lang in languages] for k, c in kept.items()}

    return languages, logs(words), logs(grams)


def plain_predict(model, order, text):
    languages, words, grams = model
    found = regex.findall(r"\p{L}+", (text or "").lower())
    if not found:
        return "und", 0.0
    total = [0.0] * len(languages)
    for word in found:
        own = words.get(word)
        for size in range(order, 0, -1):
            if own:
                break
            padded = f" {word} "
            hits = [grams[g] for i in range(len(padded) - size + 1) if (g := padded[i : i + size]) in grams]
            own = [sum(x) / len(hits) for x in zip(*hits, strict=True)] if hits else None
        total = [a + b for a, b in zip(total, own or [0.0] * len(total), strict=True)]
    best = max(range(len(total)), key=lambda n: (total[n], -n))
    heat = min(1.0, li.EVIDENCE / len(found))
    return languages[best], 1 / sum(math.exp((x - total[best]) * heat) for x in total)


def test_predictions_are_those_of_plain_dictionaries(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = [(r.text, r.lang) for r in docs.where(trains(F.col("doc_id"), 4)).collect()]
    plain = plain_model(rows, li.ORDER)
    odd = ["", "½", "xyzzy qwrtp", "la", "été2 naïve", "中文"]
    texts = spark.createDataFrame([(n, t) for n, t in enumerate(odd)], "doc_id long, text string").union(docs.select("doc_id", "text"))
    model = li.train(docs, trains(F.col("doc_id"), 4))
    got = li.identify(texts, model).collect()
    for (text,), r in zip(texts.select("text").collect(), got, strict=True):
        lang, score = plain_predict(plain, li.ORDER, text)
        assert r.lang_pred == lang and r.score == pytest.approx(score, abs=1e-3), text


def test_words_are_runs_of_letters():
    for text in ["", "a½b ²", "éà①ü x_y 3z", "中文Ⅷ abc", "plain words only", "e\u0301 ǅ ª"]:
        assert li.letter_words(text) == regex.findall(r"\p{L}+", text)


def test_unknown_words_back_off(model):
    predict = li.predictor(model)
    assert predict("xingthering nthanding")[0] == "en"
    assert predict("queñación ciónmente")[0] == "es"


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b", None)], "doc_id long, text string, lang string")
    empty = li.train(docs, F.lit(True))
    assert li.identify(docs, empty).first()["lang_pred"] == "und"
