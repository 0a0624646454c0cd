"""Web pages: text from HTML, blocked hosts, language by character profiles."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from html.entities import name2codepoint

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from seqloom.functions.batches import slices
from seqloom.operators.filters import let
from seqloom.session import written

#: Elements whose content is no text. What stands in the first two is no markup either.
RAW, HIDDEN = ("script", "style"), ("nav", "head", "noscript")
#: Named entities and their characters, the non-breaking space as a space.
ENTITIES = {name: " " if name == "nbsp" else chr(code) for name, code in sorted(name2codepoint.items())} | {"apos": "'"}
_SPACE = r"[\x20\x09-\x0D]+"
#: Rows of profiles that are broadcast at most.
PROFILE_ROWS = 1 << 18
#: Different character groups of a language that a task counts before it passes them on.
_GRAMS = 1 << 20

_RAW_TOKENS = "|".join(rf"<{name}\b[^>]*>.*?(?:</{name}\s*>|\z)" for name in RAW)
_TOKEN = rf"(?is)<!--.*?(?:-->|\z)|{_RAW_TOKENS}|<[!?/]?[a-z][^>]*>|[^<]+|<"
_MARKUP = "(?is)^<(!--|[!?/]?[a-z])"
_PIECE = "(?s)&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});|[^&]+|&"


def _hidden_spans(tokens: Column) -> Column:
    """(first, end) of the stretches of tokens inside hidden elements: a fold over the tags of these elements.

    Each kind of element has its own depth, never below zero, so that they nest in any way; one that
    is never closed hides the rest.
    """
    tag = rf"(?i)^</?({'|'.join(HIDDEN)})(?![^\s/>])"
    marks = F.filter(
        F.transform(
            tokens,
            lambda t, i: F.struct(
                i.alias("at"),
                F.lower(F.regexp_extract(t, tag, 1)).alias("name"),
                F.when(t.startswith("</"), -1).when(t.endswith("/>"), 0).otherwise(1).alias("step"),
            ),
        ),
        lambda m: m["name"] != "",
    )
    none = F.array().cast("array<struct<first:int,end:int>>")
    start = F.struct(F.array(*(F.lit(0) for _ in HIDDEN)).alias("depth"), F.lit(None).cast("int").alias("since"), none.alias("spans"))

    def step(state: Column, m: Column) -> Column:
        names = F.array(*map(F.lit, HIDDEN))
        depth = F.zip_with(state["depth"], names, lambda d, name: F.when(name == m["name"], F.greatest(d + m["step"], F.lit(0))).otherwise(d))
        return let(depth, lambda d: moved(state, m, d))

    def moved(state: Column, m: Column, depth: Column) -> Column:
        shown = F.array_max(depth) == 0
        closed = F.array(F.struct(state["since"].alias("first"), m["at"].alias("end")))
        spans = F.when(shown & state["since"].isNotNull(), F.concat(state["spans"], closed)).otherwise(state["spans"])
        return F.struct(depth.alias("depth"), F.when(~shown, F.coalesce(state["since"], m["at"])).alias("since"), spans.alias("spans"))

    return F.aggregate(
        marks,
        start,
        step,
        lambda x: F.when(
            x["since"].isNotNull(),
            F.concat(x["spans"], F.array(F.struct(x["since"].alias("first"), F.lit((1 << 31) - 1).alias("end")))),
        ).otherwise(x["spans"]),
    )


def unescaped(text: Column) -> Column:
    """Named and numeric entities as characters, each once; numbers of no character as U+FFFD; others stay."""
    named = F.create_map(*(F.lit(x) for pair in ENTITIES.items() for x in pair))

    def sign(code: Column) -> Column:
        valid = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        known = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(valid, known).otherwise(F.lit("\ufffd"))

    def piece(x: Column) -> Column:
        body = F.substr(x, F.lit(2), F.length(x) - 2)
        number = F.when(x.rlike("^&#[xX]"), F.conv(F.substr(body, F.lit(3)), 16, 10)).otherwise(F.substr(body, F.lit(2)))
        return (
            F.when(x.rlike("^&#.*;$"), sign(number.cast("bigint")))
            .when(x.rlike("^&.+;$"), F.coalesce(F.try_element_at(named, body), x))
            .otherwise(x)
        )

    whole = F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_PIECE), F.lit(0)), piece), "")
    return F.when(F.contains(text, F.lit("&")), whole).otherwise(text)


def text_of(html: Column) -> Column:
    """The text outside hidden elements; a tag or comment is a space, entities are unescaped, white space collapses.

    Tags are `<` with a letter behind it (or behind a slash, `!` or `?`), so `1 < 2` stays text. A `>`
    inside a quoted attribute ends its tag. Null gives the empty text.
    """

    def visible(tokens: Column) -> Column:
        def kept(spans: Column) -> Column:
            hidden = lambda i: F.exists(spans, lambda s: (i >= s["first"]) & (i < s["end"]))
            return F.transform(
                tokens, lambda t, i: F.when(t.rlike(_MARKUP), F.lit(" ")).when(hidden(i), F.lit("")).otherwise(t)
            )

        return F.array_join(let(_hidden_spans(tokens), kept), "")

    tokens = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(_TOKEN), F.lit(0))
    return F.trim(F.regexp_replace(unescaped(let(tokens, visible)), _SPACE, " "))


def extract_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """The pages with `text` instead of their HTML. Nothing is shuffled; null pages have the empty text;
    repeated rows give repeated results; a table that already has a `text` is refused."""
    if "text" in pages.columns and html != "text":
        raise ValueError("the pages already have a column text")
    found = pages.withColumn("__text", text_of(F.col(html))).drop(html)
    return found.withColumnRenamed("__text", "text")


def host_of(url: Column) -> Column:
    """Lower-case host without user and port; empty where there is none."""
    return F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)


def parents_of(host: Column) -> Column:
    """The host and every domain above it."""
    parts = F.split(host, r"\.")
    return F.transform(parts, lambda _, i: F.array_join(F.slice(parts, i + 1, F.size(parts)), "."))


def url_blocklist(pages: DataFrame, blocked: DataFrame, url: str = "url", host: str = "host") -> DataFrame:
    """The pages whose host, and every domain above it, is not in `blocked` (`host`).

    Hosts are looked up once each, however many pages they have.
    """
    hosts = pages.select(host_of(F.col(url)).alias("__host")).distinct()
    named = hosts.select("__host", F.explode(parents_of(F.col("__host"))).alias("__domain"))
    bad = blocked.select(F.lower(host).alias("__domain")).distinct()
    found = named.join(bad, "__domain", "left_semi").select("__host").distinct()
    return pages.withColumn("__host", host_of(F.col(url))).join(found, "__host", "left_anti").drop("__host")


def clean_text(text: Column) -> Column:
    """Lower case, white space collapsed, with a space at both ends; a null is empty."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), _SPACE, " ")), F.lit(" "))


def trigrams(text: Column) -> Column:
    """Groups of three characters of the text, lower case, white space collapsed, with a space at both ends."""

    def cut(letters: Column) -> Column:
        starts = F.slice(letters, F.lit(1), F.greatest(F.size(letters) - 2, F.lit(0)))
        return F.transform(starts, lambda a, i: F.concat(a, F.get(letters, i + 1), F.get(letters, i + 2)))

    return let(F.split(clean_text(text), ""), cut)


def _added(found: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and their counts, with one more for each of `keys`."""
    own, counts = np.unique(keys, return_counts=True)
    both, place = np.unique(np.concatenate([found[0], own]), return_inverse=True)
    return both, np.bincount(place, np.concatenate([found[1], counts]), len(both)).astype(np.int64)


def _gram_counts(batches: Iterable[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """lang, gram and how often a task's cleaned texts (`lang`, `text`) have it; in parts where there are many."""
    nothing = (np.empty(0, np.int64), np.empty(0, np.int64))
    found: dict = {}

    def rows(lang: object) -> pa.RecordBatch:
        keys, counts = found.pop(lang)
        points = np.stack([keys >> 42, keys >> 21 & 0x1FFFFF, keys & 0x1FFFFF], axis=1).astype("<u4")
        letters = points.tobytes().decode("utf-32-le")
        grams = [letters[n : n + 3] for n in range(0, len(letters), 3)]
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), schema.field("lang").type), pa.array(grams), pa.array(counts)], schema=schema)

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for lang in set(langs):
            texts = batch.column("text").filter(pa.array([own == lang for own in langs])).to_pylist()
            lengths = [len(text) for text in texts]
            for first, end in slices(lengths, len(texts)):
                points = np.frombuffer("".join(texts[first:end]).encode("utf-32-le"), "<u4").astype(np.int64)
                inside = np.ones(len(points), bool)
                last = np.cumsum(lengths[first:end])
                inside[np.concatenate([last - 1, last - 2])] = False  # a cleaned text has two characters at least
                at = np.flatnonzero(inside)
                found[lang] = _added(found.get(lang, nothing), points[at] << 42 | points[at + 1] << 21 | points[at + 2])
                if len(found[lang][0]) > _GRAMS:
                    yield rows(lang)
    for lang in list(found):
        yield rows(lang)


def language_profiles(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, gram, share): smoothed shares of every group of three characters in every language.

    The groups are counted where the texts are, and the counts written once: they are read twice.
    """
    known = docs.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), clean_text(F.col(text)).alias("text"))
    schema = StructType([known.schema["lang"], StructField("gram", StringType()), StructField("n", LongType())])
    added = known.mapInArrow(partial(_gram_counts, schema=to_arrow_schema(schema)), schema)
    counts = written(added.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "gram-counts")
    # One row per language is all that comes to the driver.
    totals = {r.lang: r.total for r in counts.groupBy("lang").agg(F.sum("n").alias("total")).collect()}
    by_gram = counts.groupBy("gram").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("n"))
    shares = [
        F.struct(
            F.lit(lang).alias("lang"), ((F.coalesce(F.col("n")[lang], F.lit(0)) + 0.5) / (total + 1.0)).alias("share")
        )
        for lang, total in sorted(totals.items())
    ]
    empty = F.array().cast("array<struct<lang:string,share:double>>")
    return by_gram.select("gram", F.inline(F.array(*shares) if shares else empty)).select("lang", "gram", "share")


def language_scores(docs: DataFrame, profiles: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang, score): the mean log share of the document's groups; groups in no profile are left out.

    Profiles of up to PROFILE_ROWS rows go to the texts: their groups are then summed where they are, and
    a text's sums are all that is shuffled. Larger ones meet the groups by a shuffle, counted before.
    """
    profiles = written(profiles, "profiles")
    own = docs.select(key, F.explode(trigrams(F.col(text))).alias("gram"))
    if profiles.count() <= PROFILE_ROWS:
        joined = own.join(F.broadcast(profiles.select("lang", "gram", F.log("share").alias("chance"))), "gram")
        return joined.groupBy(key, "lang").agg((F.sum("chance") / F.count("*")).alias("score"))
    joined = own.groupBy(key, "gram").agg(F.count("*").alias("n")).join(profiles, "gram")
    return joined.groupBy(key, "lang").agg((F.sum(F.col("n") * F.log("share")) / F.sum("n")).alias("score"))


def language_id(docs: DataFrame, profiles: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, `predicted` language (null for texts without a known group) and its score."""
    scores = language_scores(docs, profiles, key, text)
    best = scores.groupBy(key).agg(F.max(F.struct("score", "lang")).alias("b"))
    return docs.select(key).join(best, key, "left").select(key, F.col("b.lang").alias("predicted"), F.col("b.score").alias("score"))
