"""Registered queries of corpus curation: duplicates and filters, and the SQL each must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.operators import dedup, filters
from seqloom.plans import fixtures as fx


def dedup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedup_exact(fx.table(spark, sf_dir, "documents"))


def minhash_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup.minhash_signature(fx.table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("signature", ",").alias("signature"))


def dedup_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.minhash_clusters(fx.table(spark, sf_dir, "documents"))


def dedup_per_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.minhash_clusters(fx.table(spark, sf_dir, "documents"), within=("source",))


def dedup_across_dumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.table(spark, sf_dir, "documents")
    return dedup.keep_newest(docs, dedup.minhash_clusters(docs), "source")


def dedup_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    clusters = dedup_minhash(spark, sf_dir).withColumn("kept", F.col("doc_id") == F.col("cluster_id"))
    report = dedup.dedup_report(clusters, fx.table(spark, sf_dir, "labels"))
    return report.withColumns({c: F.round(c, 6) for c in ("mean_quality", "mean_toxic")})


def dedup_cluster_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.cluster_sizes(dedup_minhash(spark, sf_dir))


def quality_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.quality_filters(fx.table(spark, sf_dir, "documents"))


def repetition_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.repetition_filters(fx.table(spark, sf_dir, "documents"))


def heuristic_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.heuristic_filters(fx.table(spark, sf_dir, "documents"))


def heuristic_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.heuristic_score(heuristic_filters(spark, sf_dir))


QUERIES = {
    "dedup_exact": dedup_exact,
    "minhash_signature": minhash_signature,
    "dedup_minhash": dedup_minhash,
    "dedup_per_dump": dedup_per_dump,
    "dedup_across_dumps": dedup_across_dumps,
    "dedup_report": dedup_report,
    "dedup_cluster_sizes": dedup_cluster_sizes,
    "quality_filters": quality_filters,
    "repetition_filters": repetition_filters,
    "heuristic_filters": heuristic_filters,
    "heuristic_score": heuristic_score,
}

# --- the same in DuckDB SQL -----------------------------------------------------------------

_S = r"\x20\x09-\x0D"
_PRIME = dedup.PRIME
_MINIMA = ", ".join(f"min((h * {a} + {b}) % {_PRIME})" for a, b in dedup.coefficients(dedup.BANDS * dedup.BAND_ROWS))
_SIGNED = rf"""w AS (
  SELECT doc_id, source, regexp_extract_all(coalesce(text, ''), '[^{_S}]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, source, array_to_string(w[i + 1:i + 5], ' ') AS s
      FROM (SELECT *, unnest(range(0, greatest(len(w) - 4, 1))) AS i FROM w WHERE len(w) > 0)),
h AS (SELECT doc_id, source, ('0x' || substr(md5(s), 1, 8))::BIGINT % {_PRIME} AS h FROM s),
m AS (SELECT doc_id, source, [{_MINIMA}] AS signature FROM h GROUP BY doc_id, source)"""


def _clusters(within: str = "") -> str:
    by = f"band, values{within}"
    return f"""{_SIGNED},
b AS (SELECT doc_id, source, band, array_to_string(signature[band * 8 + 1:band * 8 + 8], ',') AS values
      FROM m, range(0, {dedup.BANDS}) AS r(band)),
e AS (SELECT DISTINCT doc_id AS u, low AS v FROM (
        SELECT doc_id, min(doc_id) OVER (PARTITION BY {by}) AS low FROM b) WHERE doc_id <> low),
n AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
reach(u, v) AS (SELECT u, v FROM n UNION SELECT reach.u, n.v FROM reach JOIN n ON reach.v = n.u),
clusters AS (SELECT doc_id, source, least(doc_id, coalesce(low, doc_id)) AS cluster_id FROM documents
      LEFT JOIN (SELECT u, min(v) AS low FROM reach GROUP BY u) ON u = doc_id)"""


_LINES = rf"""list_filter(list_transform(string_split(coalesce(text, ''), chr(10)),
    lambda x: regexp_replace(x, '^[{_S}]+|[{_S}]+$', '', 'g')), lambda x: x <> '')"""
_PARAGRAPHS = rf"""list_filter(list_transform(regexp_split_to_array(coalesce(text, ''), '\n[{_S}]*\n'),
    lambda x: regexp_replace(x, '^[{_S}]+|[{_S}]+$', '', 'g')), lambda x: x <> '')"""
_WORDS = f"regexp_extract_all(coalesce(text, ''), '[^{_S}]+')"
_STOPS = ", ".join(f"'{w}'" for w in filters.STOP_WORDS)


def _chars(items: str) -> str:
    return f"coalesce(list_sum(list_transform({items}, lambda x: length(x))), 0)"


_SIGNALS = rf"""t AS (SELECT doc_id, coalesce(text, '') AS t, {_LINES} AS l FROM documents),
f AS (SELECT doc_id,
    round(CASE WHEN len(l) > 0 THEN len(list_filter(l, lambda x: regexp_matches(x, '[.!?"'']$'))) / len(l) ELSE 0 END, 6) AS terminal,
    round(CASE WHEN len(l) > 0 THEN ({_chars('l')} - {_chars('list_distinct(l)')}) / {_chars('l')} ELSE 0 END, 6) AS repeated,
    round(CASE WHEN len(l) > 0 THEN len(list_filter(l, lambda x: length(x) < 30)) / len(l) ELSE 0 END, 6) AS short,
    round(CASE WHEN length(t) > 0 THEN length(regexp_replace(t, '[\p{{L}}{_S}]+', '', 'g')) / length(t) ELSE 0 END, 6) AS symbols,
    round(CASE WHEN len(l) > 0 THEN len(list_filter(l, lambda x: regexp_matches(lower(x), '{"|".join(filters.ADVERTS)}'))) / len(l)
          ELSE 0 END, 6) AS adverts
  FROM t)"""
_SCORE = " + ".join(
    f"{w} * {name if name == 'terminal' else f'(1 - {name})'}" for name, w in filters.WEIGHTS.items()
)


def _repetition_sql() -> str:
    sizes = {**filters.TOP_GRAMS, **filters.REPEATED_GRAMS}
    columns = []
    for n in sizes:
        name = f"top_{n}" if n in filters.TOP_GRAMS else f"repeated_{n}"
        part = "top" if n in filters.TOP_GRAMS else "repeated"
        columns.append(f"round(coalesce(max(CASE WHEN n = {n} THEN {part} / chars END), 0), 6) AS {name}")
    limits = " AND ".join(
        [f"top_{n} <= {x}" for n, x in filters.TOP_GRAMS.items()] + [f"repeated_{n} <= {x}" for n, x in filters.REPEATED_GRAMS.items()]
    )
    shares = ", ".join(
        f"""round(CASE WHEN len({x}) > 0 THEN (len({x}) - len(list_distinct({x}))) / len({x}) ELSE 0 END, 6) AS {kind}_share,
        round(CASE WHEN len({x}) > 0 THEN ({_chars(x)} - {_chars(f"list_distinct({x})")}) / {_chars(x)} ELSE 0 END, 6) AS {kind}_char_share"""
        for kind, x in (("line", "l"), ("paragraph", "p"))
    )
    return f"""WITH d AS (SELECT doc_id, {_WORDS} AS w, {_LINES} AS l, {_PARAGRAPHS} AS p FROM documents),
g AS (SELECT doc_id, n, array_to_string(w[i + 1:i + n], ' ') AS g
      FROM (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS i FROM d, range(2, 11) AS r(n))),
c AS (SELECT doc_id, n, g, count(*) AS k FROM g GROUP BY ALL),
p AS (SELECT doc_id, n, sum(k * length(g)) AS chars,
             coalesce(max(CASE WHEN k > 1 THEN k * length(g) END), 0) AS top,
             coalesce(sum(CASE WHEN k > 1 THEN k * length(g) END), 0) AS repeated FROM c GROUP BY ALL),
x AS (SELECT doc_id, {", ".join(columns)} FROM d LEFT JOIN p USING (doc_id) GROUP BY doc_id),
y AS (SELECT doc_id, {shares} FROM d)
SELECT *, line_share <= 0.30 AND line_char_share <= 0.20 AND paragraph_share <= 0.30 AND paragraph_char_share <= 0.20
    AND {limits} AS kept FROM y JOIN x USING (doc_id)"""


ORACLES = {
    "dedup_exact": rf"""SELECT min(doc_id) AS doc_id, count(*) AS copies FROM (
        SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '[{_S}]+', ' ', 'g'), ' ') AS t FROM documents) GROUP BY t""",
    "minhash_signature": f"WITH {_SIGNED} SELECT doc_id, array_to_string(signature, ',') AS signature FROM m",
    "dedup_minhash": f"WITH RECURSIVE {_clusters()} SELECT doc_id, cluster_id FROM clusters",
    "dedup_per_dump": f"WITH RECURSIVE {_clusters(', source')} SELECT doc_id, cluster_id FROM clusters",
    "dedup_across_dumps": f"""WITH RECURSIVE {_clusters()}
        SELECT doc_id, cluster_id,
               row_number() OVER (PARTITION BY cluster_id ORDER BY source DESC, doc_id) = 1 AS kept FROM clusters""",
    "dedup_report": f"""WITH RECURSIVE {_clusters()}
        SELECT doc_id = cluster_id AS kept, count(*) AS documents, count(quality) AS labelled,
               round(avg(quality), 6) AS mean_quality, round(avg(toxic), 6) AS mean_toxic
        FROM clusters LEFT JOIN labels USING (doc_id) GROUP BY 1""",
    "dedup_cluster_sizes": f"""WITH RECURSIVE {_clusters()}
        SELECT size, count(*) AS clusters, CAST(sum(size) AS BIGINT) AS documents
        FROM (SELECT count(*) AS size FROM clusters GROUP BY cluster_id) GROUP BY size""",
    "quality_filters": rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w, {_LINES} AS l FROM documents),
f AS (SELECT doc_id, len(w) BETWEEN 50 AND 100000 AS word_count,
    {_chars('w')} BETWEEN 3 * len(w) AND 10 * len(w) AS word_length,
    10 * (length(t) - length(replace(t, '#', '')) + len(regexp_extract_all(t, '\.\.\.|…'))) <= len(w) AS symbols,
    10 * len(list_filter(l, lambda x: regexp_matches(x, '^[-*•]'))) <= 9 * len(l) AS bullets,
    10 * len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)$'))) <= 3 * len(l) AS ellipsis,
    10 * len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) >= 8 * len(w) AS letters,
    len(list_filter([{_STOPS}], lambda s: list_contains(w, s))) >= 2 AS stop_words FROM d),
r AS (SELECT *, array_to_string(list_filter([{", ".join(
        f"CASE WHEN NOT {c} THEN '{c}' END"
        for c in ("word_count", "word_length", "symbols", "bullets", "ellipsis", "letters", "stop_words")
    )}], lambda x: x IS NOT NULL), ',') AS reasons FROM f)
SELECT *, reasons = '' AS kept FROM r""",
    "repetition_filters": _repetition_sql(),
    "heuristic_filters": f"""WITH {_SIGNALS} SELECT *, terminal > 0.12 AND repeated < 0.1 AND short < 0.67
        AND symbols < 0.3 AND adverts < 0.5 AS kept FROM f""",
    "heuristic_score": f"WITH {_SIGNALS} SELECT doc_id, round({_SCORE}, 6) AS score FROM f",
}
