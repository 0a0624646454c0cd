"""Registered queries of web text, vocabulary, subsets and conversations, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.operators import curation, dedup, filters, vocabulary, web
from seqloom.plans import curation_queries
from seqloom.plans import fixtures as fx
from seqloom.session import new_folder, written

BLOCKED = ("ththre.example.com", "example.org", "ads.example.net")
BASE_SOURCES = ("src0", "src1", "src2", "src3")
VOCAB_SIZE, PER_STRATUM = 2000, 3
#: Lookups over the word index: all words of a list, complete and in any case.
LOOKUPS = {"one": ["ther"], "two": ["IN", "are"], "mixed": ["est", "heth", "ier"], "absent": ["in", "qqqq"], "sign": [".", "im"]}
LANGUAGE = "en"
FEATURES = {"n_words": (0, 1000, 10), "n_chars": (0, 8000, 8)}


def extract_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.extract_text(fx.table(spark, sf_dir, "pages"))


def _blocked(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(h,) for h in BLOCKED], "host string")


def url_blocklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.url_blocklist(fx.table(spark, sf_dir, "pages"), _blocked(spark)).select("page_id", "url")


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.table(spark, sf_dir, "documents")
    found = web.language_id(docs, web.language_profiles(docs))
    return found.withColumn("score", F.round("score", 6))


def build_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocabulary.build_vocab(fx.table(spark, sf_dir, "documents"), max_size=VOCAB_SIZE)


def _encoded(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    vocab = written(build_vocab(spark, sf_dir), "vocabulary")
    return vocabulary.encode_vocab(fx.table(spark, sf_dir, "documents"), vocab), vocab


def encode_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _encoded(spark, sf_dir)[0].select("doc_id", F.size("ids").cast("bigint").alias("n"), F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids"))


def decode_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocabulary.decode_vocab(*_encoded(spark, sf_dir))


def word_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vocabulary.word_index(fx.table(spark, sf_dir, "documents"))
    return found.withColumn("postings", F.array_join(F.col("postings").cast("array<string>"), " "))


def word_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold all words of LOOKUPS, by the written index of all documents."""
    path = new_folder(spark, "word-index")
    vocabulary.write_word_index(fx.table(spark, sf_dir, "documents"), path)
    return vocabulary.word_lookup(spark, path, LOOKUPS)


def ngram_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.table(spark, sf_dir, "documents")
    base = docs.where(F.col("source").isin(*BASE_SOURCES))
    return vocabulary.ngram_perplexity(base, docs).withColumn("perplexity", F.round("perplexity", 4))


def perplexity_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ngram_perplexity(spark, sf_dir).join(fx.table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    return vocabulary.perplexity_distribution(scored, "source").withColumn("mean", F.round("mean", 4))


def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.table(spark, sf_dir, "documents")
    return curation.stratified_sample(docs, ["source", "lang"], PER_STRATUM)


def filter_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.table(spark, sf_dir, "documents")
    counted = docs.select("doc_id", F.size(filters.words_of(F.col("text"))).alias("n_words"), F.length("text").alias("n_chars"))
    unique = counted.join(dedup.dedup_exact(docs).select("doc_id"), "doc_id")
    good = fx.table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    found = curation.filter_discovery(unique, counted.join(good, "doc_id"), FEATURES)
    return found.select("feature", F.col("bucket").cast("bigint"), *(F.round(c, 6).alias(c) for c in ("first_share", "second_share", "ratio")))


def dedup_semantic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.dedup_semantic(fx.table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label", 0.95, border=0.5)


def dedup_semantic_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors and a changed copy of each, in cells of 32: even ids stay within the similarity, odd ones do not."""
    vectors = fx.table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    factor = lambda i: 1 + (F.pmod(F.col("vec_id") * 31 + i * 17, F.lit(7)) - 3) / 3 * (1 + F.col("vec_id") % 2) * 0.25
    changed = F.transform("embedding", lambda x, i: x.cast("double") * factor(i))
    whole = vectors.withColumn("embedding", F.col("embedding").cast("array<double>"))
    copies = vectors.withColumn("embedding", changed).withColumn("vec_id", -1 - F.col("vec_id"))
    return curation.dedup_semantic(whole.unionByName(copies), "vec_id", "embedding", "label", 0.95, cell=32, border=0.5)


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.quality_classifier(fx.table(spark, sf_dir, "documents"), fx.table(spark, sf_dir, "labels"), "quality")


def classifier_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well the classifier ranks the labelled rows it learned from, and those it did not."""
    labels = fx.table(spark, sf_dir, "labels")
    return curation.classifier_quality(written(quality_classifier(spark, sf_dir), "scores"), labels, "quality")


def sft_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.sft_pairs(fx.table(spark, sf_dir, "conversations"))


def preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant turns of a conversation as answers to its first user turn, scored by their length."""
    turns = fx.table(spark, sf_dir, "conversations")
    prompts = turns.where("role = 'user'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("asked"))
    answers = turns.where("role = 'assistant'").join(prompts, "conv_id")
    scored = answers.select(F.concat_ws(": ", F.col("conv_id").cast("string"), "asked").alias("prompt"), F.col("text").alias("answer"), F.length("text").alias("score"), F.concat(F.lit("turn "), "turn").alias("reason"))
    return curation.preference_pairs(scored, 10, reason="reason").withColumn("margin", F.col("margin").cast("bigint"))


def pipeline_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages left after each stage: text, blocked hosts, quality, exact copies, heuristics, score."""
    pages = written(web.extract_text(web.url_blocklist(fx.table(spark, sf_dir, "pages"), _blocked(spark))), "pages")
    good = filters.quality_filters(pages, "page_id").where("kept").select("page_id")
    good = written(pages.join(good, "page_id", "left_semi"), "good-pages")
    unique = written(good.join(dedup.dedup_exact(good, "page_id").select("page_id"), "page_id", "left_semi"), "unique-pages")
    signals = written(filters.heuristic_filters(unique, "page_id"), "signals")
    scored = filters.heuristic_score(signals.where("kept"), "page_id").where("score >= 0.5")
    stages = [
        ("1 pages", fx.table(spark, sf_dir, "pages")),
        ("2 allowed hosts", pages),
        ("3 quality", good),
        ("4 exact copies", unique),
        ("5 heuristics", signals.where("kept")),
        ("6 score", scored),
    ]
    rows = [df.agg(F.count("*").alias("pages")).select(F.lit(name).alias("stage"), "pages") for name, df in stages]
    found = rows[0]
    for row in rows[1:]:
        found = found.unionByName(row)
    return found


def pipeline_funnel_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages left after each stage of the survey's whole pipeline, and the tokens of the last.

    Beside the stages of `pipeline_funnel`: pages in LANGUAGE, by profiles of `documents`; one page of
    each MinHash cluster behind the exact copies; tokenized pages.
    """
    docs = fx.table(spark, sf_dir, "documents")
    pages = written(web.extract_text(web.url_blocklist(fx.table(spark, sf_dir, "pages"), _blocked(spark))), "pages")
    profiles = written(web.language_profiles(docs), "profiles")
    named = web.language_id(pages, profiles, "page_id").where(F.col("predicted") == LANGUAGE).select("page_id")
    spoken = written(pages.join(named, "page_id", "left_semi"), "spoken-pages")
    good = filters.quality_filters(spoken, "page_id").where("kept").select("page_id")
    good = written(spoken.join(good, "page_id", "left_semi"), "good-pages")
    unique = written(good.join(dedup.dedup_exact(good, "page_id").select("page_id"), "page_id", "left_semi"), "unique-pages")
    first = dedup.minhash_clusters(unique, "page_id").where("page_id = cluster_id").select("page_id")
    single = written(unique.join(first, "page_id", "left_semi"), "single-pages")
    signals = written(filters.heuristic_filters(single, "page_id"), "signals")
    best = filters.heuristic_score(signals.where("kept"), "page_id").where("score >= 0.5").select("page_id")
    scored = written(single.join(best, "page_id", "left_semi"), "scored-pages")
    vocab = written(vocabulary.build_vocab(scored, max_size=VOCAB_SIZE), "vocabulary")
    coded = vocabulary.encode_vocab(scored, vocab, "page_id").withColumn("n", F.size("ids")).where("n > 0")
    stages = [
        ("1 pages", fx.table(spark, sf_dir, "pages")),
        ("2 allowed hosts", pages),
        ("3 language", spoken),
        ("4 quality", good),
        ("5 exact copies", unique),
        ("6 near copies", single),
        ("7 heuristics", signals.where("kept")),
        ("8 score", scored),
    ]
    found = coded.agg(F.count("*").alias("pages"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"))
    found = found.select(F.lit("9 tokenized").alias("stage"), "pages", "tokens")
    for name, df in stages:
        row = df.agg(F.count("*").alias("pages"))
        found = found.unionByName(row.select(F.lit(name).alias("stage"), "pages", F.lit(0).cast("bigint").alias("tokens")))
    return found


QUERIES = {
    "extract_text": extract_text,
    "url_blocklist": url_blocklist,
    "language_id": language_id,
    "build_vocab": build_vocab,
    "encode_vocab": encode_vocab,
    "decode_vocab": decode_vocab,
    "word_index": word_index,
    "word_lookup": word_lookup,
    "ngram_perplexity": ngram_perplexity,
    "perplexity_by_source": perplexity_by_source,
    "stratified_sample": stratified_sample,
    "filter_discovery": filter_discovery,
    "dedup_semantic": dedup_semantic,
    "dedup_semantic_copies": dedup_semantic_copies,
    "quality_classifier": quality_classifier,
    "classifier_quality": classifier_quality,
    "sft_pairs": sft_pairs,
    "preference_pairs": preference_pairs,
    "pipeline_funnel": pipeline_funnel,
    "pipeline_funnel_whole": pipeline_funnel_whole,
}

# --- the same in DuckDB SQL -----------------------------------------------------------------

_S = r"\x20\x09-\x0D"


def _texts_sql(pages: str) -> str:
    """page_id, url and text of `pages`: tokens as rows, running depths of the hidden elements by window."""
    raw = "|".join(rf"<{n}\b[^>]*>.*?(</{n}[ \t\n\v\f\r]*>|\z)" for n in web.RAW)
    steps = ", ".join(
        rf"""CASE WHEN NOT regexp_matches(tok, '(?i)^</?{n}([ \t\n\v\f\r/][^>]*)?>$') THEN 0
             WHEN tok[2] = '/' THEN -1 WHEN tok[-2] = '/' THEN 0 ELSE 1 END AS d{k}"""
        for k, n in enumerate(web.HIDDEN)
    )
    kinds = range(len(web.HIDDEN))
    sums = ", ".join(f"sum(d{k}) OVER w AS s{k}" for k in kinds)
    depth = " AND ".join(f"s{k} = least(0, m{k})" for k in kinds)
    names = ", ".join(f"'&{n};': '{c.replace(chr(39), chr(39) * 2)}'" for n, c in web.ENTITIES.items())
    code = "(CASE WHEN lower(x[3]) = 'x' THEN ('0x' || x[4:-2])::BIGINT ELSE x[3:-2]::BIGINT END)"
    piece = f"""CASE WHEN x[1] <> '&' OR x[-1] <> ';' OR length(x) < 2 THEN x
        WHEN x[2] = '#' THEN CASE WHEN {code} BETWEEN 1 AND 55295 OR {code} BETWEEN 57344 AND 1114111 THEN chr({code}::INT) ELSE chr(65533) END
        ELSE coalesce(names[x], x) END"""
    return rf"""(WITH named AS (SELECT MAP {{{names}}} AS names), cut AS (
  SELECT page_id, url, regexp_extract_all(coalesce(html, ''), '(?is)<!--.*?(-->|\z)|{raw}|<[!?/]?[a-z][^>]*>|[^<]+|<') AS t FROM ({pages})),
tok AS (SELECT page_id, unnest(t) AS tok, unnest(range(len(t))) AS i FROM cut),
steps AS (SELECT page_id, i, tok, regexp_matches(tok, '(?is)^<(!--|[!?/]?[a-z])') AS markup, {steps} FROM tok),
sums AS (SELECT *, {sums} FROM steps WINDOW w AS (PARTITION BY page_id ORDER BY i)),
lows AS (SELECT *, {", ".join(f"min(s{k}) OVER w AS m{k}" for k in kinds)} FROM sums WINDOW w AS (PARTITION BY page_id ORDER BY i)),
joined AS (SELECT page_id, string_agg(CASE WHEN markup THEN ' ' WHEN {depth} THEN tok ELSE '' END, '' ORDER BY i) AS raw FROM lows GROUP BY page_id),
clean AS (SELECT page_id, array_to_string(list_transform(
    regexp_extract_all(raw, '(?s)&(#[0-9]{{1,7}}|#[xX][0-9a-fA-F]{{1,6}}|[A-Za-z][A-Za-z0-9]{{1,31}});|[^&]+|&'), lambda x: {piece}), '') AS c
  FROM joined, named)
SELECT page_id, url, trim(regexp_replace(coalesce(c, ''), '[{_S}]+', ' ', 'g'), ' ') AS text FROM cut LEFT JOIN clean USING (page_id))"""


def _semantic_sql(vectors: str) -> str:
    """All pairs of a label, and what they reach."""
    return f"""WITH RECURSIVE v AS ({vectors}),
n AS (SELECT *, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v),
u AS (SELECT vec_id, label, list_transform(e, lambda x: x / norm) AS e FROM n WHERE norm > 0),
m AS (SELECT x.vec_id AS a, y.vec_id AS b FROM u x JOIN u y ON x.label = y.label AND x.vec_id <> y.vec_id
      WHERE list_dot_product(x.e, y.e) >= 0.95),
reach(a, b) AS (SELECT a, b FROM m UNION SELECT reach.a, m.b FROM reach JOIN m ON reach.b = m.a)
SELECT vec_id, least(vec_id, coalesce(low, vec_id)) AS cluster_id
FROM v LEFT JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) ON a = vec_id"""


_HOST = r"regexp_extract(lower(coalesce(url, '')), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)"
_ALLOWED = f"""SELECT * FROM pages WHERE len(list_filter([{", ".join(f"'{h}'" for h in BLOCKED)}],
    lambda b: {_HOST} = b OR ends_with({_HOST}, '.' || b))) = 0"""
_TOKENS = rf"[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}{_S}]"
_VOCAB = rf"""t AS (SELECT doc_id, unnest(w) AS token, unnest(range(1, len(w) + 1)) AS spot
      FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_TOKENS}') AS w FROM documents)),
v AS (SELECT unnest(range({len(vocabulary.SPECIALS)})) AS id, unnest([{", ".join(f"'{s}'" for s in vocabulary.SPECIALS)}]) AS token, 0 AS count
      UNION ALL SELECT row_number() OVER (ORDER BY count DESC, token) + {len(vocabulary.SPECIALS) - 1}, token, count FROM (
        SELECT token, count(*) AS count FROM t GROUP BY token HAVING count(*) >= 2
        ORDER BY count DESC, token LIMIT {VOCAB_SIZE - len(vocabulary.SPECIALS)}))"""
_ENCODED = f"""{_VOCAB},
e AS (SELECT doc_id, spot, coalesce(id, {vocabulary.UNKNOWN}) AS id FROM t LEFT JOIN v USING (token))"""



def _on(table: str, sql: str) -> str:
    """The SQL of a query over `documents`, reading another table."""
    return sql.strip().replace("WITH", f"WITH documents AS (SELECT * FROM {table}),", 1)


_FUNNEL = rf"""WITH a AS (SELECT page_id AS doc_id, text FROM {_texts_sql(_ALLOWED)}),
q AS ({_on("a", curation_queries.ORACLES["quality_filters"])}),
good AS (SELECT a.* FROM a JOIN q USING (doc_id) WHERE kept),
one AS (SELECT * FROM good QUALIFY row_number() OVER (
  PARTITION BY trim(regexp_replace(text, '[{_S}]+', ' ', 'g'), ' ') ORDER BY doc_id) = 1),
h AS ({_on("one", curation_queries.ORACLES["heuristic_filters"])}),
x AS ({_on("one", curation_queries.ORACLES["heuristic_score"])})
SELECT '1 pages' AS stage, count(*) AS pages FROM pages
UNION ALL SELECT '2 allowed hosts', count(*) FROM a
UNION ALL SELECT '3 quality', count(*) FROM good
UNION ALL SELECT '4 exact copies', count(*) FROM one
UNION ALL SELECT '5 heuristics', count(*) FROM h WHERE kept
UNION ALL SELECT '6 score', count(*) FROM h JOIN x USING (doc_id) WHERE kept AND score >= 0.5"""

ORACLES = {
    "pipeline_funnel": _FUNNEL,
    "extract_text": f"SELECT page_id, url, text FROM {_texts_sql('SELECT * FROM pages')}",
    "url_blocklist": f"SELECT page_id, url FROM ({_ALLOWED})",
    "language_id": rf"""WITH c AS (SELECT doc_id, lang, ' ' || trim(regexp_replace(lower(coalesce(text, '')), '[{_S}]+', ' ', 'g'), ' ') || ' ' AS t FROM documents),
g AS (SELECT doc_id, lang, substr(t, i, 3) AS gram FROM (SELECT *, unnest(range(1, length(t) - 1)) AS i FROM c)),
n AS (SELECT lang, gram, count(*) AS n FROM g WHERE lang IS NOT NULL GROUP BY ALL),
z AS (SELECT lang, sum(n) AS total FROM n GROUP BY lang),
p AS (SELECT z.lang, a.gram, (coalesce(n.n, 0) + 0.5) / (z.total + 1.0) AS share
      FROM (SELECT DISTINCT gram FROM n) a CROSS JOIN z LEFT JOIN n ON n.lang = z.lang AND n.gram = a.gram),
o AS (SELECT doc_id, gram, count(*) AS n FROM g GROUP BY ALL),
s AS (SELECT doc_id, p.lang, sum(o.n * ln(share)) / sum(o.n) AS score FROM o JOIN p USING (gram) GROUP BY ALL)
SELECT doc_id, predicted, round(score, 6) AS score FROM documents LEFT JOIN (
  SELECT doc_id, lang AS predicted, score FROM s
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lang DESC) = 1) USING (doc_id)""",
    "build_vocab": f"WITH {_VOCAB} SELECT * FROM v",
    "encode_vocab": f"""WITH {_ENCODED}
        SELECT doc_id, count(id) AS n, coalesce(string_agg(id, ' ' ORDER BY spot), '') AS ids
        FROM documents LEFT JOIN e USING (doc_id) GROUP BY doc_id""",
    "decode_vocab": f"""WITH {_ENCODED}
        SELECT doc_id, coalesce(string_agg(v.token, ' ' ORDER BY spot), '') AS text
        FROM documents LEFT JOIN e USING (doc_id) LEFT JOIN v USING (id) GROUP BY doc_id""",
    "word_index": rf"""SELECT word, doc_id // 4096 AS shard, count(*) AS documents, string_agg(doc_id, ' ' ORDER BY doc_id) AS postings
        FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '{_TOKENS}')) AS word FROM documents) GROUP BY ALL""",
    "ngram_perplexity": rf"""WITH t AS (
  SELECT doc_id, source, unnest(list_prepend('', w)[:len(w)]) AS before, unnest(w) AS word
  FROM (SELECT doc_id, source, regexp_extract_all(lower(coalesce(text, '')), '{_TOKENS}') AS w FROM documents)),
n AS (SELECT before, word, count(*) AS n FROM t WHERE source IN ({", ".join(f"'{s}'" for s in BASE_SOURCES)}) GROUP BY ALL),
c AS (SELECT before, sum(n) AS total FROM n GROUP BY before),
v AS (SELECT count(DISTINCT word) + 1 AS size FROM n)
SELECT doc_id, count(*) AS tokens,
       round(exp(-avg(ln((coalesce(n, 0) + 0.1) / (coalesce(total, 0) + 0.1 * size)))), 4) AS perplexity
FROM t LEFT JOIN n USING (before, word) LEFT JOIN c USING (before), v GROUP BY doc_id""",
    "stratified_sample": f"""SELECT doc_id, source, lang, place FROM (SELECT *, row_number() OVER (
        PARTITION BY source, lang ORDER BY md5('42:' || doc_id), doc_id) AS place FROM documents) WHERE place <= {PER_STRATUM}""",
    "filter_discovery": rf"""WITH d AS (
  SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^{_S}]+')) AS n_words, length(text) AS n_chars,
         row_number() OVER (PARTITION BY trim(regexp_replace(coalesce(text, ''), '[{_S}]+', ' ', 'g'), ' ') ORDER BY doc_id) = 1 AS one FROM documents),
u AS (SELECT 'first' AS side, n_words, n_chars FROM d WHERE one
      UNION ALL SELECT 'second', n_words, n_chars FROM d JOIN labels USING (doc_id) WHERE quality = 1),
b AS (SELECT side, 'n_words' AS feature, CASE WHEN n_words >= 1000 THEN 11 ELSE n_words // 100 + 1 END AS bucket FROM u
      UNION ALL SELECT side, 'n_chars', CASE WHEN n_chars >= 8000 THEN 9 ELSE n_chars // 1000 + 1 END FROM u),
h AS (SELECT side, feature, bucket, count(*) / sum(count(*)) OVER (PARTITION BY side, feature) AS share FROM b GROUP BY side, feature, bucket),
p AS (SELECT feature, bucket, coalesce(max(CASE WHEN side = 'first' THEN share END), 0) AS f,
             coalesce(max(CASE WHEN side = 'second' THEN share END), 0) AS s FROM h GROUP BY ALL)
SELECT feature, bucket, round(f, 6) AS first_share, round(s, 6) AS second_share,
       round(CASE WHEN s > 0 THEN f / s END, 6) AS ratio FROM p""",
    "dedup_semantic": _semantic_sql("SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings"),
    "dedup_semantic_copies": _semantic_sql("""SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings UNION ALL
        SELECT -1 - vec_id, label, list_transform(embedding,
            lambda x, i: x::DOUBLE * (1 + ((vec_id * 31 + (i - 1) * 17) % 7 - 3) / 3 * (1 + vec_id % 2) * 0.25)) FROM embeddings"""),
    "sft_pairs": """SELECT conv_id, turn, context, prompt, response FROM (
        SELECT conv_id, turn, role, text AS prompt, lead(role) OVER w AS following, lead(text) OVER w AS response,
               coalesce(string_agg(role || ': ' || text, chr(10)) OVER (PARTITION BY conv_id ORDER BY turn
                        ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), '') AS context
        FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
        WHERE role = 'user' AND following = 'assistant'""",
    "preference_pairs": """WITH p AS (SELECT conv_id, arg_min(text, turn) AS asked FROM conversations WHERE role = 'user' GROUP BY conv_id),
a AS (SELECT conv_id || ': ' || asked AS prompt, text AS answer, length(text) AS score, 'turn ' || turn AS reason
      FROM conversations JOIN p USING (conv_id) WHERE role = 'assistant'),
r AS (SELECT prompt, max(score) - min(score) AS margin,
             first(answer ORDER BY score DESC, answer) AS chosen, first(answer ORDER BY score, answer) AS rejected,
             first(reason ORDER BY score DESC, answer, reason) AS chosen_reason, first(reason ORDER BY score, answer, reason) AS rejected_reason FROM a GROUP BY prompt)
SELECT * FROM r WHERE margin > 0 AND margin >= 10""",
}


ORACLES["perplexity_by_source"] = f"""SELECT source, count(*) AS documents, count(perplexity) AS scored, round(avg(perplexity), 4) AS mean,
       {", ".join(f"quantile_disc(perplexity, {q / 100}) AS p{q}" for q in (10, 25, 50, 75, 90))}
FROM ({ORACLES["ngram_perplexity"]}) JOIN documents USING (doc_id) GROUP BY source"""
_ASKED = " UNION ALL ".join(f"SELECT '{name}' AS query, {[w.lower() for w in words]} AS asked" for name, words in LOOKUPS.items())
ORACLES["word_lookup"] = rf"""SELECT DISTINCT query, doc_id
FROM (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '{_TOKENS}') AS w FROM documents), ({_ASKED})
WHERE list_has_all(w, asked)"""
_CLUSTERED = curation_queries.ORACLES["dedup_minhash"].replace("WITH RECURSIVE", "WITH RECURSIVE documents AS (SELECT *, NULL AS source FROM one),", 1)
ORACLES["pipeline_funnel_whole"] = rf"""WITH a AS (SELECT page_id AS doc_id, text FROM {_texts_sql(_ALLOWED)}),
mixed AS (SELECT -1 - doc_id AS doc_id, text, lang FROM documents UNION ALL SELECT doc_id, text, NULL FROM a),
p AS ({_on("mixed", ORACLES["language_id"])}),
spoken AS (SELECT a.* FROM a JOIN p USING (doc_id) WHERE predicted = '{LANGUAGE}'),
q AS ({_on("spoken", curation_queries.ORACLES["quality_filters"])}),
good AS (SELECT spoken.* FROM spoken JOIN q USING (doc_id) WHERE kept),
one AS (SELECT * FROM good QUALIFY row_number() OVER (
  PARTITION BY trim(regexp_replace(text, '[{_S}]+', ' ', 'g'), ' ') ORDER BY doc_id) = 1),
c AS ({_CLUSTERED}),
single AS (SELECT one.* FROM one JOIN c USING (doc_id) WHERE doc_id = cluster_id),
h AS ({_on("single", curation_queries.ORACLES["heuristic_filters"])}),
x AS ({_on("single", curation_queries.ORACLES["heuristic_score"])}),
z AS (SELECT single.*, len(regexp_extract_all(text, '{_TOKENS}')) AS n
      FROM single JOIN h USING (doc_id) JOIN x USING (doc_id) WHERE kept AND score >= 0.5)
SELECT '1 pages' AS stage, count(*) AS pages, 0 AS tokens FROM pages
UNION ALL SELECT '2 allowed hosts', count(*), 0 FROM a
UNION ALL SELECT '3 language', count(*), 0 FROM spoken
UNION ALL SELECT '4 quality', count(*), 0 FROM good
UNION ALL SELECT '5 exact copies', count(*), 0 FROM one
UNION ALL SELECT '6 near copies', count(*), 0 FROM single
UNION ALL SELECT '7 heuristics', count(*), 0 FROM h WHERE kept
UNION ALL SELECT '8 score', count(*), 0 FROM z
UNION ALL SELECT '9 tokenized', count(*), CAST(coalesce(sum(n), 0) AS BIGINT) FROM z WHERE n > 0"""
