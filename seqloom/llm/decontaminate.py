"""Operator 7, benchmark decontamination: a prefix-filtered set join with exact verification.

An item is the set of its windows: ten consecutive words, or the whole item if it is shorter. Words
(shingles of one word, so that even one-word items have some) are ordered by their frequency in all
documents. Full containment of a window needs all its words, hence its rarest one: the necessary
prefix is that single word. Documents meet windows on it, the place of the word inside the window
fixes the only start possible, starts that do not fit the document are dropped, and what is left is
compared word by word with the text.

Word counts cover all documents, for the words of the benchmark, and are combined before their
shuffle. The prefix table follows the benchmark, never the documents. If its measured size is within
`broadcast_bytes`, it is broadcast: a text is cut into words once, its words meet the prefixes, and
start, bounds and words are checked while the text is still at hand, so that only true hits are
shuffled, and no text is. Beyond that size words meet prefixes by shuffle, where adaptive execution
splits frequent words, and texts are shuffled once, for the comparison.

Defined results: null has no words; items without words match nothing; equal windows of several
items count for each; rows repeated under one key give repeated results; null keys are kept.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.llm.common import narrow, table
from seqloom.llm.quality_rules import let
from seqloom.session import written

#: Fixed value: word characters are ASCII digits and lower-case letters, and all beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Characters beyond ASCII that lower-casing changes.
OTHER_UPPER = r"[\x{80}-\x{10FFFF}&&[\p{IsUppercase}\p{Lt}]]"
WINDOW = 10
BROADCAST_BYTES = 32 << 20


def words_of(text: Column) -> Column:
    """Words with A to Z in lower case; `lower` does that, fast, where no other letter has an upper case."""
    text = F.coalesce(text, F.lit(""))
    plain = (F.octet_length(text) == F.length(text)) | ~text.rlike(OTHER_UPPER)
    low = F.when(plain, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(0))


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """(item_id, phrase, width): each different window of each item, words joined by a space."""
    words = items.select(F.col(id_col).alias("item_id"), words_of(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    width = F.least(F.size("w"), F.lit(size))
    start = F.explode(F.sequence(F.lit(1), F.size("w") - width + 1)).alias("start")
    return (
        words.select("item_id", "w", width.alias("width"), start)
        .select("item_id", F.array_join(F.slice("w", F.col("start"), F.col("width")), " ").alias("phrase"), "width")
        .distinct()
    )


def prefix_tokens(windows: DataFrame, docs: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(phrase, width, word, place): the word of each window that is rarest in the documents."""
    placed = windows.select("phrase", "width").distinct().select(
        "phrase", "width", F.posexplode(F.split("phrase", " ")).alias("place", "word")
    )
    known = small(placed.select("word").distinct(), broadcast_bytes, "word")
    words = docs.select(F.explode(words_of(F.col("text"))).alias("word"))
    counts = words.join(known, "word", "left_semi").groupBy("word").agg(F.count("*").alias("n"))
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "place")).alias("r")
    return (
        placed.join(counts, "word", "left")
        .groupBy("phrase", "width")
        .agg(rarest)
        .where("r.n > 0")  # a window with a word that no document has is nowhere
        .select("phrase", "width", "r.word", "r.place")
    )


def fits(df: DataFrame, limit: int, *text_cols: str) -> bool:
    """Whether the rows, measured now, take at most `limit` bytes."""
    width = F.lit(64)
    for name in text_cols:
        width = width + F.octet_length(name)
    return (df.agg(F.sum(width)).first()[0] or 0) <= limit


def small(df: DataFrame, limit: int, *text_cols: str) -> DataFrame:
    """Marked for broadcast if it fits."""
    return F.broadcast(df) if fits(df, limit, *text_cols) else df


def _hits_at_hand(docs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The columns of `docs` but the text, n_words, and start, width and phrase: a row for each window
    in a text, and one without a phrase for each text."""
    base = docs.sparkSession.range(1).select(
        F.lit("").alias("word"), F.lit(0).alias("place"), F.lit(0).alias("width"), F.lit(None).cast("string").alias("phrase")
    )
    known = prefixes.select("word", F.col("place").cast("int").alias("place"), F.col("width").cast("int").alias("width"), "phrase")
    kept = [c for c in docs.columns if c != "text"]
    words = docs.select(*kept, words_of(F.col("text")).alias("w"))
    placed = words.select(*kept, "w", F.posexplode(F.concat(F.array(F.lit("")), "w")).alias("at", "word"))
    start = F.col("at") - 1 - F.col("place")
    same = F.array_join(F.slice("w", start + 1, F.col("width")), " ") == F.col("phrase")
    inside = (start >= 0) & (start + F.col("width") <= F.size("w"))
    return (
        placed.join(F.broadcast(known.union(base)), "word")
        .where(F.when(F.col("at") == 0, True).when(inside, same).otherwise(False))
        .select(*kept, F.size("w").cast("long").alias("n_words"), start.alias("start"), "width", "phrase")
    )


def _with_items(hits: DataFrame, windows: DataFrame, broadcast_bytes: int) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items from a row for each text: row, doc_id, n_words, n_hit, phrases."""
    owners = small(windows, broadcast_bytes, "phrase").select("phrase", "item_id")
    return (
        hits.select("row", "doc_id", "n_words", "n_hit", F.explode_outer("phrases").alias("phrase"))
        .join(owners, "phrase", "left")
        .groupBy("row")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_words").alias("n_words"),
            F.first("n_hit").alias("n_hit"),
            F.array_sort(F.transform(F.collect_set("item_id"), lambda i: i.cast("string"))).alias("ids"),
        )
        .select("doc_id", "n_words", "n_hit", F.size("ids").cast("long").alias("n_items"), F.array_join("ids", ",").alias("items"))
    )


def _covered(hits: Column) -> Column:
    """How many places the windows (start, width) of a text cover."""
    return F.size(
        F.array_distinct(F.flatten(F.transform(hits, lambda c: F.sequence(c["start"], c["start"] + c["width"] - 1))))
    ).cast("long")


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = WINDOW,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (their ids as text, sorted, comma-joined)."""
    slim = narrow(docs, id_col, text_col)
    windows = written(item_windows(items, item_col, item_text_col, size), "item-windows")
    prefixes = written(prefix_tokens(windows, slim, broadcast_bytes), "prefix-tokens")
    if fits(prefixes, broadcast_bytes, "phrase", "word"):
        hits = _hits_at_hand(slim.withColumn("row", F.monotonically_increasing_id()), prefixes)
        hit = F.when(F.col("phrase").isNotNull(), F.struct("start", "width", "phrase"))
        each = hits.groupBy("row").agg(
            F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.collect_list(hit).alias("hits")
        )
        phrases = F.array_distinct(F.transform("hits", lambda c: c["phrase"])).alias("phrases")
        found = each.select("row", "doc_id", "n_words", _covered(F.col("hits")).alias("n_hit"), phrases)
    else:
        found = _hits_by_shuffle(slim, prefixes)
    return _with_items(found, windows, broadcast_bytes)


def _hits_by_shuffle(docs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """row, doc_id, n_words, n_hit and phrases of each text, for prefixes of any size."""
    keyed = docs.withColumn("h", F.xxhash64("text"))
    words = keyed.select("doc_id", "h", words_of(F.col("text")).alias("w"))
    placed = words.select("doc_id", "h", F.size("w").alias("n"), F.posexplode("w").alias("at", "word"))
    start = F.col("at") - F.col("place")
    candidates = (
        placed.join(prefixes, "word")
        .where((start >= 0) & (start + F.col("width") <= F.col("n")))
        .groupBy("doc_id", "h")
        .agg(F.collect_set(F.struct(start.alias("start"), "width", "phrase")).alias("found"))
        .select(F.col("doc_id").alias("found_id"), F.col("h").alias("found_h"), "found")
    )
    same = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("h") == F.col("found_h"))

    def verified(w: Column) -> Column:
        hits = F.filter(
            F.coalesce("found", F.array().cast("array<struct<start:int,width:int,phrase:string>>")),
            lambda c: F.array_join(F.slice(w, c["start"] + 1, c["width"]), " ") == c["phrase"],
        )
        return let(
            hits,
            lambda h: F.struct(
                F.size(w).cast("long").alias("n_words"),
                _covered(h).alias("n_hit"),
                F.array_distinct(F.transform(h, lambda c: c["phrase"])).alias("phrases"),
            ),
        )

    return (
        keyed.join(candidates, same, "left")
        .select("doc_id", let(words_of(F.col("text")), verified).alias("v"))
        .select(F.monotonically_increasing_id().alias("row"), "doc_id", "v.*")
    )


def keep_clean(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = WINDOW,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The rows of `docs`, with all their columns, whose text has no window of an item.

    Equal texts have one fate, so the texts to drop are named by two hashes of 64 bits; rows meet
    them where they are, by broadcast, as long as the names' measured size allows it.
    """
    marks = [F.xxhash64(F.col(text_col)), F.xxhash64(F.lit(1), F.col(text_col))]
    named = narrow(docs, marks[0], text_col).withColumn("second", F.xxhash64(F.lit(1), "text"))
    windows = written(item_windows(items, item_col, item_text_col, size), "item-windows")
    prefixes = written(prefix_tokens(windows, named.select("text"), broadcast_bytes), "prefix-tokens")
    if fits(prefixes, broadcast_bytes, "phrase", "word"):
        hits = _hits_at_hand(named, prefixes).where("phrase IS NOT NULL").select("doc_id", "second")
    else:
        both = named.select(F.struct("doc_id", "second").alias("doc_id"), "text")
        hits = _hits_by_shuffle(both, prefixes).where("n_hit > 0").select("doc_id.*")
    dropped = written(hits.distinct(), "contaminated").select(F.col("doc_id").alias("m0"), F.col("second").alias("m1"))
    same = (marks[0] == dropped["m0"]) & (marks[1] == dropped["m1"])
    return docs.join(small(dropped, broadcast_bytes), same, "left_anti")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2("items", 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


ORACLE = rf"""
WITH b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'), '{WORD}') AS w
  FROM benchmark
), d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'), '{WORD}') AS w
  FROM documents
), windows AS (
  SELECT DISTINCT item_id, width, array_to_string(w[i + 1:i + width], ' ') AS p
  FROM (SELECT item_id, w, least(len(w), {WINDOW}) AS width, unnest(range(0, len(w) - least(len(w), {WINDOW}) + 1)) AS i
        FROM b WHERE len(w) > 0)
), places AS (
  SELECT doc_id, i, width, array_to_string(w[i + 1:i + width], ' ') AS p
  FROM (SELECT doc_id, w, width, unnest(range(0, len(w) - width + 1)) AS i
        FROM d, (SELECT DISTINCT width FROM windows))
), hits AS (
  SELECT DISTINCT doc_id, i, width, p FROM places SEMI JOIN windows USING (width, p)
), covered AS (
  SELECT doc_id, count(DISTINCT spot) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + width)) AS spot FROM hits) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits JOIN windows USING (width, p)) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)"""
