"""Vocabulary, word index and perplexity of a corpus, by joins on counts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seqloom.operators.bigrams import log_chances

#: The special tokens in the order of their ids.
SPECIALS = ("<pad>", "<bos>", "<eos>", "<unk>")
UNKNOWN = 3
_TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]"


def tokens_of(text: Column) -> Column:
    """Runs of letters and digits, and every other visible character by itself."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_TOKEN), F.lit(0))


def build_vocab(docs: DataFrame, text: str = "text", min_count: int = 2, max_size: int = 10_000) -> DataFrame:
    """(id, token, count): specials first, then the commonest tokens by (count, token).

    Only the `max_size` rows that are left are numbered by a window of one partition.
    """
    counts = docs.select(F.explode(tokens_of(F.col(text))).alias("token")).groupBy("token").agg(F.count("*").alias("count"))
    room = max_size - len(SPECIALS)
    top = counts.where(F.col("count") >= min_count).orderBy(F.desc("count"), "token").limit(room)
    place = F.row_number().over(W.orderBy(F.desc("count"), "token")) + len(SPECIALS) - 1
    special = docs.sparkSession.createDataFrame([(n, t, 0) for n, t in enumerate(SPECIALS)], "id long, token string, count long")
    return special.unionByName(top.select(place.cast("bigint").alias("id"), "token", "count"))


def encode_vocab(docs: DataFrame, vocab: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and `ids`: the id of every token, the unknown id where it has none.

    The vocabulary has at most the size it was built with; whether it is broadcast is left to its
    measured size. Each different token of a document is looked up once.
    """
    placed = docs.select(key, F.posexplode(tokens_of(F.col(text))).alias("at", "token"))
    known = placed.join(vocab.select("token", "id"), "token", "left")
    ids = _in_place(known.withColumn("id", F.coalesce("id", F.lit(UNKNOWN))), key, "id").select(key, F.col("p.id").alias("ids"))
    return docs.select(key).join(ids, key, "left").select(key, F.coalesce("ids", F.array().cast("array<bigint>")).alias("ids"))


def decode_vocab(encoded: DataFrame, vocab: DataFrame, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key and `text`: the tokens of the ids, separated by spaces."""
    placed = encoded.select(key, F.posexplode(ids).alias("at", "id"))
    words = _in_place(placed.join(vocab.select("id", "token"), "id").where("token is not null"), key, "token")
    return encoded.select(key).join(words.select(key, F.array_join("p.token", " ").alias("text")), key, "left").select(
        key, F.coalesce("text", F.lit("")).alias("text")
    )


def _in_place(rows: DataFrame, key: str, value: str) -> DataFrame:
    """key and `p`: the places (`at`) of a key with their `value`, in order. Neither is null.

    Two flat lists travel, in one order; a list of structs takes more than twice their bytes.
    """
    lists = rows.groupBy(key).agg(F.collect_list("at").alias("at"), F.collect_list(value).alias(value))
    return lists.select(key, F.array_sort(F.arrays_zip("at", value)).alias("p"))


def word_index(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4096) -> DataFrame:
    """(word, shard, documents, postings): the keys that hold a word, in shards of `width` consecutive keys.

    A shard bounds the list, so that a word of every document is many rows and not one.
    """
    words = docs.select(key, F.explode(F.array_distinct(tokens_of(F.lower(text)))).alias("word"))
    shard = F.floor(F.col(key) / width).cast("bigint").alias("shard")
    return words.groupBy("word", shard).agg(
        F.count("*").alias("documents"), F.sort_array(F.collect_list(key)).alias("postings")
    )


def write_word_index(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", width: int = 4096, buckets: int = 64
) -> None:
    """Writes the word index of `docs` to a new folder: what `word_lookup` reads.

    Rows are (word, shard, base, documents, offsets): a posting is its key less `base`, the lowest key
    of the shard, so that Parquet's dictionaries pack it into the bits of `width`. Folders are hash
    buckets of the words; inside one the rows lie by word. A frequent word's shards are spread over
    many tasks and files. Keys are integers; rows without a key are in no posting; rows that share a
    key count as one document; null and blank texts have no words; a table without words gives a
    folder without an index, in which nothing is found.
    """
    if not 0 < width <= 1 << 15 or buckets < 1:
        raise ValueError("width must be between 1 and 32768, buckets at least 1")
    index = word_index(docs.select(F.col(key).cast("bigint").alias("k"), F.col(text).alias("t")).where("k is not null"), "k", "t", width)
    base = F.col("shard") * F.lit(width)
    offsets = F.transform(F.array_distinct("postings"), lambda k: (k - base).cast("smallint"))
    rows = index.select("word", "shard", base.alias("base"), F.size(offsets).alias("documents"), offsets.alias("offsets"))
    rows = rows.withColumns({"buckets": F.lit(buckets), "bucket": _word_bucket(F.col("word"), F.lit(buckets))})
    sort = ["bucket", "word", "shard"]
    rows.repartitionByRange(*sort).sortWithinPartitions(*sort).write.partitionBy("buckets", "bucket").parquet(path)


def _word_bucket(word: Column, buckets: Column) -> Column:
    return F.pmod(F.xxhash64(word), buckets).cast("int")


_INDEX = "word string, shard bigint, base bigint, documents int, offsets array<smallint>, buckets int, bucket int"


def word_lookup(spark: SparkSession, path: str, queries: Mapping[str, Iterable[str]], key: str = "doc_id") -> DataFrame:
    """(query, key): the documents that hold every word of a query, each a complete word.

    Reads the buckets of the asked words only, and in them the row groups that hold one. Postings
    meet by query and shard, so that a task intersects at most `width` keys of each word; no text
    is read. Upper and lower case are the same. A word that the index does not hold, or that is
    no single token, is in no document; a query without words finds nothing.
    """
    asked = sorted({(name, word.lower()) for name, words in queries.items() for word in words})
    rows = spark.read.schema(_INDEX).parquet(path)
    words = sorted({word for _, word in asked})
    here = F.lit(False)
    for word in words:
        here = here | (F.col("bucket") == _word_bucket(F.lit(word), F.col("buckets")))
    found = rows.where(here & F.col("word").isin(words)).select("word", "shard", "base", "offsets")
    sizes = {name: sum(n == name for n, _ in asked) for name, _ in asked}
    wanted = spark.createDataFrame([(n, w, sizes[n]) for n, w in asked], "query string, word string, words int")
    # The asked words are the caller's own list, already in the driver.
    met = found.join(F.broadcast(wanted), "word").groupBy("query", "shard", "base", "words").agg(F.collect_list("offsets").alias("lists"))
    common = F.aggregate(
        F.slice("lists", 2, F.size("lists")), F.get("lists", F.lit(0)), lambda left, right: F.array_intersect(left, right)
    )
    hits = met.where(F.size("lists") == F.col("words")).select("query", "base", F.explode(common).alias("offset"))
    return hits.select("query", (F.col("base") + F.col("offset")).alias(key))


def ngram_perplexity(base: DataFrame, docs: DataFrame, key: str = "doc_id", text: str = "text", extra: float = 0.1) -> DataFrame:
    """key, `tokens` and `perplexity` under a smoothed bigram model of all texts of `base`.

    p(word | before) = (count(before word) + extra) / (count(before) + extra * V), V the different
    words of the base and one more; a text starts behind an empty word. Blocks of documents ask for the
    counts of their different bigrams, so that only those travel.
    """
    words = tokens_of(F.lower(text))
    size = base.select(F.explode(words).alias("word")).distinct().count() + 1
    found = log_chances(base, docs, words, size, extra, key, text)
    return found.groupBy(key).agg(F.sum("tokens").alias("tokens"), F.exp(-F.sum("log") / F.sum("tokens")).alias("perplexity"))


def perplexity_distribution(
    scored: DataFrame,
    by: str,
    value: str = "perplexity",
    quantiles: tuple[float, ...] = (0.1, 0.25, 0.5, 0.75, 0.9),
    accuracy: int = 10_000,
) -> DataFrame:
    """`by`, documents, scored, mean and the quantiles (`p10`, ...) of `value` in each group.

    Quantiles come from sketches that merge before the shuffle, so that a group with most of the rows
    is summed up in its tasks. A quantile is a value of the group whose rank is off by at most
    rows / accuracy: exact in groups of fewer rows than that. Null values are counted in documents
    only; null groups are kept; an empty table gives an empty table.
    """
    names = [f"p{round(q * 100)}" for q in quantiles]
    found = scored.groupBy(by).agg(
        F.count("*").alias("documents"),
        F.count(value).alias("scored"),
        F.avg(value).alias("mean"),
        F.percentile_approx(value, list(quantiles), accuracy).alias("q"),
    )
    return found.select(by, "documents", "scored", "mean", *(F.col("q")[n].alias(name) for n, name in enumerate(names)))
