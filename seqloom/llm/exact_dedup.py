"""Operator 13, exact deduplication by progressive refinement.

Texts are told apart by keys that get dearer: their length, a hash of their first characters, the
digest of the whole text. A level counts the keys of the rows that the level before could not tell
apart, and only keys that several rows share go on. The digest is computed for their rows alone, and
only those rows, without their texts, are shuffled by it.

What a level leaves is known to the next scan as a bit field: each shared key sets the bit of its
hash. The field has at most 2**FILTER_BITS bits, whatever the corpus, so it is always broadcast, and
texts are never shuffled to learn whether they go on. A bit that two keys share only has a text
digested that need not be; the last level alone decides, by length and SHA-256. Beyond some ten
million shared keys most bits are set and most texts are digested: that costs a hash per text, still
no shuffle of texts.

`docs` is scanned once per level; write it first if it is costly to compute. Counts are combined
before their shuffle; the join with the groups has one row per digest on its other side, so adaptive
execution can split a group of any size.

Equal means identical after lower-casing A to Z only. Defined results: null counts as the empty text,
and all empty texts are one group; the largest key of a group stays, null keys being the smallest;
of rows repeated under that key exactly one stays, any of them (`kept`), and every row has a result; an
empty table gives an empty table; other columns are never looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.llm.bit_fields import asked, bits_of
from seqloom.llm.common import lowered, table
from seqloom.session import written

#: Characters of a text that the second level hashes.
PREFIX = 64
#: Bits of the field that tells a scan which keys are shared: 2**24 bits are 2**18 rows at most.
FILTER_BITS = 24


def _shared_bits(keys: DataFrame, bits: int) -> DataFrame:
    """(word, field): the bits of the hashes (`key`) that several rows have, in words of 64."""
    return bits_of(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), bits)


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Mapping[str, Column] | None = None,
    prefix: int = PREFIX,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """doc_id, keep_id (the key of the row that stays), group_size, kept, for every row of `docs`.

    `carry` names expressions over the columns of `docs` whose values are kept beside the result.
    """
    carry = dict(carry or {})
    slim = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.struct(*(column.alias(name) for name, column in carry.items()), F.lit(0).alias("_")).alias("carry"),
    ).withColumn("size", F.octet_length("text").cast("long"))

    by_size = F.xxhash64("size")
    by_prefix = F.when(F.col("go"), F.xxhash64("size", lowered(F.substring("text", 1, prefix))))
    sizes = written(_shared_bits(slim.select(by_size.alias("key")), filter_bits), "shared-sizes")
    same_size = asked(slim, by_size, sizes, filter_bits)
    prefixes = _shared_bits(same_size.select(by_prefix.alias("key")).where("key IS NOT NULL"), filter_bits)
    prefixes = written(prefixes, "shared-prefixes")
    same_prefix = asked(same_size, by_prefix, prefixes, filter_bits)

    digest = F.when(F.col("go"), F.unhex(F.sha2(lowered(F.col("text")), 256)))
    rows = written(
        same_prefix.select(F.monotonically_increasing_id().alias("row"), "doc_id", "size", digest.alias("digest"), "carry"),
        "refined",
    )
    last = F.coalesce(F.max_by("row", "doc_id"), F.min("row")).alias("keep_row")
    groups = rows.where("digest IS NOT NULL").groupBy("size", "digest")
    groups = groups.agg(F.count("*").alias("n"), F.max("doc_id").alias("keep_id"), last).where("n > 1")
    groups = written(groups, "groups")  # read back, so that the join below is dealt anew and a large group is split
    told_apart = rows.where("digest IS NULL").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "carry"
    )
    grouped = (
        rows.where("digest IS NOT NULL")
        .join(groups, ["size", "digest"], "left")
        .select(
            "doc_id",
            F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("n", F.lit(1)).alias("group_size"),
            F.coalesce(F.col("row") == F.col("keep_row"), F.lit(True)).alias("kept"),
            "carry",
        )
    )
    found = told_apart.unionByName(grouped)
    return found.select("doc_id", "keep_id", "group_size", "kept", *(F.col(f"carry.`{name}`") for name in carry))


def keep_last(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs` that stay, with all their columns."""
    rows = exact_groups(docs, id_col, text_col, {"whole": F.struct(*(F.col(f"`{c}`") for c in docs.columns))}, **options)
    return rows.where("kept").select("whole.*")


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.sha2(lowered(F.coalesce("text", F.lit(""))), 256)
    return exact_groups(table(spark, sf_dir, "documents"), carry={"text_sha256": whole})


ORACLE = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM d WINDOW same AS (PARTITION BY text_sha256)"""
