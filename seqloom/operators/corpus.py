"""Order, shuffle, skip, clean, cap and chunk a corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.functions.hashing import seeded_hash
from seqloom.functions.numeric import int_div
from seqloom.functions.text import has_text, normalized_text
from seqloom.operators.ordered import (
    RowOrder,
    Running,
    by_hash,
    by_width,
    hash_rank,
    ordinal,
    running,
)
from seqloom.sources.corpus import require_text_column


def row_ordinal(df: DataFrame, order: RowOrder) -> DataFrame:
    """Add `row_idx`, the position of each source row."""
    return ordinal(df, order, "row_idx")


def shuffle_full(df: DataFrame, seed: int, key: str) -> DataFrame:
    """A reproducible permutation of the whole table; `row_idx` is the new position."""
    return ordinal(df, by_hash(df, seed, key), "row_idx")


def shuffle_buffered(df: DataFrame, seed: int, key: str, buffer_size: int) -> DataFrame:
    """Shuffle within consecutive blocks of `buffer_size` rows; needs and replaces `row_idx`.

    A row moves less than one block. `buffer_size=0` leaves the order alone.
    """
    if buffer_size < 0:
        raise ValueError("buffer_size must not be negative")
    if buffer_size == 0:
        return df
    blocks = df.withColumn("__block", int_div(F.col("row_idx"), buffer_size))
    ranked = hash_rank(
        blocks, ["__block"], seeded_hash(seed, F.col(key)), key, F.lit(buffer_size), "__rank"
    )
    moved = (F.col("__block") * F.lit(buffer_size) + F.col("__rank")).cast("bigint")
    return ranked.withColumn("row_idx", moved).drop("__block", "__rank")


def skip_rows(df: DataFrame, count: int) -> DataFrame:
    """Drop the first `count` positions. Pushed into the scan where `row_idx` is stored."""
    return df if count <= 0 else df.filter(F.col("row_idx") >= F.lit(count))


def normalize_text(df: DataFrame, text_column: str = "text", null_text: str = "drop") -> DataFrame:
    require_text_column(df, text_column)
    return df.withColumn(text_column, normalized_text(F.col(text_column), null_text))


def nonempty_docs(df: DataFrame, text_column: str = "text", null_text: str = "drop") -> DataFrame:
    clean = normalize_text(df, text_column, null_text)
    return clean.filter(has_text(F.col(text_column)))


def assign_chunks(
    df: DataFrame,
    chunk_size: int,
    text_column: str = "text",
    order: RowOrder | None = None,
    total_documents: int | None = None,
    documents_before: int = 0,
    first_chunk_id: int = 0,
    null_text: str = "drop",
) -> DataFrame:
    """Number source rows by chunk, at most `chunk_size` documents each.

    Adds `accepted` (has text), `accepted_before` (documents in front of this row) and `chunk_id`.
    A blank row after the last document of a full chunk belongs to the next chunk. With
    `total_documents`, rows past the last wanted document are not read; `documents_before` counts
    those of earlier runs against that cap. The order defaults to `row_idx`.
    """
    if chunk_size <= 0:
        raise ValueError("chunk_size must be positive")
    clean = normalize_text(df, text_column, null_text)
    flagged = clean.withColumn("accepted", has_text(F.col(text_column)))
    counted = running(
        flagged,
        order or by_width("row_idx"),
        {"accepted_before": Running("sum", F.col("accepted").cast("bigint"))},
    )
    if total_documents is not None:
        counted = counted.filter(
            F.col("accepted_before") < F.lit(max(total_documents - documents_before, 0))
        )
    chunk = int_div(F.col("accepted_before"), chunk_size) + F.lit(first_chunk_id)
    return counted.withColumn("chunk_id", chunk.cast("bigint"))


def cap_documents(
    df: DataFrame, total_documents: int, text_column: str = "text", order: RowOrder | None = None
) -> DataFrame:
    """The first `total_documents` documents that have text."""
    counted = assign_chunks(df, total_documents, text_column, order, total_documents)
    return counted.filter("accepted").drop("accepted", "accepted_before", "chunk_id")


def chunk_manifest(chunked: DataFrame) -> DataFrame:
    """Documents and source rows of each chunk; a trailing chunk without documents is left out."""
    return (
        chunked.groupBy("chunk_id")
        .agg(
            F.sum(F.col("accepted").cast("bigint")).alias("documents"),
            F.count("*").alias("source_rows"),
        )
        .filter(F.col("documents") > 0)
    )
