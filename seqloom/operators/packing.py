"""Tokenize documents and pack each chunk's token stream into next-token sequences."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from seqloom.functions.numeric import ceil_div, int_div
from seqloom.functions.text import has_text
from seqloom.functions.tokenizers import PythonTokenizer, Tokenizer
from seqloom.operators.corpus import normalize_text
from seqloom.operators.ordered import BUCKET, RowOrder, Running, by_width, running
from seqloom.session import written

# Tokens joined in one group at most: large enough that most documents fall into one block, small
# enough that a block at a bucket border is little to shuffle.
BLOCK_TOKENS = 1 << 16


def tokenize_docs(df: DataFrame, tokenizer: Tokenizer, text_column: str = "text") -> DataFrame:
    """Add `tokens`, ids with the boundary id after every document, and `n_tok`."""
    return df.withColumn("tokens", _ids_with_end(tokenizer, text_column)).withColumn(
        "n_tok", F.size("tokens").cast("bigint")
    )


def _ids_with_end(tokenizer: Tokenizer, text_column: str) -> Column:
    return F.concat(tokenizer.encode(F.col(text_column)), F.array(F.lit(tokenizer.eos_token_id)))


@dataclass(frozen=True)
class CorpusIndex:
    """Where each row of a corpus belongs, without its text.

    `rows`: the source rows with clean text, their bucket of the order, and `n_tok`.
    `chunks`: one row per chunk: documents, source rows, tokens.
    `buckets`: one row per bucket: what lies in front of it, and the chunks it touches.
    """

    rows: DataFrame
    chunks: DataFrame
    buckets: DataFrame
    order: RowOrder
    tokenizer: Tokenizer
    text_column: str
    chunk_size: int
    first_chunk_id: int
    document_limit: int | None


def index_corpus(
    df: DataFrame,
    tokenizer: Tokenizer,
    chunk_size: int,
    text_column: str = "text",
    order: RowOrder | None = None,
    total_documents: int | None = None,
    documents_before: int = 0,
    first_chunk_id: int = 0,
    null_text: str = "drop",
) -> CorpusIndex:
    """Order, clean, cap and chunk a corpus by reading its texts once, for their lengths.

    Only order keys and lengths are shuffled and written. The texts themselves are read again, and
    shuffled once, by what uses the index. A Python tokenizer runs here, into a written table, as
    its lengths are known only from its ids.
    """
    if chunk_size <= 0:
        raise ValueError("chunk_size must be positive")
    order = order or by_width("row_idx")
    rows = normalize_text(df, text_column, null_text)
    rows = rows.withColumn("accepted", has_text(F.col(text_column)))
    if isinstance(tokenizer, PythonTokenizer):
        rows = written(tokenize_docs(rows, tokenizer, text_column), "tokens")
        length = F.col("n_tok")
    else:
        length = tokenizer.count(F.col(text_column)).cast("bigint") + F.lit(1)
    spent = F.when(F.col("accepted"), length).otherwise(F.lit(0)).cast("bigint")
    rows = order.add_bucket(rows.withColumn("n_tok", spent))

    keys = [f"__key{i}" for i in range(len(order.sort))]
    lengths = written(
        rows.select(
            BUCKET,
            "accepted",
            "n_tok",
            *[column.alias(key) for column, key in zip(order.sort, keys)],
        ),
        "lengths",
    )
    narrow = RowOrder(tuple(F.col(key) for key in keys), lambda frame: frame, order.max_buckets)
    placed = running(
        lengths,
        narrow,
        {
            "accepted_before": Running("sum", F.col("accepted").cast("bigint")),
            "tokens_before": Running("sum", F.col("n_tok")),
        },
    )
    limit = None
    if total_documents is not None:
        limit = max(total_documents - documents_before, 0)
        placed = placed.filter(F.col("accepted_before") < F.lit(limit))
    chunk = int_div(F.col("accepted_before"), chunk_size) + F.lit(first_chunk_id)
    parts = written(
        placed.groupBy(BUCKET, chunk.cast("bigint").alias("chunk_id")).agg(
            F.sum(F.col("accepted").cast("bigint")).alias("documents"),
            F.count("*").alias("source_rows"),
            F.min("accepted_before").alias("accepted_before"),
            F.min("tokens_before").alias("tokens_before"),
            F.sum("n_tok").alias("n_tok"),
        ),
        "chunk-parts",
    )
    chunks = (
        parts.groupBy("chunk_id")
        .agg(
            F.sum("documents").alias("documents"),
            F.sum("source_rows").alias("source_rows"),
            F.min("tokens_before").alias("chunk_start"),
            F.sum("n_tok").alias("chunk_tokens"),
        )
        .filter(F.col("documents") > 0)
    )
    # A bucket touches as many chunks as its documents fill.
    inside = F.struct("chunk_id", "chunk_start", "chunk_tokens")
    buckets = (
        parts.join(chunks.select("chunk_id", "chunk_start", "chunk_tokens"), "chunk_id")
        .groupBy(BUCKET)
        .agg(
            F.min("accepted_before").alias("__accepted"),
            F.min("tokens_before").alias("__tokens"),
            F.sum("n_tok").alias("__size"),
            F.array_sort(F.collect_list(inside)).alias("__chunks"),
        )
    )
    return CorpusIndex(
        rows, chunks, buckets, order, tokenizer, text_column, chunk_size, first_chunk_id, limit
    )


def chunk_documents(index: CorpusIndex) -> DataFrame:
    """The documents with `chunk_id`, `n_tok`, `tok_start`, `chunk_tokens` and `tokens`.

    The one shuffle of the texts: by bucket, so that neighbours in the order stay together. What
    lies in front of a bucket, and its chunks, come from the index by the same key. Expression
    tokenizers run after the shuffle: text travels, not its ids. `bucket_low` and `bucket_high`
    bound the bucket's token positions inside the chunk.
    """
    here = W.partitionBy(BUCKET).orderBy(*index.order.sort)
    earlier = here.rowsBetween(W.unboundedPreceding, -1)

    def so_far(column: Column, carry: str) -> Column:
        return F.col(carry) + F.coalesce(column, F.lit(0))

    counted = index.rows.withColumns(
        {
            "__documents": F.sum(F.col("accepted").cast("bigint")).over(earlier),
            "__positions": F.sum("n_tok").over(earlier),
        }
    )
    joined = counted.filter("accepted").join(index.buckets, BUCKET)
    accepted = so_far(F.col("__documents"), "__accepted")
    if index.document_limit is not None:
        joined = joined.filter(accepted < F.lit(index.document_limit))
    chunk = int_div(accepted, index.chunk_size) + F.lit(index.first_chunk_id)
    # Chunk ids are dense inside a bucket, so that the position in the list is known.
    offset = F.col("chunk_id") - F.col("__chunks")[0]["chunk_id"]
    found = F.element_at("__chunks", (offset + 1).cast("int"))
    docs = (
        joined.withColumn("chunk_id", chunk.cast("bigint"))
        .withColumns(
            {"chunk_tokens": found["chunk_tokens"], "__start": found["chunk_start"]}
        )
        .withColumns(
            {
                "tok_start": so_far(F.col("__positions"), "__tokens") - F.col("__start"),
                "bucket_low": F.greatest(F.col("__tokens") - F.col("__start"), F.lit(0)),
                "bucket_high": F.least(
                    F.col("__tokens") + F.col("__size") - F.col("__start"), F.col("chunk_tokens")
                ),
            }
        )
        .drop(
            "__documents", "__positions", "__accepted", "__tokens", "__size", "__chunks", "__start",
            "__order_hash",
            "accepted",
        )
    )
    if "tokens" in docs.columns:
        return docs
    return docs.withColumn("tokens", _ids_with_end(index.tokenizer, index.text_column))


def token_offsets(docs: DataFrame, order: RowOrder | None = None) -> DataFrame:
    """Add `tok_start` and `chunk_tokens` to any documents with `chunk_id`, `row_idx`, `n_tok`."""
    return running(
        docs,
        order or by_width("row_idx"),
        {"tok_start": Running("sum", F.col("n_tok"))},
        keys=["chunk_id"],
        group_totals={"chunk_tokens": "tok_start"},
    )


def sequence_counts(chunks: DataFrame, context_length: int) -> DataFrame:
    """Sequences of each chunk from its `chunk_tokens`; fewer than two tokens are an error."""
    _check_context(context_length)
    enough = F.when(
        F.col("chunk_tokens") < 2, F.raise_error(F.lit("a chunk needs two tokens or more"))
    ).otherwise(ceil_div(F.col("chunk_tokens") - 1, context_length))
    return chunks.select("chunk_id", "chunk_tokens", enough.cast("bigint").alias("sequences"))


def pack_windows(docs: DataFrame, context_length: int) -> DataFrame:
    """Cut the token stream of each chunk into windows (chunk_id, seq_id, tokens).

    Window s holds the tokens [s*L, s*L + L + 1), cut at the end of the chunk: stride L, one token
    shared with the next window. Documents are first joined into blocks of many windows, of at most
    BLOCK_TOKENS or one window, which bounds every group; a block is then sliced.

    A block whose tokens all lie in one bucket is joined where the bucket is, without a shuffle.
    Only the blocks across bucket borders travel. Without bucket columns all blocks do.
    """
    _check_context(context_length)
    windows = max(1, BLOCK_TOKENS // context_length)
    block_length = windows * context_length
    start = F.col("tok_start")
    end = start + F.col("n_tok")
    total = F.col("chunk_tokens")
    first = int_div(F.greatest(start - 1, F.lit(0)), block_length)
    last = F.least(int_div(end - 1, block_length), int_div(total - 2, block_length))
    checked_last = F.when(
        total < 2, F.raise_error(F.lit("a chunk needs two tokens or more")).cast("bigint")
    ).otherwise(last)

    def low(block: Column) -> Column:
        return block * F.lit(block_length)

    def high(block: Column) -> Column:
        return F.least(block * F.lit(block_length) + F.lit(block_length + 1), total)

    # Slices are taken in the projection behind an explode, which runs as generated code on
    # primitive arrays; inside a lambda each id would become an object.
    def joined(rows: DataFrame, keys: list[str], blocks: Column) -> DataFrame:
        block = F.col("block")
        from_ = F.greatest(start, low(block))
        size = F.least(end, high(block)) - from_
        piece = F.slice(F.col("tokens"), (from_ - start + 1).cast("int"), size.cast("int"))
        return (
            rows.withColumn("block", F.explode(blocks))
            .select(*keys, "block", from_.alias("low"), piece.alias("part"))
            .groupBy(*keys, "block")
            .agg(F.array_sort(F.collect_list(F.struct("low", "part"))).alias("parts"))
            .select("chunk_id", "block", F.flatten(F.col("parts.part")).alias("tokens"))
        )

    touched = F.sequence(first, checked_last)
    if BUCKET in docs.columns:

        def inside(block: Column) -> Column:
            return (low(block) >= F.col("bucket_low")) & (high(block) <= F.col("bucket_high"))

        at_border = ~(inside(first) & inside(last))
        blocks = joined(docs, [BUCKET, "chunk_id"], F.filter(touched, inside)).unionByName(
            joined(docs.filter(at_border), ["chunk_id"], F.filter(touched, lambda b: ~inside(b)))
        )
    else:
        blocks = joined(docs, ["chunk_id"], touched)

    count = ceil_div(F.size("tokens") - 1, context_length)
    first_token = (F.col("__window") * F.lit(context_length) + 1).cast("int")
    return blocks.withColumn(
        "__window", F.explode(F.sequence(F.lit(0).cast("bigint"), count - 1))
    ).select(
        "chunk_id",
        (F.col("block") * F.lit(windows) + F.col("__window")).alias("seq_id"),
        F.slice(F.col("tokens"), first_token, F.lit(context_length + 1)).alias("tokens"),
    )


def shift_labels(windows: DataFrame) -> DataFrame:
    """Inputs are all tokens but the last, labels all but the first."""
    size = F.size("tokens") - 1
    return windows.select(
        *[c for c in windows.columns if c != "tokens"],
        F.slice("tokens", F.lit(1), size).alias("input_ids"),
        F.slice("tokens", F.lit(2), size).alias("labels"),
    )


def pack_sequences(docs: DataFrame, context_length: int) -> DataFrame:
    """(chunk_id, seq_id, input_ids, labels) of every chunk."""
    return shift_labels(pack_windows(docs, context_length))


def _check_context(context_length: int) -> None:
    if context_length <= 0:
        raise ValueError("context_length must be positive")
