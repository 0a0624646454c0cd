"""Batches of sequences: assignment, padding, masks, counts and step numbers.

Assignment needs only the sequence counts of the chunks, a narrow table; token arrays join it once,
at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from seqloom.functions.hashing import seeded_hash
from seqloom.functions.numeric import ceil_div, int_div
from seqloom.operators.ordered import Running, by_width, hash_rank, running
from seqloom.operators.packing import shift_labels

# Fixed value: the label that marks a padded position.
IGNORED_LABEL = -100
# Elements of one generated array at most.
STRETCH = 1 << 16


def _numbered(df: DataFrame, count: Column, name: str) -> DataFrame:
    """One row per number in [0, count), in stretches, so that no array grows with a hot chunk."""
    top = F.col("__count") - 1
    stretch_end = F.least(F.col("__from") + F.lit(STRETCH - 1), top)
    return (
        df.withColumn("__count", count)
        .filter(F.col("__count") > 0)
        .withColumn("__from", F.explode(F.sequence(F.lit(0).cast("bigint"), top, F.lit(STRETCH).cast("bigint"))))
        .repartition(*[F.col(c) for c in df.columns], F.col("__from"))
        .withColumn(name, F.explode(F.sequence(F.col("__from"), stretch_end)))
        .drop("__count", "__from")
    )


def assign_batches(
    counts: DataFrame,
    context_length: int,
    batch_size: int,
    epochs: int = 1,
    seed: int = 42,
    shuffle: bool = True,
) -> DataFrame:
    """One row per chunk, epoch (0-based) and sequence, with its batch.

    Reshuffled by hash on each pass; the short last batch is kept. `n_tokens` is the length of the
    sequence and `batch_len` the longest of its batch: every sequence but a chunk's last is full,
    so that a batch of two or more always holds a full one.
    """
    if batch_size <= 0 or epochs <= 0:
        raise ValueError("batch_size and epochs must be positive")
    rows = _numbered(
        counts.select("chunk_id", "chunk_tokens", "sequences"), F.col("sequences"), "seq_id"
    )
    rows = rows.withColumn(
        "epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(epochs - 1).cast("bigint")))
    )
    if shuffle:
        hashed = seeded_hash(seed, F.col("chunk_id"), F.col("epoch"), F.col("seq_id"))
        rows = hash_rank(rows, ["chunk_id", "epoch"], hashed, "seq_id", F.col("sequences"), "rank")
    else:
        rows = rows.withColumn("rank", F.col("seq_id"))
    length = F.lit(context_length).cast("bigint")
    n_tokens = F.least(length, F.col("chunk_tokens") - 1 - F.col("seq_id") * length)
    members = F.least(
        F.lit(batch_size), F.col("sequences") - F.col("batch_id") * F.lit(batch_size)
    )
    full_length = F.least(length, F.col("chunk_tokens") - 1)
    return (
        rows.withColumn("batch_id", int_div(F.col("rank"), batch_size))
        .withColumn("n_tokens", n_tokens)
        .withColumn("batch_len", F.when(members > 1, full_length).otherwise(F.col("n_tokens")))
        .select("chunk_id", "epoch", "batch_id", "rank", "seq_id", "n_tokens", "batch_len")
    )


def collate_batches(
    sequences: DataFrame, pad_token_id: int, assignment: DataFrame | None = None
) -> DataFrame:
    """Pad inputs with `pad_token_id` and labels with -100 to the longest of the batch, and mask.

    With `assignment`, `sequences` is joined to it by (chunk_id, seq_id). It may hold windows of
    `tokens` then, which are half of what inputs and labels are to shuffle, and are shifted after
    the join. Else `sequences` carries `chunk_id`, `epoch`, `batch_id` itself, with `input_ids` and
    `labels` of any length. The mask comes from lengths, never from values: the pad id may be a
    real id.
    """
    if assignment is not None:
        # A row per sequence and epoch, which the planner takes for a row per chunk: never broadcast.
        rows = sequences.join(assignment.hint("merge"), ["chunk_id", "seq_id"])
        if "tokens" in rows.columns:
            rows = shift_labels(rows)
    else:
        # A batch holds batch_size rows, so that this window is bounded.
        batch = W.partitionBy("chunk_id", "epoch", "batch_id")
        rows = sequences.withColumn("batch_len", F.max(F.size("input_ids")).over(batch))
    size = F.size("input_ids")
    missing = (F.col("batch_len") - size).cast("int")
    padded = {
        "input_ids": F.concat("input_ids", F.array_repeat(F.lit(pad_token_id), missing)),
        "labels": F.concat("labels", F.array_repeat(F.lit(IGNORED_LABEL), missing)),
        "attention_mask": F.concat(
            F.array_repeat(F.lit(1), size), F.array_repeat(F.lit(0), missing)
        ),
    }
    return rows.withColumns(padded)


def label_counts(collated: DataFrame) -> DataFrame:
    """Tokens (labels that count) and samples of each batch, from padded batches."""
    real = F.size(F.filter("labels", lambda x: x != F.lit(IGNORED_LABEL))).cast("bigint")
    return collated.groupBy("chunk_id", "epoch", "batch_id").agg(
        F.sum(real).alias("tokens"), F.count("*").alias("samples")
    )


def batch_token_counts(assignment: DataFrame) -> DataFrame:
    """The same counts from the assignment alone, without reading token arrays."""
    return assignment.groupBy("chunk_id", "epoch", "batch_id").agg(
        F.sum("n_tokens").alias("tokens"), F.count("*").alias("samples")
    )


def expected_steps(counts: DataFrame, batch_size: int, epochs: int = 1) -> DataFrame:
    batches = ceil_div(F.col("sequences"), batch_size)
    return counts.withColumn("batches", batches).withColumn(
        "expected_steps", F.col("batches") * F.lit(epochs)
    )


def global_steps(
    counts: DataFrame, batch_size: int, epochs: int = 1, first_step: int = 0
) -> DataFrame:
    """1-based step of every (chunk_id, epoch, batch_id), in that order."""
    steps = expected_steps(counts, batch_size, epochs).select(
        "chunk_id", "batches", "expected_steps"
    )
    # Chunk ids are dense, so the totals of this pass are 4,096 times fewer than the chunks.
    placed = running(
        steps,
        by_width("chunk_id", width=4096),
        {"steps_before": Running("sum", F.col("expected_steps"))},
    )
    numbered = _numbered(placed, F.col("expected_steps"), "__step")
    return numbered.select(
        "chunk_id",
        int_div(F.col("__step"), F.col("batches")).alias("epoch"),
        (F.col("__step") % F.col("batches")).alias("batch_id"),
        (F.lit(first_step) + F.col("steps_before") + F.col("__step") + 1).alias("global_step"),
    )
