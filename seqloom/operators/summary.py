"""Run summaries, the checkpoint catalogue, and per-chunk progress."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.functions.text import file_safe
from seqloom.operators.intervals import every_n_steps
from seqloom.operators.ordered import Running, by_width, running

RUN = ("run_id",)

# The name patterns of checkpoints.
PERIODIC_NAME = "checkpoint-step-%08d.pt"
BEST_NAME = "best-%s.pt"
THRESHOLD_NAME = "%s-step-%08d.pt"
CHUNK_NAME = "checkpoint-chunk-%06d.pt"
FINAL_NAME = "final_checkpoint.pt"

CATALOG = ("category", "checkpoint_name", "global_step", "chunk_id", "monitored_metric", "monitored_value")


def completed_chunks(steps: DataFrame, expected: DataFrame, keys: Sequence[str] = RUN) -> DataFrame:
    """Chunks whose steps all ran, with the last step; `expected` has `expected_steps` per chunk."""
    ran = steps.groupBy(*keys, "chunk_id").agg(
        F.count("*").alias("chunk_steps"), F.max("global_step").alias("global_step")
    )
    return ran.join(expected, [*keys, "chunk_id"]).filter(
        F.col("chunk_steps") >= F.col("expected_steps")
    )


def run_summary(
    steps: DataFrame, chunks: DataFrame, stops: DataFrame, keys: Sequence[str] = RUN
) -> DataFrame:
    """One row per run: last step, tokens and samples seen, documents of committed chunks, reason.

    `chunks` are the completed chunks with their `documents`; `stops` is (keys, stop_reason).
    """
    seen = steps.groupBy(*keys).agg(
        F.max("global_step").alias("global_step"),
        F.sum("tokens").alias("tokens_seen"),
        F.sum("samples").alias("samples_seen"),
        F.max("chunk_id").alias("last_chunk_id"),
    )
    documents = chunks.groupBy(*keys).agg(F.sum("documents").alias("trained_documents"))
    return (
        seen.join(documents, list(keys), "left")
        .join(stops.select(*keys, "stop_reason"), list(keys), "left")
        .withColumn("trained_documents", F.coalesce("trained_documents", F.lit(0)))
    )


def checkpoint_catalog(
    steps: DataFrame,
    best: DataFrame,
    thresholds: DataFrame,
    chunks: DataFrame,
    save_every: int,
    metric: str,
    keys: Sequence[str] = RUN,
    best_metric: str | None = None,
) -> DataFrame:
    """Every checkpoint written, by category; names of best and final ones repeat (overwritten)."""
    best_metric = best_metric or metric

    def rows(df: DataFrame, category: str, name: Column, watched: str | None = None) -> DataFrame:
        value = F.col("value") if watched else F.lit(None)
        return df.select(
            *keys,
            F.lit(category).alias("category"),
            name.alias("checkpoint_name"),
            "global_step",
            "chunk_id",
            F.lit(watched).cast("string").alias("monitored_metric"),
            value.cast("double").alias("monitored_value"),
        )

    step, chunk = F.col("global_step"), F.col("chunk_id")
    last = steps.groupBy(*keys).agg(
        F.max("global_step").alias("global_step"), F.max("chunk_id").alias("chunk_id")
    )
    parts = [
        rows(every_n_steps(steps, save_every), "periodic", F.format_string(PERIODIC_NAME, step)),
        rows(best, "best", F.format_string(BEST_NAME, file_safe(F.lit(best_metric))), best_metric),
        rows(
            thresholds,
            "threshold",
            F.format_string(THRESHOLD_NAME, file_safe(F.lit(metric)), step),
            metric,
        ),
        rows(chunks, "chunk", F.format_string(CHUNK_NAME, chunk)),
        rows(last, "final", F.lit(FINAL_NAME)),
    ]
    catalog = parts[0]
    for part in parts[1:]:
        catalog = catalog.unionByName(part)
    return catalog


def latest_checkpoints(catalog: DataFrame, keys: Sequence[str] = RUN) -> DataFrame:
    """What is on disk in the end: the last write under each name."""
    row = F.struct("global_step", "chunk_id", "monitored_metric", "monitored_value")
    return (
        catalog.groupBy(*keys, "category", "checkpoint_name")
        .agg(F.max_by(row, "global_step").alias("__row"))
        .select(*keys, "category", "checkpoint_name", "__row.*")
    )


def progress_history(
    manifest: DataFrame, steps_per_chunk: DataFrame | None = None, start: dict[str, int] | None = None
) -> DataFrame:
    """The progress record after each chunk of a manifest (dense chunk ids, so a bounded pass)."""
    start = start or {}
    rows = manifest
    if steps_per_chunk is not None:
        rows = rows.join(steps_per_chunk.select("chunk_id", "expected_steps"), "chunk_id")
    else:
        rows = rows.withColumn("expected_steps", F.lit(0).cast("bigint"))
    totals = running(
        rows,
        by_width("chunk_id", width=4096),
        {
            "trained_documents": Running("sum", F.col("documents"), inclusive=True),
            "source_rows_consumed": Running("sum", F.col("source_rows"), inclusive=True),
            "global_step": Running("sum", F.col("expected_steps"), inclusive=True),
        },
    )
    return totals.select(
        "chunk_id",
        *[
            (F.col(name) + F.lit(start.get(name, 0))).cast("bigint").alias(name)
            for name in ("trained_documents", "source_rows_consumed", "global_step")
        ],
        (F.col("chunk_id") + 1).alias("next_chunk_id"),
        F.format_string(CHUNK_NAME, F.col("chunk_id")).alias("checkpoint_path"),
    )
