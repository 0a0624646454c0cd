"""Inputs of the registered queries: the given tables, and tables that Spark derives from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.operators.intervals import metric_records
from seqloom.operators.ordered import by_width, ordinal
from seqloom.operators.series import metrics_long, monitored_value, smoothed_metrics
from seqloom.session import written
from seqloom.sources.corpus import spread

SEED = 42
CHUNK_SIZE = 100
CONTEXT = 128
BATCH = 8
EPOCHS = 2
CHUNK_STEPS = 20
EVERY = 8
WINDOW = 5
FIRST_STEP_SECONDS = 1.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def spread_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For costly work row by row: over all cores even where the file has a single row group."""
    return spread(documents(spark, sf_dir).select("doc_id", "text"))


def padded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with whitespace around it, each followed by a blank or null row."""
    blank = (
        F.when(F.col("doc_id") % 3 == 0, F.lit("   "))
        .when(F.col("doc_id") % 3 == 1, F.lit(" \t "))
        .otherwise(F.lit(None).cast("string"))
    )
    padded = F.concat(F.lit("\t\x1c "), F.col("text"), F.lit("  \n"))
    return documents(spark, sf_dir).select(
        F.inline(
            F.array(
                F.struct((F.col("doc_id") * 2).alias("row_key"), padded.alias("text")),
                F.struct((F.col("doc_id") * 2 + 1).alias("row_key"), blank.alias("text")),
            )
        )
    )


def steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event stream read as training steps: a run per user, a step per event."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    placed = ordinal(
        events.withColumnRenamed("user_id", "run_id"),
        by_width("event_id"),
        "position",
        ["run_id"],
        size="run_steps",
    )
    step = F.col("position") + 1
    in_chunk = F.col("position") % CHUNK_STEPS
    return placed.select(
        "run_id",
        step.alias("global_step"),
        F.floor(F.col("position") / CHUNK_STEPS).cast("bigint").alias("chunk_id"),
        (F.floor(in_chunk / (CHUNK_STEPS // 2)) + 1).cast("bigint").alias("epoch"),
        # Irrational numbers, so that their means have no ties in rounding.
        F.log(F.col("value") + 1).alias("loss"),
        F.sqrt("value").alias("grad_norm"),
        F.lit(2e-4).alias("learning_rate"),
        (F.col("event_id") % 64 + 64).cast("bigint").alias("tokens"),
        F.lit(BATCH).cast("bigint").alias("samples"),
        "ts",
        ((step % CHUNK_STEPS == 0) | (step == F.col("run_steps"))).alias("last_in_chunk"),
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metric log. A table on disk in any real use, so it is written once here as well."""
    log = metric_records(steps(spark, sf_dir), EVERY, first_step_seconds=FIRST_STEP_SECONDS)
    return written(log, "records")


def observed(spark: SparkSession, sf_dir: str, metric: str = "train_loss") -> DataFrame:
    """What a monitor of one metric sees; only that metric is melted and smoothed."""
    log = records(spark, sf_dir)
    one = metrics_long(log.select("run_id", "record_seq", "global_step", metric))
    return written(monitored_value(log, smoothed_metrics(one, WINDOW), metric), "observed")


def router(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Router logits: every element of a vector stands for one expert."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("logits")
    )
