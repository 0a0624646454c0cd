"""Per-chunk progress: written after the output it speaks of, read back with defaults."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The fields of a progress record and what stands for a missing one.
PROGRESS_DEFAULTS = {
    "trained_documents": 0,
    "source_rows_consumed": 0,
    "next_chunk_id": 0,
    "global_step": 0,
    "checkpoint_path": "",
}
PROGRESS_SCHEMA = (
    "trained_documents bigint, source_rows_consumed bigint, next_chunk_id bigint, "
    "global_step bigint, checkpoint_path string, batch_id bigint, pending array<string>"
)


def load_progress(spark: SparkSession, path: str, before_batch: int | None = None) -> DataFrame:
    """One row: the newest committed record, or the defaults where there is none.

    `before_batch` leaves out the records of that stream batch and later ones, so that a batch that
    runs again starts from what it saw the first time.
    """
    try:
        rows = spark.read.schema(PROGRESS_SCHEMA).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], PROGRESS_SCHEMA)
    if before_batch is not None:
        rows = rows.filter(F.col("batch_id") < F.lit(before_batch))
    newest = rows.agg(F.max_by(F.struct(*PROGRESS_DEFAULTS), _age()).alias("__newest"))
    return newest.select(
        *[
            F.coalesce(F.col(f"__newest.{name}"), F.lit(value)).alias(name)
            for name, value in PROGRESS_DEFAULTS.items()
        ]
    )


def _age() -> Column:
    """Orders records of one run: progress only grows, and so does what waits while nothing else does."""
    waiting = F.coalesce(F.size("pending"), F.lit(0))
    return F.struct("next_chunk_id", F.coalesce("source_rows_consumed", F.lit(0)), waiting)


def load_pending(spark: SparkSession, path: str, before_batch: int | None = None) -> list[str]:
    """Folders of rows that a stream has read but not accepted, in their order, as of the newest record."""
    try:
        rows = spark.read.schema(PROGRESS_SCHEMA).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    if before_batch is not None:
        rows = rows.filter(F.col("batch_id") < F.lit(before_batch))
    return rows.agg(F.max_by("pending", _age())).first()[0] or []


def drains(spark: SparkSession, path: str) -> int:
    """How often waiting rows were taken up between two starts of a stream."""
    try:
        rows = spark.read.schema(PROGRESS_SCHEMA).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    return rows.filter("batch_id < 0").count()


def save_progress(rows: DataFrame, path: str) -> None:
    """Append progress records. Each commit is atomic; the newest record wins on reading."""
    names = [c for c in (*PROGRESS_DEFAULTS, "batch_id", "pending") if c in rows.columns]
    rows.select(*names).write.mode("append").json(path)


def commit_output(output: DataFrame, output_path: str, partition: str) -> None:
    """Write partitions of finished work, replacing those of an earlier try."""
    (
        output.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(output_path)
    )


def commit_chunks(
    output: DataFrame, progress: DataFrame, output_path: str, progress_path: str, partition: str = "chunk_id"
) -> None:
    """Output first, progress last: a failure in between repeats the work and loses none."""
    commit_output(output, output_path, partition)
    save_progress(progress, progress_path)


def check_resume(progress: DataFrame, checkpoint_step: int) -> dict[str, object]:
    """The progress record as a dict, if it agrees with the step of the checkpoint resumed from."""
    record = progress.first().asDict()
    if record["global_step"] != checkpoint_step:
        raise ValueError(
            f"progress is at step {record['global_step']}, the checkpoint at {checkpoint_step}"
        )
    return record


def save_json(row: DataFrame, path: str) -> None:
    """A run's options or summary: a table of one row or a few."""
    row.write.mode("overwrite").json(path)
