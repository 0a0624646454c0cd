"""Corpus ingest as a stream: bounded micro-batches, each a set of chunks, committed one by one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from seqloom.functions.tokenizers import Tokenizer
from seqloom.operators.batching import expected_steps
from seqloom.operators.corpus import row_ordinal
from seqloom.operators.ordered import RowOrder
from seqloom.operators.packing import (
    chunk_documents,
    index_corpus,
    pack_sequences,
    sequence_counts,
)
from seqloom.sources.progress import (
    PROGRESS_DEFAULTS,
    PROGRESS_SCHEMA,
    commit_output,
    drains,
    load_pending,
    load_progress,
    save_progress,
)


def ingest_stream(
    rows: DataFrame,
    tokenizer: Tokenizer,
    order: Callable[[DataFrame], RowOrder],
    output_path: str,
    progress_path: str,
    checkpoint: str,
    text_column: str = "text",
    chunk_size: int = 10_000,
    context_length: int = 1024,
    batch_size: int = 8,
    epochs: int = 1,
    total_documents: int | None = None,
) -> StreamingQuery:
    """Pack a file stream into sequences until its files are used up.

    The rows of a micro-batch (set `maxFilesPerTrigger` on the source) are ordered by `order` and
    cut into chunks numbered on from the stored progress; its last chunk may be short. The output
    has one partition per micro-batch, replaced when the batch runs again, and progress follows it.

    Rows behind `total_documents` are read by the stream but not used up: they wait beside the
    progress, in their order, and are taken first by the next batch or start that has a higher cap.
    """
    spark = rows.sparkSession

    def pack(part: DataFrame, done: dict) -> tuple[DataFrame, dict, DataFrame | None]:
        """Sequences of one set of rows, the progress after it, and the rows behind the cap."""
        index = index_corpus(
            part,
            tokenizer,
            chunk_size,
            text_column,
            order(part),
            total_documents,
            done["trained_documents"],
            done["next_chunk_id"],
        )
        chunks = sequence_counts(index.chunks, context_length)
        steps = expected_steps(chunks, batch_size, epochs).select("chunk_id", "expected_steps")
        new = (
            index.chunks.join(steps, "chunk_id")
            .agg(
                F.coalesce(F.sum("documents"), F.lit(0)).alias("documents"),
                F.coalesce(F.sum("source_rows"), F.lit(0)).alias("source_rows"),
                F.coalesce(F.sum("expected_steps"), F.lit(0)).alias("steps"),
                F.max("chunk_id").alias("last_chunk"),
            )
            .first()
        )
        after = dict(done)
        after["trained_documents"] += new["documents"]
        after["global_step"] += new["steps"]
        if new["last_chunk"] is not None:
            after["next_chunk_id"] = new["last_chunk"] + 1
        behind, used = None, part.count()
        if _full(after) and new["source_rows"] < used:
            used = new["source_rows"]
            behind = row_ordinal(part, order(part)).where(F.col("row_idx") >= used).drop("row_idx")
        after["source_rows_consumed"] += used
        return pack_sequences(chunk_documents(index), context_length), after, behind

    def _full(done: dict) -> bool:
        return total_documents is not None and done["trained_documents"] >= total_documents

    def take(waiting: list[str], batch: DataFrame | None, done: dict, number: int) -> None:
        """Waiting rows first, then the batch; what the cap leaves over waits on."""
        parts = [(folder, spark.read.parquet(folder)) for folder in waiting]
        if batch is not None:
            parts.append((None, batch))
        packed, left = [], []
        for place, (folder, part) in enumerate(parts):
            behind = part
            if not _full(done):
                sequences, done, behind = pack(part, done)
                packed.append(sequences)
                folder = None
            if behind is not None:
                if folder is None:
                    folder = f"{progress_path}-pending/{number}-{place}"
                    behind.write.mode("overwrite").parquet(folder)
                left.append(folder)
        for sequences in packed[1:]:
            packed[0] = packed[0].unionByName(sequences)
        if packed:
            commit_output(packed[0].withColumn("batch_id", F.lit(number)), output_path, "batch_id")
        record = {name: done[name] for name in PROGRESS_DEFAULTS} | {"batch_id": number, "pending": left}
        schema = StructType.fromDDL(PROGRESS_SCHEMA)
        save_progress(spark.createDataFrame([tuple(record[f.name] for f in schema)], schema), progress_path)

    def handle(batch: DataFrame, batch_id: int) -> None:
        done = load_progress(spark, progress_path, before_batch=batch_id).first().asDict()
        take(load_pending(spark, progress_path, before_batch=batch_id), batch, done, batch_id)

    # Without new files there is no batch, so waiting rows are taken up here, unless the last batch
    # was not finished and will run again, under the new cap.
    waiting = load_pending(spark, progress_path)
    done = load_progress(spark, progress_path).first().asDict()
    if waiting and not _full(done) and _finished(spark, progress_path, checkpoint):
        take(waiting, None, done, -1 - drains(spark, progress_path))

    return (
        rows.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _finished(spark: SparkSession, progress_path: str, checkpoint: str) -> bool:
    """Whether the stream has committed the last batch that saved progress."""
    last = spark.read.schema(PROGRESS_SCHEMA).json(progress_path).agg(F.max("batch_id")).first()[0]
    try:
        return last is None or last < 0 or spark.read.text(f"{checkpoint}/commits/{last}").count() >= 0
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
