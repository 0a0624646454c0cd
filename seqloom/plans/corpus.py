"""A whole corpus run: scan, order, skip, clean, chunk, tokenize, pack, commit, resume."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions.numeric import int_div
from seqloom.functions.tokenizers import Tokenizer
from seqloom.operators.batching import assign_batches, collate_batches, expected_steps
from seqloom.operators.corpus import row_ordinal, shuffle_buffered, shuffle_full, skip_rows
from seqloom.operators.monitors import DATASET_EXHAUSTED, TOTAL_DOCUMENTS
from seqloom.operators.ordered import BUCKET, RowOrder, by_hash, by_value, by_width
from seqloom.operators.packing import (
    CorpusIndex,
    chunk_documents,
    index_corpus,
    pack_sequences,
    pack_windows,
    sequence_counts,
)
from seqloom.options import RunOptions
from seqloom.session import new_folder
from seqloom.sources import progress as progress_store
from seqloom.sources.corpus import require_text_column, scan_corpus, toy_corpus


def open_corpus(spark: SparkSession, options: RunOptions, root: str = "", fmt: str = "parquet") -> DataFrame:
    """The dataset the options name, below `root`. The toy corpus gets as many rows as are wanted."""
    if options.dataset_name == "toy":
        return toy_corpus(spark, options.total_documents)
    path = f"{root.rstrip('/')}/{options.dataset_name}" if root else options.dataset_name
    return scan_corpus(spark, path, options.dataset_config, options.dataset_split, fmt)


def _placed(keys: DataFrame, options: RunOptions) -> DataFrame:
    """(__key, row_idx): the order of the options over keys."""
    if options.shuffle_buffer == 0:
        return row_ordinal(keys, by_value(keys, "__key"))
    if options.streaming:
        return shuffle_buffered(
            row_ordinal(keys, by_value(keys, "__key")), options.seed, "__key", options.shuffle_buffer
        )
    return shuffle_full(keys, options.seed, "__key")


def _order_log(spark: SparkSession, options: RunOptions) -> DataFrame | None:
    """What the run's order was made from, one row per part of it; None if it has none yet."""
    try:
        return spark.read.schema("rule string, part bigint, rows bigint").json(f"{options.output_dir}/order-log")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _check_order(rows: DataFrame, key: str, options: RunOptions) -> tuple[int, int]:
    """Parts and rows of the order so far. Fails if the run was begun with another one."""
    spark = rows.sparkSession
    log = _order_log(spark, options)
    if log is None:
        return 0, 0
    rule, parts, size = log.agg(F.max("rule"), F.count("*"), F.sum("rows")).first()
    if parts and rule != _rule(key, options):
        raise ValueError(f"this run was begun with the order {rule}, not {_rule(key, options)}")
    return parts, size or 0


def _rule(key: str, options: RunOptions) -> str:
    return f"key={key} seed={options.seed} buffer={options.shuffle_buffer} streaming={options.streaming}"


def _log_order(spark: SparkSession, key: str, options: RunOptions, part: int, size: int) -> None:
    row = [(_rule(key, options), part, size)]
    made = spark.createDataFrame(row, "rule string, part bigint, rows bigint")
    made.write.mode("append").json(f"{options.output_dir}/order-log")


def _stored_positions(rows: DataFrame, key: str, options: RunOptions) -> DataFrame:
    """(__key, row_idx) of the run's order, kept with its output.

    Parts are logged once they are written whole; a part without its entry is written anew. Rows
    that the source has gained since form a further part behind the others, in the same order among
    themselves; a source that has lost rows fails the run.
    """
    spark, path = rows.sparkSession, f"{options.output_dir}/order"
    keys = rows.select(F.col(key).alias("__key"))
    parts, size = _check_order(rows, key, options)
    if parts:
        known = spark.read.parquet(*[f"{path}/{n}" for n in range(parts)])
        left = known.join(keys, "__key", "left_semi").count()
        if left != size:
            raise ValueError(f"the source has lost {size - left} of the {size} rows of this run's order")
        fresh = keys.join(known, "__key", "left_anti")
    else:
        known, fresh = None, keys
    placed = _placed(fresh, options).select("__key", (F.col("row_idx") + F.lit(size)).alias("row_idx"))
    added = fresh.count() if parts else None
    if added != 0:
        placed.write.mode("overwrite").parquet(f"{path}/{parts}")
        part = spark.read.parquet(f"{path}/{parts}")
        _log_order(spark, key, options, parts, part.count())
        known = part if known is None else known.unionByName(part)
    return known


def ordered_corpus(
    rows: DataFrame, key: str, options: RunOptions, skip: int = 0
) -> tuple[DataFrame, RowOrder]:
    """The rows to read and their order.

    A buffered shuffle needs positions, which are stored once as a narrow table. Any other order is
    an expression of the row; it needs them only to skip, and then the source must have as many rows
    as when the run began, as its order is not kept.
    """
    buffered = options.shuffle_buffer > 0 and options.streaming
    if skip > 0 and not buffered:
        parts, size = _check_order(rows, key, options)
        now = rows.count()
        if parts and size != now:
            raise ValueError(f"the source had {size} rows when this run began and has {now} now")
        keys = rows.select(F.col(key).alias("__key"))
        named = skip_rows(_placed(keys, options), skip).withColumnRenamed("row_idx", "__position")
        found = rows.join(named, F.col(key) == F.col("__key")).drop("__key")
        return found, by_width("__position")
    if buffered:
        positions = skip_rows(_stored_positions(rows, key, options), skip)
        named = positions.withColumnRenamed("row_idx", "__position")
        found = rows.join(named, F.col(key) == F.col("__key")).drop("__key")
        return found, by_width("__position")
    if options.shuffle_buffer > 0:
        return rows, by_hash(rows, options.seed, key)
    return rows, by_value(rows, key)


def corpus_index(
    rows: DataFrame, key: str, options: RunOptions, tokenizer: Tokenizer, done: dict[str, int]
) -> CorpusIndex:
    require_text_column(rows, options.text_column)
    wanted, order = ordered_corpus(
        rows.select(key, options.text_column), key, options, done["source_rows_consumed"]
    )
    return index_corpus(
        wanted,
        tokenizer,
        options.chunk_size,
        options.text_column,
        order,
        options.total_documents,
        done["trained_documents"],
        done["next_chunk_id"],
    )


def prepare_corpus(
    rows: DataFrame, key: str, options: RunOptions, tokenizer: Tokenizer, commit_every: int | None = None
) -> DataFrame:
    """Pack what is left of a run, commit it, and give the run's progress with `stop_reason`.

    Sequences go to `<output_dir>/sequences`, one partition per commit, progress to
    `<output_dir>/progress`. Without `commit_every` a call is one commit, and one that died is
    repeated whole by the next. With it every so many chunks are a commit, and the next call
    repeats the one range that was under way; for that the token streams are written by range
    once a call, and shuffled once more than in a single commit.
    """
    if commit_every is not None and commit_every <= 0:
        raise ValueError("commit_every must be positive")
    spark = rows.sparkSession
    store = f"{options.output_dir}/progress"
    done = progress_store.load_progress(spark, store).first().asDict()
    reached = done["trained_documents"] >= options.total_documents
    if not reached:
        buffered = options.shuffle_buffer > 0 and options.streaming
        if not buffered and _order_log(spark, options) is None:
            _log_order(spark, key, options, 0, rows.count())
        _commit_ranges(corpus_index(rows, key, options, tokenizer, done), options, done, commit_every)
    full = F.col("trained_documents") >= F.lit(options.total_documents)
    return progress_store.load_progress(spark, store).withColumn(
        "stop_reason", F.when(full, F.lit(TOTAL_DOCUMENTS)).otherwise(F.lit(DATASET_EXHAUSTED))
    )


def _commit_ranges(index: CorpusIndex, options: RunOptions, done: dict[str, int], every: int | None) -> None:
    """Packs and commits the chunks of an index in ranges of `every`, or all at once, with progress after each.

    The driver holds one row of sums per range and no more.
    """
    first = done["next_chunk_id"]
    number = int_div(F.col("chunk_id") - first, every) if every else F.lit(0).cast("bigint")
    steps = expected_steps(sequence_counts(index.chunks, options.context_length), options.batch_size, options.epochs)
    sums = (
        index.chunks.join(steps.select("chunk_id", "expected_steps"), "chunk_id")
        .groupBy(number.alias("range"))
        .agg(
            F.sum("documents").alias("documents"),
            F.sum("source_rows").alias("source_rows"),
            F.sum("expected_steps").alias("steps"),
            F.min("chunk_id").alias("first_chunk"),
            F.max("chunk_id").alias("last_chunk"),
        )
    )
    ranges = sorted(sums.collect(), key=lambda r: r["range"])
    docs = chunk_documents(index)
    if len(ranges) > 1:
        docs = _by_range(docs, number)
    total = dict(done)
    for found in ranges:
        own = docs.where(F.col("__range") == found["range"]) if len(ranges) > 1 else docs
        part = pack_sequences(own, options.context_length).withColumn("first_chunk_id", F.lit(found["first_chunk"]))
        total["trained_documents"] += found["documents"]
        total["source_rows_consumed"] += found["source_rows"]
        total["global_step"] += found["steps"]
        total["next_chunk_id"] = found["last_chunk"] + 1
        names = ("trained_documents", "source_rows_consumed", "next_chunk_id", "global_step")
        record = index.rows.sparkSession.range(1).select(
            *[F.lit(total[name]).cast("bigint").alias(name) for name in names], F.lit("").alias("checkpoint_path")
        )
        progress_store.commit_chunks(
            part, record, f"{options.output_dir}/sequences", f"{options.output_dir}/progress", "first_chunk_id"
        )


def _by_range(docs: DataFrame, number: Column) -> DataFrame:
    """The token streams of documents in one folder per range, so that a commit reads its own only."""
    names = [BUCKET, "chunk_id", "n_tok", "tok_start", "chunk_tokens", "bucket_low", "bucket_high", "tokens"]
    staged = docs.select(*names, number.alias("__range"))
    path = new_folder(docs.sparkSession, "ranges")
    staged.write.partitionBy("__range").parquet(path)
    return docs.sparkSession.read.schema(staged.schema).parquet(path)


def training_batches(
    rows: DataFrame, key: str, options: RunOptions, tokenizer: Tokenizer, pad_token_id: int | None = None
) -> DataFrame:
    """Padded batches of the whole corpus, straight from the source rows."""
    done = {name: 0 for name in progress_store.PROGRESS_DEFAULTS}
    index = corpus_index(rows, key, options, tokenizer, done)
    counts = sequence_counts(index.chunks, options.context_length)
    assignment = assign_batches(
        counts, options.context_length, options.batch_size, options.epochs, options.seed
    )
    windows = pack_windows(chunk_documents(index), options.context_length)
    pad = tokenizer.eos_token_id if pad_token_id is None else pad_token_id
    return collate_batches(windows, pad, assignment)
