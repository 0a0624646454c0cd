"""Corpus scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The four texts of the toy corpus, repeated in this order.
TOY_TEXTS = (
    "A language model predicts the next token from previous tokens.",
    "Wikipedia articles are commonly used as one component of pretraining data.",
    "Causal attention prevents a token from reading future tokens.",
    "The optimizer updates model parameters using gradients from the loss.",
)


def scan_corpus(
    spark: SparkSession,
    path: str,
    config: str | None = None,
    split: str | None = None,
    fmt: str = "parquet",
    streaming: bool = False,
    schema: StructType | None = None,
    **options: object,
) -> DataFrame:
    """Open the dataset at `path`; `config` and `split` are sub-folders of it.

    Lazy either way. `streaming` gives a file stream, which needs the schema: it is taken from the
    files when not given.
    """
    location = "/".join(part for part in (path.rstrip("/"), config, split) if part)
    if streaming:
        schema = schema or spark.read.format(fmt).load(location).schema
        reader = spark.readStream.schema(schema)
    else:
        reader = spark.read.schema(schema) if schema else spark.read
    return reader.format(fmt).options(**options).load(location)


def toy_corpus(spark: SparkSession, rows: int) -> DataFrame:
    """The first `rows` rows of the repeating toy corpus, as (row_idx, text)."""
    return toy_texts(spark.range(rows).withColumnRenamed("id", "row_idx"))


def toy_stream(spark: SparkSession, rows_per_second: int = 1_000) -> DataFrame:
    """The endless form, from Spark's rate source."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return toy_texts(ticks.select(F.col("value").alias("row_idx")))


def toy_texts(positions: DataFrame, position: str = "row_idx", keep: tuple[str, ...] = ()) -> DataFrame:
    """Give each position its toy text; `keep` names columns to carry along."""
    texts = F.array(*[F.lit(text) for text in TOY_TEXTS])
    index = F.pmod(F.col(position), F.lit(len(TOY_TEXTS))).cast("int") + 1
    return positions.select(position, *keep, F.element_at(texts, index).alias("text"))


def spread(df: DataFrame) -> DataFrame:
    """Repartition an input of fewer splits than the cluster has cores; leave any other alone.

    A small file, or one with a single row group, is one split however many cores there are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def require_text_column(df: DataFrame, text_column: str) -> None:
    """Fail before planning, naming what there is."""
    if text_column not in df.columns:
        raise KeyError(
            f"no text column {text_column!r} among: {', '.join(sorted(df.columns))}"
        )
