"""The training-data pipeline: each stage works on what its predecessor kept.

Stages take (spark, docs, sf_dir) and return the columns of `docs`; the last returns tokens. Rows of
any content pass: null or blank texts end at the language stage; equal rows are copies of each other,
of which one stays; extra columns are carried, whatever their names.

A stage has its session move texts in small batches (`session.small_batches`). That stays set, since what
a stage returns is run later; `run` sets it back.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import wraps
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark import cloudpickle  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import seqloom  # noqa: E402
from seqloom.llm import bpe, decontaminate, language_id, near_copies, secret_scan, simhash  # noqa: E402
from seqloom.llm.bit_fields import without  # noqa: E402
from seqloom.llm.common import table, trains  # noqa: E402
from seqloom.operators.components import components  # noqa: E402
from seqloom.session import small_batches, written  # noqa: E402

cloudpickle.register_pickle_by_value(seqloom)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _in_small_batches(stage: Stage) -> Stage:
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a number each, written so that every branch sees the same numbers."""
    name = "row"
    while name in docs.columns:
        name += "_"
    return written(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


@_in_small_batches
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a recognisable language. The model learns from labelled rows of `docs`."""
    model = language_id.train(docs, trains(F.col("doc_id"), language_id.FOLDS))
    return language_id.keep_identified(docs, model)


@_in_small_batches
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of every group of near copies. Of rows that share it, any one.

    Texts are linked by SimHash fingerprints within op3's radius, and by five-word shingles at a Jaccard
    similarity of 0.8 or more, many of which lie beyond that radius. A group is closed over both.
    """
    numbered, row = _numbered(docs)
    found = [simhash.near_duplicates(numbered, id_col=row), near_copies.near_copies(numbered, id_col=row)]
    links = [groups.select(F.col("doc_id").alias("u"), F.col("component_id").alias("v")).where("u <> v") for groups in found]
    roots = components(links[0].unionByName(links[1]))
    key = numbered.select(F.col(row).alias("node"), F.struct(F.col("doc_id").isNull(), "doc_id", row).alias("key"))
    linked = written(key.join(roots, "node"), "linked")
    stay = linked.groupBy("root").agg(F.min("key").alias("key")).select(F.col(f"key.{row}").alias("node"))
    dropped = written(linked.select("node").join(stay, "node", "left_anti").withColumnRenamed("node", row), "dropped")
    return without(numbered, row, dropped).drop(row)


@_in_small_batches
def no_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


@_in_small_batches
def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a secret."""
    return secret_scan.keep_clean(docs)


@_in_small_batches
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the token ids, and digests of ids and decoded text."""
    return bpe.round_trip(docs, with_ids=True)


STAGES = [
    ("language_id", known_language),
    ("simhash_dedup", one_of_each_group),
    ("decontaminate", no_benchmark_passages),
    ("secret_scan", no_secrets),
    ("bpe", tokens),
]

#: A learned model and a graph of fingerprints are not SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ours = small_batches(spark)
    try:
        for name, stage in STAGES:
            docs = written(stage(spark, docs, sf_dir), name)
    finally:
        for key in ours:
            spark.conf.unset(key)
    return docs
