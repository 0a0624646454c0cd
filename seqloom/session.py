"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "seqloom", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the SQL settings the plans here rely on; `conf` keys use `__` for `.`."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({key.replace("__", "."): str(value) for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: For rows that hold whole texts. Spark's own sizes count rows, 4,096 and 10,000: tens of megabytes of text, which a task
#: holds several times, in the scan's vectors, in the Arrow buffers of both sides and in its Python worker.
SMALL_BATCHES = {"spark.sql.parquet.columnarReaderBatchSize": "512", "spark.sql.execution.arrow.maxBytesPerBatch": "1m"}


def small_batches(spark: SparkSession) -> list[str]:
    """Set `SMALL_BATCHES` for the plans that this session runs from now on, and return the keys set.

    A size that the session already names is left as it is.
    """
    missing = [key for key in SMALL_BATCHES if spark.conf.get(key, None) is None]
    for key in missing:
        spark.conf.set(key, SMALL_BATCHES[key])
    return missing


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach.

    The cluster names it in `spark.checkpoint.dir`. Only a local session without that setting
    gets a temporary folder; a cluster without it is an error, since a machine-local folder would
    be lost with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    made = tempfile.mkdtemp(prefix="seqloom-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts the lineage with a table that outlives any executor. Used where several branches of one
    plan read the same costly intermediate result, which Spark would otherwise compute per branch.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
