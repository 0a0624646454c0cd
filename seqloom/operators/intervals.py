"""From one row per training step to one metric record per interval."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.functions.numeric import ceil_div, elapsed_seconds, perplexity, rate
from seqloom.operators.ordered import RowOrder, Running, by_width, running

# The fields of a metric record, in the order they are logged.
RECORD_METRICS = (
    "chunk_id",
    "epoch",
    "train_loss",
    "perplexity",
    "grad_norm",
    "learning_rate",
    "tokens_per_second",
    "samples_per_second",
    "tokens_seen",
    "samples_seen",
)


def every_n_steps(df: DataFrame, every: int, step: str = "global_step") -> DataFrame:
    """Rows whose step is a multiple of `every`; 0 selects nothing."""
    if every <= 0:
        return df.filter(F.lit(False))
    return df.filter(F.col(step) % F.lit(every) == 0)


def interval_metrics(
    steps: DataFrame,
    every: int,
    keys: Sequence[str] = ("run_id",),
    first_step_seconds: float = 0.0,
) -> DataFrame:
    """Means and sums since the last record, per interval of `every` steps inside a chunk.

    A record is due when the step is a multiple of `every`, and once more for what remains when the
    chunk ends. Its step is the last one of the interval. `elapsed` runs from the end of the
    interval before it in the chunk; `ts` is the end of a step, so that for a chunk's first
    interval it runs from the end of the first step and adds `first_step_seconds`, what that step
    is taken to have lasted. Each closing step also leaves its time in the next interval, so that
    one aggregation does it all.
    """
    if every <= 0:
        raise ValueError("every must be positive")
    interval = ceil_div(F.col("global_step"), every)
    closes = F.col("global_step") % F.lit(every) == 0
    homes = F.when(closes, F.array(interval, interval + 1)).otherwise(F.array(interval))
    rows = steps.withColumn("interval", F.explode(homes)).withColumn(
        "__own", F.col("interval") == interval
    )
    own = F.col("__own")
    step = F.when(own, F.col("global_step"))
    grouped = rows.groupBy(*keys, "chunk_id", "interval").agg(
        F.count(F.when(own, 1)).alias("interval_steps"),
        F.max(step).alias("global_step"),
        F.max_by("epoch", step).alias("epoch"),
        F.max_by("learning_rate", step).alias("learning_rate"),
        F.avg(F.when(own, F.col("loss"))).alias("train_loss"),
        F.avg(F.when(own, F.col("grad_norm"))).alias("grad_norm"),
        F.sum(F.when(own, F.col("tokens"))).alias("tokens"),
        F.sum(F.when(own, F.col("samples"))).alias("samples"),
        F.max(F.when(own, F.col("ts"))).alias("__end"),
        F.max(F.when(~own, F.col("ts"))).alias("__before"),
        F.min(F.when(own, F.col("ts"))).alias("__first"),
    )
    is_first = F.col("__before").isNull()
    start = F.coalesce("__before", "__first")
    elapsed = elapsed_seconds(start, F.col("__end")) + F.when(
        is_first, F.lit(first_step_seconds)
    ).otherwise(F.lit(0.0))
    return grouped.filter(F.col("interval_steps") > 0).select(
        *keys,
        "chunk_id",
        "global_step",
        "epoch",
        "interval_steps",
        "train_loss",
        "grad_norm",
        "learning_rate",
        "tokens",
        "samples",
        elapsed.alias("elapsed"),
    )


def throughput(intervals: DataFrame) -> DataFrame:
    return intervals.withColumns(
        {
            "tokens_per_second": rate(F.col("tokens"), F.col("elapsed")),
            "samples_per_second": rate(F.col("samples"), F.col("elapsed")),
        }
    )


def running_totals(
    rows: DataFrame, keys: Sequence[str] = ("run_id",), order: RowOrder | None = None
) -> DataFrame:
    """Add `tokens_seen` and `samples_seen`, the totals up to and including the row."""
    return running(
        rows,
        order or by_width("global_step"),
        {
            "tokens_seen": Running("sum", F.col("tokens"), inclusive=True),
            "samples_seen": Running("sum", F.col("samples"), inclusive=True),
        },
        keys,
    )


def metric_records(
    steps: DataFrame,
    every: int,
    keys: Sequence[str] = ("run_id",),
    first_step_seconds: float = 0.0,
) -> DataFrame:
    """The metric log of each run: one wide record per interval, numbered by `record_seq`."""
    intervals = throughput(interval_metrics(steps, every, keys, first_step_seconds))
    totals = running(
        intervals,
        by_width("global_step"),
        {
            "record_seq": Running("sum", F.lit(1).cast("bigint")),
            "tokens_seen": Running("sum", F.col("tokens"), inclusive=True),
            "samples_seen": Running("sum", F.col("samples"), inclusive=True),
        },
        keys,
    )
    return totals.withColumn("perplexity", perplexity(F.col("train_loss"))).select(
        *keys, "record_seq", "global_step", *RECORD_METRICS
    )


def masked_mean_loss(
    token_losses: DataFrame,
    keys: Sequence[str],
    weight: str | None = None,
    ignored_label: int = -100,
) -> DataFrame:
    """Mean of `nll` over the positions whose `label` counts.

    `weight` names a count, where equal positions were merged beforehand.
    """
    times = F.col(weight) if weight else F.lit(1)
    return (
        token_losses.filter(F.col("label") != F.lit(ignored_label))
        .groupBy(*keys)
        .agg(
            (F.sum(F.col("nll") * times) / F.sum(times)).alias("mean_loss"),
            F.sum(times).cast("bigint").alias("label_count"),
        )
    )
