"""Metric series: melt, trailing means, tags, down-sampling, selection for plots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from seqloom.functions.numeric import int_div
from seqloom.functions.text import axis_label
from seqloom.operators.ordered import by_width, ordinal, trailing

# The two tag prefixes of scalar series.
RAW_TAG = "train/"
SMOOTHED_TAG = "train_smoothed/"


def numeric_fields(df: DataFrame, ids: Sequence[str]) -> list[str]:
    """Columns that hold numbers; booleans are not numbers here."""
    return [
        field.name
        for field in df.schema.fields
        if field.name not in ids
        and isinstance(field.dataType, NumericType)
        and not isinstance(field.dataType, BooleanType)
    ]


def metrics_long(
    records: DataFrame, ids: Sequence[str] = ("run_id", "record_seq", "global_step")
) -> DataFrame:
    """One row per record and numeric metric: ids, name, value. Absent metrics give no row."""
    names = numeric_fields(records, ids)
    wide = records.select(*ids, *[F.col(name).cast("double").alias(name) for name in names])
    return wide.unpivot(list(ids), names, "name", "value").filter(F.col("value").isNotNull())


def smoothed_metrics(long: DataFrame, window: int, keys: Sequence[str] = ("run_id",)) -> DataFrame:
    """Add `position` and `smoothed`, the mean of the last `window` points of each metric.

    Counts points in the order they were recorded, not steps: after a resume steps may repeat.
    """
    series = [*keys, "name"]
    placed = ordinal(long, by_width("record_seq"), "position", series)
    return trailing(
        placed, series, "position", window, {"smoothed": lambda span: F.avg("value").over(span)}
    )


def monitored_value(
    records: DataFrame, smoothed: DataFrame, metric: str, keys: Sequence[str] = ("run_id",)
) -> DataFrame:
    """The value a monitor looks at: (keys, record_seq, global_step, chunk_id, value).

    The smoothed one where the metric has a series, else the raw column, which in practice is only
    the step itself.
    """
    if metric == "global_step":
        return records.select(
            *keys,
            "record_seq",
            "global_step",
            "chunk_id",
            F.col("global_step").cast("double").alias("value"),
        )
    ids = [*keys, "record_seq"]
    one = smoothed.filter(F.col("name") == F.lit(metric)).select(
        *ids, F.col("smoothed").alias("value")
    )
    return records.select(*ids, "global_step", "chunk_id").join(one, ids)


def scalar_series(smoothed: DataFrame, keys: Sequence[str] = ("run_id",)) -> DataFrame:
    """Raw and smoothed points under their tags."""
    tagged = F.array(
        F.struct(F.concat(F.lit(RAW_TAG), "name").alias("tag"), F.col("value").alias("value")),
        F.struct(
            F.concat(F.lit(SMOOTHED_TAG), "name").alias("tag"), F.col("smoothed").alias("value")
        ),
    )
    return smoothed.select(*keys, "record_seq", "global_step", F.inline(tagged))


def downsample_series(
    long: DataFrame, max_points: int, keys: Sequence[str] = ("run_id",)
) -> DataFrame:
    """Thin a series longer than `max_points` to every (n div max_points)-th point.

    The last point is added unless the last point kept has the same step and value.
    """
    if max_points <= 0:
        raise ValueError("max_points must be positive")
    series = [*keys, "name"]
    placed = ordinal(long, by_width("record_seq"), "position", series, size="points")
    stride = F.greatest(int_div(F.col("points"), max_points), F.lit(1).cast("bigint"))
    placed = placed.withColumn(
        "__stride", F.when(F.col("points") > max_points, stride).otherwise(F.lit(1).cast("bigint"))
    )
    final = F.col("points") - 1
    on_stride = F.col("position") % F.col("__stride") == 0
    last_kept = F.col("position") == final - final % F.col("__stride")
    point = F.struct(*[F.col(c) for c in long.columns if c not in series], F.col("position"))
    kept = placed.filter(on_stride)
    # One row per series: its last point and its last point on the stride.
    ends = (
        placed.filter(last_kept | (F.col("position") == final))
        .groupBy(*series)
        .agg(
            F.max(F.when(F.col("position") == final, point)).alias("__last"),
            F.max(F.when(last_kept, point)).alias("__kept"),
        )
    )
    differs = (
        (F.col("__last.global_step") != F.col("__kept.global_step"))
        | (F.col("__last.value") != F.col("__kept.value"))
        | F.isnan("__last.value")  # NaN equals nothing, itself included
    )
    moved = F.col("__last.position") != F.col("__kept.position")
    added = ends.filter(moved & differs).select(*series, "__last.*")
    columns = [*long.columns, "position"]
    return kept.select(*columns).unionByName(added.select(*columns))


def plot_series(
    long: DataFrame,
    metric_names: Sequence[str],
    max_points: int,
    keys: Sequence[str] = ("run_id",),
) -> DataFrame:
    """Down-sampled points of the named metrics, with an axis label."""
    chosen = long.filter(F.col("name").isin(list(metric_names)))
    return downsample_series(chosen, max_points, keys).withColumn("label", axis_label(F.col("name")))
