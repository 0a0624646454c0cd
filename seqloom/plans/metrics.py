"""A whole metric analysis: from training steps to log, monitors, stops, catalogue and series."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.operators import intervals, monitors, series, summary
from seqloom.options import RunOptions
from seqloom.session import written
from seqloom.sources.metrics_log import append_metrics_log
from seqloom.sources.progress import save_json


@dataclass(frozen=True)
class MetricAnalysis:
    """The tables of an analysis, all lazy but the log, which is written once."""

    records: DataFrame
    smoothed: DataFrame
    best: DataFrame
    thresholds: DataFrame
    stops: DataFrame
    plots: DataFrame
    taken: DataFrame


def analyse_steps(
    steps: DataFrame, options: RunOptions, at_end: str | Column = monitors.DATASET_EXHAUSTED
) -> MetricAnalysis:
    """What a run's options make of its steps; `at_end` is why a run ends that nothing stops.

    Nothing is logged after a run has stopped, and the record of the stopping step covers what ran
    of its interval: the steps are cut at the stop before they are logged.
    """
    every = options.metrics_every_steps
    whole = written(intervals.metric_records(steps, every), "records")
    stops = written(
        monitors.stop_reason(
            steps,
            _watched(whole, options, options.early_stop_metric),
            every,
            options.early_stop_step,
            options.max_steps,
            options.early_stop_threshold,
            options.early_stop_patience_steps,
            options.early_stop_mode,
            options.early_stop_min_delta,
            options.early_stop_warmup_steps,
            at_end,
        ),
        "stops",
    )
    last = stops.select("run_id", F.col("global_step").alias("__last"))
    taken = steps.join(last, "run_id").filter(F.col("global_step") <= F.col("__last")).drop("__last")
    records = written(intervals.metric_records(taken, every), "records")
    long = series.metrics_long(records)
    best = monitors.best_events(
        _watched(records, options, options.best_checkpoint_metric),
        options.best_checkpoint_mode,
        options.best_checkpoint_min_delta,
    )
    seen = _watched(records, options, options.threshold_checkpoint_metric)
    if options.save_threshold_checkpoint:
        hits = monitors.threshold_events(
            seen,
            options.threshold_checkpoint_value,
            options.threshold_checkpoint_mode,
            options.threshold_checkpoint_once,
        )
    else:
        hits = seen.filter(F.lit(False))
    return MetricAnalysis(
        records,
        series.smoothed_metrics(long, options.metric_smoothing_window),
        best if options.save_best_checkpoint else best.filter(F.lit(False)),
        hits,
        stops,
        series.plot_series(long, options.plot_metric_names, options.max_plot_points),
        taken,
    )


def _watched(records: DataFrame, options: RunOptions, metric: str) -> DataFrame:
    """The monitored value; only that metric is melted and smoothed. Unknown names give no rows."""
    if metric != "global_step" and metric not in records.columns:
        shape = records.select("run_id", "record_seq", "global_step", "chunk_id")
        return shape.withColumn("value", F.lit(None).cast("double")).filter(F.lit(False))
    ids = ["run_id", "record_seq", "global_step"]
    columns = ids if metric == "global_step" else [*ids, metric]
    long = series.metrics_long(records.select(*columns)) if metric != "global_step" else None
    smoothed = series.smoothed_metrics(long, options.metric_smoothing_window) if long else records
    return series.monitored_value(records, smoothed, metric)


def checkpoints(analysis: MetricAnalysis, options: RunOptions, chunks: DataFrame) -> DataFrame:
    """The catalogue of checkpoints; `chunks` are the completed ones."""
    found = summary.checkpoint_catalog(
        analysis.taken,
        analysis.best,
        analysis.thresholds,
        chunks,
        options.save_every_steps,
        options.threshold_checkpoint_metric,
        best_metric=options.best_checkpoint_metric,
    )
    return found if options.save_each_chunk else found.filter(F.col("category") != "chunk")


def save_analysis(analysis: MetricAnalysis, options: RunOptions, summary_rows: DataFrame) -> None:
    """Write what a run leaves behind below `output_dir`: options, log, series, summary."""
    spark, out = analysis.records.sparkSession, options.output_dir
    values = [(name, None if value is None else str(value)) for name, value in options.to_dict().items()]
    save_json(spark.createDataFrame(values, "name string, value string"), f"{out}/run_config")
    if options.jsonl_metrics:
        append_metrics_log(analysis.records, f"{out}/metrics")
    if options.tensorboard:
        series.scalar_series(analysis.smoothed).write.mode("overwrite").parquet(f"{out}/scalars")
    if options.save_plots:
        analysis.plots.write.mode("overwrite").parquet(f"{out}/plots")
    save_json(summary_rows, f"{out}/train_summary")
