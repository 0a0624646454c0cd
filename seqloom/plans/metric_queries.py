"""Registered queries over training steps and metric logs, and the SQL each must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions.numeric import perplexity as perplexity_of
from seqloom.operators import intervals, monitors, series, summary
from seqloom.plans import fixtures as fx
from seqloom.session import new_folder, written
from seqloom.sources.metrics_log import append_metrics_log, load_metrics_log
from seqloom.streaming.metrics import interval_stream, monitor_stream

EVERY, WINDOW, STEPS = fx.EVERY, fx.WINDOW, fx.CHUNK_STEPS
MIN_DELTA = 0.02
WARMUP = 16
PATIENCE = 24
SAVE_THRESHOLD = 3.2
STOP_THRESHOLD = 3.0
EARLY_STOP_STEP = 60
MAX_STEPS = 75
MAX_POINTS = 4
SAVE_EVERY = 25


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def every_n_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = intervals.every_n_steps(fx.steps(spark, sf_dir), EVERY)
    return chosen.select("run_id", "global_step", "chunk_id", F.round("loss", 6).alias("loss"))


def _intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.interval_metrics(
        fx.steps(spark, sf_dir), EVERY, first_step_seconds=fx.FIRST_STEP_SECONDS
    )


def interval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _intervals(spark, sf_dir)
    return _rounded(found, "train_loss", "grad_norm", "elapsed")


def perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Also of a loss beyond the cap, and of one that is NaN."""
    found = _intervals(spark, sf_dir)
    return found.select(
        "run_id",
        "global_step",
        F.round(perplexity_of(F.col("train_loss")), 6).alias("perplexity"),
        F.round(perplexity_of(F.col("train_loss") * 100), 2).alias("capped"),
        F.isnan(perplexity_of(F.col("train_loss") * F.lit(float("nan")))).alias("stays_nan"),
    )


def throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = intervals.throughput(_intervals(spark, sf_dir))
    return _rounded(
        found.select("run_id", "global_step", "tokens_per_second", "samples_per_second"),
        "tokens_per_second",
        "samples_per_second",
    )


def running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = intervals.running_totals(fx.steps(spark, sf_dir))
    return found.select("run_id", "global_step", "tokens_seen", "samples_seen")


def metric_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = intervals.metric_records(
        fx.steps(spark, sf_dir), EVERY, first_step_seconds=fx.FIRST_STEP_SECONDS
    )
    return _rounded(
        found, "train_loss", "perplexity", "grad_norm", "tokens_per_second", "samples_per_second"
    )


def metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(series.metrics_long(fx.records(spark, sf_dir)), "value")


def _long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.metrics_long(fx.records(spark, sf_dir))


def smoothed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = series.smoothed_metrics(_long(spark, sf_dir), WINDOW)
    return _rounded(found.drop("position"), "value", "smoothed")


def _resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of runs that stopped inside their second chunk and read that chunk again.

    All records up to the stop, then the second chunk and what follows once more.
    """
    log = fx.records(spark, sf_dir)
    again = F.col("chunk_id") >= 1
    attempts = F.when(
        (F.col("chunk_id") == 1) & (F.col("global_step") <= 32), F.array(F.lit(0), F.lit(1))
    ).otherwise(F.when(again, F.array(F.lit(1))).otherwise(F.array(F.lit(0))))
    repeated = log.withColumn("attempt", F.explode(attempts))
    seq = F.col("attempt") * F.lit(1 << 32) + F.col("record_seq")
    return repeated.withColumn("record_seq", seq.cast("bigint")).drop("attempt")


def smoothed_after_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trailing means over a log with repeated steps: record order counts, not step order."""
    found = series.smoothed_metrics(series.metrics_long(_resumed(spark, sf_dir)), WINDOW)
    return _rounded(found.drop("position"), "value", "smoothed")


def best_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(monitors.best_events(fx.observed(spark, sf_dir)), "value")


def best_events_min_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(monitors.best_events(fx.observed(spark, sf_dir), min_delta=MIN_DELTA), "value")


def best_events_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = fx.observed(spark, sf_dir, "grad_norm")
    return _rounded(monitors.best_events(seen, "max", MIN_DELTA), "value")


def threshold_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = monitors.threshold_events(fx.observed(spark, sf_dir), SAVE_THRESHOLD, once=False)
    return _rounded(found, "value")


def threshold_events_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(monitors.threshold_events(fx.observed(spark, sf_dir), SAVE_THRESHOLD), "value")


def early_stop_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = monitors.early_stop_threshold(fx.observed(spark, sf_dir), STOP_THRESHOLD, warmup=WARMUP)
    return _rounded(found, "value")


def early_stop_patience(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = monitors.early_stop_patience(
        fx.observed(spark, sf_dir), PATIENCE, min_delta=MIN_DELTA, warmup=WARMUP
    )
    return _rounded(found, "value")


def fixed_step_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitors.fixed_step_stop(fx.steps(spark, sf_dir), EARLY_STOP_STEP, MAX_STEPS)


def _stops(spark: SparkSession, sf_dir: str, steps: DataFrame) -> DataFrame:
    return monitors.stop_reason(
        steps,
        fx.observed(spark, sf_dir),
        EVERY,
        EARLY_STOP_STEP,
        MAX_STEPS,
        STOP_THRESHOLD,
        PATIENCE,
        min_delta=MIN_DELTA,
        warmup=WARMUP,
    )


def stop_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stops(spark, sf_dir, written(fx.steps(spark, sf_dir), "steps"))


def downsample_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(series.downsample_series(_long(spark, sf_dir), MAX_POINTS), "value")


def scalar_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = series.scalar_series(series.smoothed_metrics(_long(spark, sf_dir), WINDOW))
    return _rounded(found, "value")


def plot_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["train_loss", "perplexity", "grad_norm"]
    found = series.plot_series(_long(spark, sf_dir), names, MAX_POINTS)
    return _rounded(found, "value").drop("position")


def _chunks(steps: DataFrame) -> DataFrame:
    """Complete chunks, with two documents per step."""
    expected = steps.select("run_id", "chunk_id").distinct().withColumn("expected_steps", F.lit(STEPS))
    return summary.completed_chunks(steps, expected).withColumn(
        "documents", F.col("chunk_steps") * 2
    )


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the steps each run took before it was stopped."""
    steps = written(fx.steps(spark, sf_dir), "steps")
    stops = written(_stops(spark, sf_dir, steps), "stops")
    limit = stops.select("run_id", F.col("global_step").alias("stop_step"))
    taken = steps.join(limit, "run_id").filter(F.col("global_step") <= F.col("stop_step"))
    found = summary.run_summary(taken, _chunks(taken), stops)
    return found.select(
        "run_id", "global_step", "tokens_seen", "samples_seen", "trained_documents", "stop_reason"
    )


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = written(fx.steps(spark, sf_dir), "steps")
    seen = fx.observed(spark, sf_dir)
    return summary.checkpoint_catalog(
        steps,
        monitors.best_events(seen, min_delta=MIN_DELTA),
        monitors.threshold_events(seen, SAVE_THRESHOLD),
        _chunks(steps),
        SAVE_EVERY,
        "train_loss",
    )


def checkpoint_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_catalog(spark, sf_dir), "monitored_value")


def latest_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(summary.latest_checkpoints(_catalog(spark, sf_dir)), "monitored_value")


def metrics_log_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append the log in two goes, as two sessions of a run would, and load it back."""
    path = new_folder(spark, "log")
    log = fx.records(spark, sf_dir)
    append_metrics_log(log.filter(F.col("chunk_id") == 0), path)
    append_metrics_log(log.filter(F.col("chunk_id") > 0), path)
    return _rounded(load_metrics_log(spark, path), "value")


def tolerant_metrics_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load a log in which every event left a good line or one of the usual bad ones."""
    kind = F.col("event_id") % 10
    step, value = F.col("event_id").cast("string"), F.round("value", 2).cast("string")
    start = F.concat(F.lit('{"run_id": '), F.col("user_id").cast("string"), F.lit(', "global_step": '))
    lines = [
        F.concat(start, step, F.lit(', "train_loss": '), value, F.lit(', "extra metric": 7}')),
        F.lit("   "),
        F.concat(start, step, F.lit(', "train_loss": ')),
        F.concat(start, step, F.lit('.0, "train_loss": '), value, F.lit("}")),
        F.concat(start, F.lit('true, "train_loss": '), value, F.lit("}")),
        F.concat(start, step, F.lit(', "train_loss": "'), value, F.lit('", "epoch": 3}')),
        F.concat(start, step, F.lit(', "done": true, "train_loss": null, "note": "NaN"}')),
        F.concat(start, step, F.lit(', "train_loss": NaN, "grad_norm": -Infinity, "epoch": 1}')),
        F.concat(start, F.lit('"'), step, F.lit('", "train_loss": '), value, F.lit("}")),
        F.concat(F.lit("["), value, F.lit("]")),
    ]
    line = lines[-1]
    for number in range(len(lines) - 1):
        line = F.when(kind == number, lines[number]).otherwise(line)
    path = new_folder(spark, "log")
    fx.table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    found = load_metrics_log(spark, path, ids=["run_id"])
    # NaN does not compare alike in all tools: show it as a word.
    word = F.when(F.isnan("value"), F.lit("nan")).when(
        F.col("value") == F.lit(float("-inf")), F.lit("-inf")
    ).otherwise(F.format_string("%.2f", "value"))
    return found.withColumn("value", word)


def stream_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interval records from a stream of steps that arrives in two parts."""
    source = new_folder(spark, "steps")
    steps = written(fx.steps(spark, sf_dir).drop("ts"), "steps")
    late = F.col("global_step") > 30
    steps.limit(0).write.parquet(source)
    rows = spark.readStream.schema(steps.schema).parquet(source)
    found = _drained(interval_stream(rows, EVERY), source, steps.filter(~late), steps.filter(late))
    return _rounded(found, "train_loss", "grad_norm")


def stream_monitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Smoothing and monitors from a stream of records that arrives in two parts."""
    source = new_folder(spark, "records")
    log = fx.records(spark, sf_dir).select(
        "run_id", "record_seq", "global_step", F.col("train_loss").alias("value")
    )
    late = F.col("record_seq") > 4
    log.limit(0).write.parquet(source)
    rows = spark.readStream.schema(log.schema).parquet(source)
    found = _drained(
        monitor_stream(
            rows,
            WINDOW,
            min_delta=MIN_DELTA,
            threshold=SAVE_THRESHOLD,
            stop_threshold=STOP_THRESHOLD,
            patience=PATIENCE,
            warmup=WARMUP,
        ),
        source,
        log.filter(~late),
        log.filter(late),
    )
    return _rounded(found, "value", "smoothed")


def _drained(stream: DataFrame, source: str, *parts: DataFrame) -> DataFrame:
    """Run a stream over parts that arrive in its source one after the other, and give what it wrote.

    A part is as many files as tasks wrote it, and one micro-batch; the next one goes on from the checkpoint.
    """
    spark = stream.sparkSession
    output, checkpoint = new_folder(spark, "stream"), new_folder(spark, "checkpoint")
    for part in parts:
        part.write.mode("append").parquet(source)
        query = (
            stream.writeStream.format("parquet")
            .option("path", output)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(output)


QUERIES = {
    "every_n_steps": every_n_steps,
    "interval_metrics": interval_metrics,
    "perplexity": perplexity,
    "throughput": throughput,
    "running_totals": running_totals,
    "metric_records": metric_records,
    "metrics_long": metrics_long,
    "smoothed_metrics": smoothed_metrics,
    "smoothed_after_resume": smoothed_after_resume,
    "best_events": best_events,
    "best_events_min_delta": best_events_min_delta,
    "best_events_max": best_events_max,
    "threshold_events": threshold_events,
    "threshold_events_once": threshold_events_once,
    "early_stop_threshold": early_stop_threshold,
    "early_stop_patience": early_stop_patience,
    "fixed_step_stop": fixed_step_stop,
    "stop_reason": stop_reason,
    "downsample_series": downsample_series,
    "scalar_series": scalar_series,
    "plot_series": plot_series,
    "run_summary": run_summary,
    "checkpoint_catalog": checkpoint_catalog,
    "latest_checkpoints": latest_checkpoints,
    "metrics_log_roundtrip": metrics_log_roundtrip,
    "load_metrics_log": tolerant_metrics_log,
    "stream_intervals": stream_intervals,
    "stream_monitors": stream_monitors,
}

# --- the same in DuckDB SQL -----------------------------------------------------------------

_STEPS = f"""placed AS (
  SELECT user_id AS run_id, event_id, ts, value,
         row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS position,
         count(*) OVER (PARTITION BY user_id) AS run_steps FROM events),
steps AS (
  SELECT run_id, position + 1 AS global_step, position // {STEPS} AS chunk_id,
         (position % {STEPS}) // {STEPS // 2} + 1 AS epoch, ln(value + 1) AS loss, sqrt(value) AS grad_norm,
         0.0002::DOUBLE AS learning_rate, event_id % 64 + 64 AS tokens, {fx.BATCH} AS samples, ts
  FROM placed)"""
_INTERVALS = f"""{_STEPS},
grouped AS (
  SELECT run_id, chunk_id, ceil(global_step / {EVERY})::BIGINT AS interval_id,
         max(global_step) AS global_step, arg_max(epoch, global_step) AS epoch,
         count(*) AS interval_steps, avg(loss) AS train_loss, avg(grad_norm) AS grad_norm,
         any_value(learning_rate) AS learning_rate, sum(tokens)::BIGINT AS tokens,
         sum(samples)::BIGINT AS samples, min(ts) AS first_ts, max(ts) AS last_ts
  FROM steps GROUP BY ALL),
intervals AS (
  SELECT *, (epoch_us(last_ts) - epoch_us(coalesce(lag(last_ts) OVER (PARTITION BY run_id, chunk_id
              ORDER BY interval_id), first_ts - INTERVAL {fx.FIRST_STEP_SECONDS:.0f} SECOND))) / 1e6 AS elapsed
  FROM grouped)"""
_RECORDS = f"""{_INTERVALS},
records AS (
  SELECT run_id, row_number() OVER w - 1 AS record_seq, global_step, chunk_id, epoch, train_loss,
         exp(least(train_loss, 20)) AS perplexity, grad_norm, learning_rate,
         tokens / greatest(elapsed, 1e-9) AS tokens_per_second,
         samples / greatest(elapsed, 1e-9) AS samples_per_second,
         (sum(tokens) OVER w)::BIGINT AS tokens_seen, (sum(samples) OVER w)::BIGINT AS samples_seen
  FROM intervals WINDOW w AS (PARTITION BY run_id ORDER BY global_step))"""
_MELT = """SELECT run_id, record_seq, global_step, name, value FROM (
  SELECT run_id, record_seq, global_step, COLUMNS(* EXCLUDE (run_id, record_seq, global_step))::DOUBLE
  FROM {source}) UNPIVOT (value FOR name IN (COLUMNS(* EXCLUDE (run_id, record_seq, global_step))))"""
_LONG = f"""{_RECORDS}, long AS ({_MELT.format(source="records")})"""
_SPAN = f"ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW"
_SMOOTHED = f"""SELECT *, avg(value) OVER (PARTITION BY run_id, name ORDER BY record_seq {_SPAN}) AS smoothed
  FROM long"""


def _observed(metric: str = "train_loss") -> str:
    return f"""{_RECORDS},
observed AS (
  SELECT run_id, record_seq, global_step, chunk_id,
         avg({metric}) OVER (PARTITION BY run_id ORDER BY record_seq {_SPAN}) AS value
  FROM records)"""


def _fold(source: str, name: str, delta: float, sign: int = 1) -> str:
    """Best-so-far row by row, as a recursive query."""
    return f"""RECURSIVE {source},
{name}_rows AS (
  SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY record_seq) AS k FROM {name}),
{name}_fold AS (
  SELECT *, true AS better, value AS best, global_step AS best_step FROM {name}_rows WHERE k = 1
  UNION ALL
  SELECT r.*, {sign} * r.value < {sign} * f.best - {delta},
         CASE WHEN {sign} * r.value < {sign} * f.best - {delta} THEN r.value ELSE f.best END,
         CASE WHEN {sign} * r.value < {sign} * f.best - {delta} THEN r.global_step ELSE f.best_step END
  FROM {name}_fold f JOIN {name}_rows r ON r.run_id = f.run_id AND r.k = f.k + 1)"""


_POINT = "run_id, record_seq, global_step, chunk_id, round(value, 6) AS value"
_WARM = f"{_observed()}, warm AS (SELECT * FROM observed WHERE global_step >= {WARMUP})"
_WARM_FOLD = _fold(_WARM, "warm", MIN_DELTA)
_HITS = f"SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY record_seq) AS hit FROM"
_FIXED = f"""SELECT run_id, min(global_step) AS global_step,
  'early_stop_step' AS stop_reason FROM steps WHERE global_step >= {EARLY_STOP_STEP} GROUP BY run_id
  UNION ALL SELECT run_id, min(global_step), 'max_steps' FROM steps
  WHERE global_step >= {MAX_STEPS} GROUP BY run_id"""
_STOPS = f"""{_WARM_FOLD},
candidates AS (
  SELECT run_id, global_step, 'metric_threshold' AS stop_reason,
         CASE WHEN global_step % {EVERY} = 0 THEN 1 ELSE 5 END AS priority
  FROM warm WHERE value <= {STOP_THRESHOLD}
  UNION ALL SELECT run_id, global_step, 'metric_patience',
         CASE WHEN global_step % {EVERY} = 0 THEN 2 ELSE 6 END
  FROM warm_fold WHERE global_step - best_step >= {PATIENCE}
  UNION ALL SELECT run_id, global_step, stop_reason,
         CASE stop_reason WHEN 'early_stop_step' THEN 3 ELSE 4 END FROM ({_FIXED})
  UNION ALL SELECT run_id, max(global_step), 'dataset_exhausted', 9 FROM steps GROUP BY run_id),
stops AS (
  SELECT run_id, global_step, stop_reason FROM (
    SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY global_step, priority) AS k
    FROM candidates) WHERE k = 1)"""
_THINNED = f"""SELECT run_id, name, record_seq, global_step, value, position FROM (
  SELECT *, CASE WHEN n > {MAX_POINTS} THEN n // {MAX_POINTS} ELSE 1 END AS stride FROM (
    SELECT *, row_number() OVER (PARTITION BY run_id, name ORDER BY record_seq) - 1 AS position,
           count(*) OVER (PARTITION BY run_id, name) AS n FROM long)) AS o
  WHERE position % stride = 0
     OR (position = n - 1 AND NOT EXISTS (
           SELECT 1 FROM long AS k WHERE k.run_id = o.run_id AND k.name = o.name
             AND k.record_seq = o.record_seq - (o.n - 1) % o.stride
             AND k.global_step = o.global_step AND k.value = o.value))"""
_CATALOG = f"""WITH {_fold(_observed(), "observed", MIN_DELTA)},
catalog AS (
  SELECT run_id, 'periodic' AS category, printf('checkpoint-step-%08d.pt', global_step) AS checkpoint_name,
         global_step, chunk_id, NULL AS monitored_metric, NULL::DOUBLE AS monitored_value
  FROM steps WHERE global_step % {SAVE_EVERY} = 0
  UNION ALL SELECT run_id, 'best', 'best-train_loss.pt', global_step, chunk_id, 'train_loss', value
  FROM observed_fold WHERE better
  UNION ALL SELECT run_id, 'threshold', printf('train_loss-step-%08d.pt', global_step), global_step,
         chunk_id, 'train_loss', value
  FROM ({_HITS} observed WHERE value <= {SAVE_THRESHOLD}) WHERE hit = 1
  UNION ALL SELECT run_id, 'chunk', printf('checkpoint-chunk-%06d.pt', chunk_id), max(global_step),
         chunk_id, NULL, NULL FROM steps GROUP BY run_id, chunk_id HAVING count(*) >= {STEPS}
  UNION ALL SELECT run_id, 'final', 'final_checkpoint.pt', max(global_step), max(chunk_id), NULL, NULL
  FROM steps GROUP BY run_id)"""

ORACLES = {
    "every_n_steps": f"""WITH {_STEPS} SELECT run_id, global_step, chunk_id, round(loss, 6) AS loss
        FROM steps WHERE global_step % {EVERY} = 0""",
    "interval_metrics": f"""WITH {_INTERVALS}
        SELECT run_id, chunk_id, global_step, epoch, interval_steps, round(train_loss, 6) AS train_loss,
               round(grad_norm, 6) AS grad_norm, learning_rate, tokens, samples,
               round(elapsed, 6) AS elapsed FROM intervals""",
    "perplexity": f"""WITH {_INTERVALS}
        SELECT run_id, global_step, round(exp(least(train_loss, 20)), 6) AS perplexity,
               round(exp(least(train_loss * 100, 20)), 2) AS capped, true AS stays_nan FROM intervals""",
    "throughput": f"""WITH {_RECORDS}
        SELECT run_id, global_step, round(tokens_per_second, 6) AS tokens_per_second,
               round(samples_per_second, 6) AS samples_per_second FROM records""",
    "running_totals": f"""WITH {_STEPS}
        SELECT run_id, global_step, (sum(tokens) OVER w)::BIGINT AS tokens_seen,
               (sum(samples) OVER w)::BIGINT AS samples_seen
        FROM steps WINDOW w AS (PARTITION BY run_id ORDER BY global_step)""",
    "metric_records": f"""WITH {_RECORDS}
        SELECT * REPLACE (round(train_loss, 6) AS train_loss, round(perplexity, 6) AS perplexity,
               round(grad_norm, 6) AS grad_norm, round(tokens_per_second, 6) AS tokens_per_second,
               round(samples_per_second, 6) AS samples_per_second) FROM records""",
    "metrics_long": f"WITH {_LONG} SELECT * REPLACE (round(value, 6) AS value) FROM long",
    "smoothed_metrics": f"""WITH {_LONG}
        SELECT * REPLACE (round(value, 6) AS value, round(smoothed, 6) AS smoothed)
        FROM ({_SMOOTHED})""",
    "smoothed_after_resume": f"""WITH {_RECORDS},
        again AS (
          SELECT * FROM records WHERE chunk_id = 0 OR (chunk_id = 1 AND global_step <= 32)
          UNION ALL SELECT * REPLACE (record_seq + 4294967296 AS record_seq) FROM records
          WHERE chunk_id >= 1),
        long AS ({_MELT.format(source="again")})
        SELECT * REPLACE (round(value, 6) AS value, round(smoothed, 6) AS smoothed)
        FROM ({_SMOOTHED})""",
    "best_events": f"""WITH {_observed()}
        SELECT {_POINT} FROM (
          SELECT *, min(value) OVER (PARTITION BY run_id ORDER BY record_seq
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM observed)
        WHERE best IS NULL OR value < best""",
    "best_events_min_delta": f"""WITH {_fold(_observed(), "observed", MIN_DELTA)}
        SELECT {_POINT} FROM observed_fold WHERE better""",
    "best_events_max": f"""WITH {_fold(_observed("grad_norm"), "observed", MIN_DELTA, -1)}
        SELECT {_POINT} FROM observed_fold WHERE better""",
    "threshold_events": f"""WITH {_observed()}
        SELECT {_POINT} FROM observed WHERE value <= {SAVE_THRESHOLD}""",
    "threshold_events_once": f"""WITH {_observed()}
        SELECT {_POINT} FROM ({_HITS} observed WHERE value <= {SAVE_THRESHOLD}) WHERE hit = 1""",
    "early_stop_threshold": f"""WITH {_WARM}
        SELECT {_POINT} FROM ({_HITS} warm WHERE value <= {STOP_THRESHOLD}) WHERE hit = 1""",
    "early_stop_patience": f"""WITH {_WARM_FOLD}
        SELECT {_POINT}, best_step
        FROM ({_HITS} warm_fold WHERE global_step - best_step >= {PATIENCE}) WHERE hit = 1""",
    "fixed_step_stop": f"""WITH {_STEPS}, f AS ({_FIXED})
        SELECT run_id, f.global_step, chunk_id, stop_reason FROM (
          SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY global_step, stop_reason) AS k FROM f
        ) f JOIN steps USING (run_id, global_step) WHERE k = 1""",
    "stop_reason": f"WITH {_STOPS} SELECT * FROM stops",
    "downsample_series": f"""WITH {_LONG}
        SELECT * REPLACE (round(value, 6) AS value) FROM ({_THINNED})""",
    "scalar_series": f"""WITH {_LONG}, s AS ({_SMOOTHED})
        SELECT run_id, record_seq, global_step, 'train/' || name AS tag, round(value, 6) AS value FROM s
        UNION ALL SELECT run_id, record_seq, global_step, 'train_smoothed/' || name,
               round(smoothed, 6) FROM s""",
    "plot_series": f"""WITH {_LONG}
        SELECT run_id, name, record_seq, global_step, round(value, 6) AS value,
               CASE name WHEN 'train_loss' THEN 'Train Loss' WHEN 'grad_norm' THEN 'Grad Norm'
                         ELSE 'Perplexity' END AS label
        FROM ({_THINNED}) WHERE name IN ('train_loss', 'perplexity', 'grad_norm')""",
    "run_summary": f"""WITH {_STOPS},
        taken AS (SELECT s.* FROM steps s JOIN stops t ON s.run_id = t.run_id
                  AND s.global_step <= t.global_step),
        chunks AS (SELECT run_id, count(*) * 2 AS documents FROM taken GROUP BY run_id, chunk_id
                   HAVING count(*) >= {STEPS}),
        done AS (SELECT run_id, sum(documents)::BIGINT AS documents FROM chunks GROUP BY run_id)
        SELECT t.run_id, max(t.global_step) AS global_step, sum(tokens)::BIGINT AS tokens_seen,
               sum(samples)::BIGINT AS samples_seen,
               coalesce(any_value(documents), 0) AS trained_documents,
               any_value(stop_reason) AS stop_reason
        FROM taken t JOIN stops USING (run_id) LEFT JOIN done USING (run_id) GROUP BY t.run_id""",
    "checkpoint_catalog": f"""{_CATALOG}
        SELECT * REPLACE (round(monitored_value, 6) AS monitored_value) FROM catalog""",
    "latest_checkpoints": f"""{_CATALOG}
        SELECT * EXCLUDE (k) REPLACE (round(monitored_value, 6) AS monitored_value) FROM (
          SELECT *, row_number() OVER (PARTITION BY run_id, category, checkpoint_name
                                       ORDER BY global_step DESC) AS k FROM catalog) WHERE k = 1""",
    "metrics_log_roundtrip": f"WITH {_LONG} SELECT * REPLACE (round(value, 6) AS value) FROM long",
    "load_metrics_log": """WITH e AS (
          SELECT user_id AS run_id, event_id AS global_step, event_id % 10 AS kind,
                 printf('%.2f', value) AS v FROM events)
        SELECT run_id, global_step, 'train_loss' AS name, v AS value FROM e WHERE kind = 0
        UNION ALL SELECT run_id, global_step, 'extra metric', '7.00' FROM e WHERE kind = 0
        UNION ALL SELECT run_id, global_step, 'epoch', '3.00' FROM e WHERE kind = 5
        UNION ALL SELECT run_id, global_step, 'train_loss', 'nan' FROM e WHERE kind = 7
        UNION ALL SELECT run_id, global_step, 'grad_norm', '-inf' FROM e WHERE kind = 7
        UNION ALL SELECT run_id, global_step, 'epoch', '1.00' FROM e WHERE kind = 7""",
    "stream_intervals": f"""WITH {_INTERVALS}
        SELECT run_id, chunk_id, global_step, interval_steps, round(train_loss, 6) AS train_loss,
               round(grad_norm, 6) AS grad_norm, tokens, samples,
               (sum(tokens) OVER w)::BIGINT AS tokens_seen, (sum(samples) OVER w)::BIGINT AS samples_seen
        FROM intervals WINDOW w AS (PARTITION BY run_id ORDER BY global_step)""",
    "stream_monitors": f"""WITH {_fold(_WARM, "observed", MIN_DELTA)},
        warm_rows AS (
          SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY record_seq) AS k FROM warm),
        warm_fold AS (
          SELECT *, value AS best, global_step AS best_step FROM warm_rows WHERE k = 1
          UNION ALL
          SELECT r.*, CASE WHEN r.value < f.best - {MIN_DELTA} THEN r.value ELSE f.best END,
                 CASE WHEN r.value < f.best - {MIN_DELTA} THEN r.global_step ELSE f.best_step END
          FROM warm_fold f JOIN warm_rows r ON r.run_id = f.run_id AND r.k = f.k + 1),
        hits AS (SELECT run_id, min(record_seq) AS hit FROM observed
                 WHERE value <= {SAVE_THRESHOLD} GROUP BY run_id)
        SELECT o.run_id, o.record_seq, o.global_step, round(r.train_loss, 6) AS value,
               round(o.value, 6) AS smoothed, o.better AS is_best,
               coalesce(o.record_seq = h.hit, false) AS reaches_threshold,
               CASE WHEN w.run_id IS NULL THEN '' WHEN w.value <= {STOP_THRESHOLD} THEN 'metric_threshold'
                    WHEN w.global_step - w.best_step >= {PATIENCE} THEN 'metric_patience'
                    ELSE '' END AS stop_reason
        FROM observed_fold o JOIN records r USING (run_id, record_seq) LEFT JOIN hits h USING (run_id)
        LEFT JOIN warm_fold w ON w.run_id = o.run_id AND w.record_seq = o.record_seq""",
}
