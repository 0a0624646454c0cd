import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

import naive
from seqloom.functions.numeric import perplexity, reaches
from seqloom.functions.text import axis_label, file_safe
from seqloom.operators import intervals, monitors, series, summary
from seqloom.operators.ordered import BUCKET, by_value

OBSERVED = "run_id long, record_seq long, global_step long, chunk_id long, value double"
NAN = math.nan


def random_runs(seed, runs=40, longest=60, nan=0.1):
    """{run: [(seq, step, value)]}, some falling, some noisy, some with NaN, some starting so."""
    rng = random.Random(seed)
    out = {}
    for run in range(runs):
        slope = rng.choice([0.0, 0.02, 0.2])
        step, rows = 0, []
        for seq in range(rng.randint(1, longest)):
            step += rng.randint(1, 5)
            value = 5.0 - slope * seq + rng.choice([0.05, 0.5]) * rng.random()
            if run % 3 == 0 and rng.random() < nan or (run % 7 == 0 and seq == 0):
                value = NAN
            rows.append((3 * seq, step, value))
        out[run] = rows
    return out


def as_table(spark, runs):
    rows = [(run, seq, step, step // 20, value) for run, points in runs.items() for seq, step, value in points]
    random.Random(0).shuffle(rows)
    return spark.createDataFrame(rows, OBSERVED).repartition(5)


def by_run(rows, *columns):
    out = {}
    for r in sorted(rows, key=lambda r: r["record_seq"]):
        out.setdefault(r["run_id"], []).append(r[columns[0]] if len(columns) == 1 else tuple(r[c] for c in columns))
    return out


@pytest.mark.parametrize(
    "mode,delta", [("min", 0.0), ("max", 0.0), ("min", 0.1), ("min", 0.6), ("max", 0.15)]
)
def test_best_events_equal_the_fold(spark, small_buckets, mode, delta):
    runs = random_runs(int(100 * delta) + len(mode))
    rows = monitors.best_events(as_table(spark, runs), mode, delta).collect()
    found = by_run(rows, "record_seq")
    assert found == {run: naive.best(rows, mode, delta) for run, rows in runs.items()}
    values = {(run, seq): str(value) for run, points in runs.items() for seq, _, value in points}
    assert all(str(r["value"]) == values[r["run_id"], r["record_seq"]] for r in rows)


def test_a_long_falling_run_is_native_and_spread(spark):
    """One key whose every value is a low, next to short ones."""
    runs = {1: [(i, i, 1000 - i * 0.25) for i in range(700)], 2: [(0, 1, 3.0), (1, 2, 1.0)], 3: [(0, 1, 5.0)]}
    runs[4] = [(0, 1, math.inf), (1, 2, 7.0), (2, 3, 6.5), (3, 4, -math.inf)]
    events = monitors.best_events(as_table(spark, runs), "min", 0.6)
    assert by_run(events.collect(), "record_seq") == {run: naive.best(rows, "min", 0.6) for run, rows in runs.items()}
    plan = events._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    lows = as_table(spark, runs).withColumn("__x", F.col("value")).where("run_id = 1")
    buckets = by_value(lows, "__x").add_bucket(lows)
    assert buckets.select(BUCKET).distinct().count() >= 16


@pytest.mark.parametrize(
    "mode,delta,warmup,threshold,patience",
    [
        ("min", 0.0, 0, 4.0, 12),
        ("min", 0.15, 20, 3.0, 25),
        ("min", 0.2, 40, None, 30),
        ("max", 0.1, 10, 5.3, 20),
        ("max", 0.0, 0, 5.2, 0),
    ],
)
def test_metric_stops_equal_the_loop(spark, small_buckets, mode, delta, warmup, threshold, patience):
    runs = random_runs(patience + warmup)
    table = as_table(spark, runs)
    stops = {}
    if threshold is not None:
        for r in monitors.early_stop_threshold(table, threshold, mode, warmup).collect():
            stops.setdefault(r["run_id"], []).append((r["record_seq"], 0, "metric_threshold"))
    for r in monitors.early_stop_patience(table, patience, mode, delta, warmup).collect():
        stops.setdefault(r["run_id"], []).append((r["record_seq"], 1, "metric_patience"))
    expected = {
        run: naive.early_stop(rows, mode, delta, warmup, threshold, patience) for run, rows in runs.items()
    }
    found = {run: (min(stops[run])[0], min(stops[run])[2]) if run in stops else None for run in runs}
    assert found == expected
    assert any(expected.values())


def test_thresholds_once_and_always(spark):
    runs = random_runs(8)
    table = as_table(spark, runs)
    always = by_run(monitors.threshold_events(table, 4.2, once=False).collect(), "record_seq")
    expected = {run: [s for s, _, v in rows if v <= 4.2] for run, rows in runs.items()}
    assert always == {run: seqs for run, seqs in expected.items() if seqs}
    once = by_run(monitors.threshold_events(table, 4.2).collect(), "record_seq")
    assert once == {run: seqs[:1] for run, seqs in expected.items() if seqs}


def test_fixed_steps(spark):
    rows = [(1, s, 0) for s in range(1, 30)] + [(2, s, 0) for s in range(1, 12)] + [(3, s, 0) for s in (4, 5)]
    steps = spark.createDataFrame(rows, "run_id long, global_step long, chunk_id long")

    def found(*limits):
        return {r["run_id"]: (r["global_step"], r["stop_reason"]) for r in monitors.fixed_step_stop(steps, *limits).collect()}

    assert found(10, 20) == {1: (10, "early_stop_step"), 2: (10, "early_stop_step")}
    assert found(20, 10) == {1: (10, "max_steps"), 2: (10, "max_steps")}
    assert found(10, 10) == {1: (10, "early_stop_step"), 2: (10, "early_stop_step")}
    assert found(0, 0) == {}
    # a run that resumes beyond the limit stops with its first step
    assert found(0, 3)[3] == (4, "max_steps")


def simulate(losses, every, chunk, window, early, most, mode, delta, warmup, threshold, patience):
    """Step by step: log, test the metric rules on records, test the limits, until something stops."""
    gathered, logged, recent = [], [], []

    def record(step):
        recent.append(sum(gathered) / len(gathered))
        gathered.clear()
        logged.append((len(logged), step, naive.smoothed(recent, window)[-1]))
        stop = naive.early_stop(logged, mode, delta, warmup, threshold, patience)
        return stop[1] if stop and stop[0] == logged[-1][0] else None

    for step, loss in enumerate(losses, 1):
        gathered.append(loss)
        reason = record(step) if step % every == 0 else None
        if reason is None and early and step >= early:
            reason = "early_stop_step"
        if reason is None and most and step >= most:
            reason = "max_steps"
        if (reason or step % chunk == 0 or step == len(losses)) and gathered:
            remainder = record(step)
            reason = reason or remainder
        if reason:
            return step, reason
    return len(losses), "dataset_exhausted"


@pytest.mark.parametrize(
    "every,early,most,threshold,patience,warmup",
    [(4, 0, 0, 1.2, 0, 0), (4, 33, 41, 1.0, 14, 8), (5, 40, 27, None, 11, 12), (7, 20, 20, 1.6, 9, 0), (3, 0, 0, None, 0, 0)],
)
def test_stop_reason_equals_the_loop(spark, small_buckets, every, early, most, threshold, patience, warmup):
    rng = random.Random(every)
    runs = {run: [3 * math.exp(-0.02 * i) + rng.random() for i in range(rng.randint(1, 70))] for run in range(60)}
    start = datetime.datetime(2024, 1, 1)
    rows = [
        (run, s, (s - 1) // 10, 1, loss, 1.0, 0.1, 5, 2, start + datetime.timedelta(seconds=s))
        for run, losses in runs.items()
        for s, loss in enumerate(losses, 1)
    ]
    steps = spark.createDataFrame(
        rows,
        "run_id long, global_step long, chunk_id long, epoch long, loss double, grad_norm double, "
        "learning_rate double, tokens long, samples long, ts timestamp_ntz",
    )
    log = intervals.metric_records(steps, every)
    assert by_run(log.collect(), "global_step") == {
        run: [s for s, _ in naive.records(losses, every, 10)] for run, losses in runs.items()
    }
    one = series.metrics_long(log.select("run_id", "record_seq", "global_step", "train_loss"))
    seen = series.monitored_value(log, series.smoothed_metrics(one, 3), "train_loss")
    found = monitors.stop_reason(
        steps, seen, every, early, most, threshold, patience, min_delta=0.05, warmup=warmup
    )
    assert {r["run_id"]: (r["global_step"], r["stop_reason"]) for r in found.collect()} == {
        run: simulate(losses, every, 10, 3, early, most, "min", 0.05, warmup, threshold, patience)
        for run, losses in runs.items()
    }


def test_each_run_ends_for_its_own_reason(spark):
    rows = [(run, s, 0, why if s == 4 else "early") for run, why in ((1, "total_documents"), (2, None), (3, "early")) for s in range(1, 5)]
    steps = spark.createDataFrame(rows, "run_id long, global_step long, chunk_id long, why string")
    seen = spark.createDataFrame([], "run_id long, record_seq long, global_step long, value double, finite boolean")
    found = monitors.stop_reason(steps, seen, 2, at_end=F.col("why")).collect()
    assert sorted((r["run_id"], r["global_step"], r["stop_reason"]) for r in found) == [
        (1, 4, "total_documents"), (2, 4, "dataset_exhausted"), (3, 4, "early"),
    ]
    found = monitors.stop_reason(steps, seen, 2, max_steps=3, at_end=F.col("why")).collect()
    assert {(r["global_step"], r["stop_reason"]) for r in found} == {(3, "max_steps")}


def test_interval_sums_and_times(spark):
    start = datetime.datetime(2024, 3, 31, 1, 59, 50)
    rows = [
        (1, s, (s - 1) // 5, (s - 1) % 5 // 3 + 1, float(s), 2.0 * s, 0.1, 10 * s, 4, start + datetime.timedelta(seconds=s * s))
        for s in range(1, 9)
    ]
    steps = spark.createDataFrame(
        rows,
        "run_id long, global_step long, chunk_id long, epoch long, loss double, grad_norm double, "
        "learning_rate double, tokens long, samples long, ts timestamp_ntz",
    )
    found = intervals.interval_metrics(steps, 3, first_step_seconds=0.5).orderBy("global_step").collect()
    assert [(r["global_step"], r["chunk_id"], r["epoch"], r["interval_steps"]) for r in found] == [
        (3, 0, 1, 3), (5, 0, 2, 2), (6, 1, 1, 1), (8, 1, 1, 2),
    ]
    assert [r["train_loss"] for r in found] == [2.0, 4.5, 6.0, 7.5]
    assert [r["tokens"] for r in found] == [60, 90, 60, 150]
    assert [r["elapsed"] for r in found] == [8.5, 16.0, 0.5, 28.0]
    rates = intervals.throughput(spark.createDataFrame([(10, 2, 0.0)], "tokens long, samples long, elapsed double"))
    assert rates.first()["tokens_per_second"] == pytest.approx(10 / 1e-9)


def test_perplexity_cap_and_nan(spark):
    rows = spark.createDataFrame([(1.0,), (20.0,), (50.0,), (NAN,)], "x double")
    found = [r[0] for r in rows.select(perplexity(F.col("x"))).collect()]
    assert found[:3] == pytest.approx([math.e, math.exp(20), math.exp(20)]) and math.isnan(found[3])
    hits = rows.select(reaches(F.col("x"), 20.0, "max")).collect()
    assert [r[0] for r in hits] == [False, True, True, False]


def test_every_n_steps(spark):
    rows = spark.range(1, 11).withColumnRenamed("id", "global_step")
    assert [r[0] for r in intervals.every_n_steps(rows, 4).collect()] == [4, 8]
    assert intervals.every_n_steps(rows, 0).count() == 0
    with pytest.raises(ValueError):
        intervals.interval_metrics(rows, 0)


def test_melt_takes_numbers_only(spark):
    rows = spark.createDataFrame(
        [(1, 0, 5, 2.5, True, "x", 7, None)],
        "run_id long, record_seq long, global_step long, loss double, flag boolean, note string, n int, gpu double",
    )
    found = series.metrics_long(rows).collect()
    assert sorted((r["name"], r["value"]) for r in found) == [("loss", 2.5), ("n", 7.0)]


def test_trailing_mean_in_small_buckets(spark, small_buckets):
    """Record order counts, steps repeat, an optional metric has gaps, NaN leaves with its row."""
    rng = random.Random(4)
    rows, expected = [], {}
    for run in range(6):
        for name in ("a", "b"):
            values = [(seq, seq % 13, rng.random()) for seq in range(0, 300, rng.choice([1, 7])) if name == "a" or rng.random() < 0.4]
            if run == 0 and name == "a":
                values[20] = (values[20][0], values[20][1], NAN)
            rows += [(run, seq, step, name, v) for seq, step, v in values]
            expected[run, name] = naive.smoothed([v for _, _, v in values], 8)
    long = spark.createDataFrame(rows, "run_id long, record_seq long, global_step long, name string, value double")
    found = {}
    for r in sorted(series.smoothed_metrics(long, 8).collect(), key=lambda r: r["record_seq"]):
        found.setdefault((r["run_id"], r["name"]), []).append(r["smoothed"])
    assert found.keys() == expected.keys()
    for key in found:
        assert found[key] == pytest.approx(expected[key], nan_ok=True)


def test_monitored_value_falls_back_to_the_step(spark):
    records = spark.createDataFrame([(1, 0, 5, 0)], "run_id long, record_seq long, global_step long, chunk_id long")
    long = spark.createDataFrame([], "run_id long, record_seq long, global_step long, name string, value double")
    smoothed = series.smoothed_metrics(long, 3)
    assert series.monitored_value(records, smoothed, "global_step").first()["value"] == 5.0
    assert series.monitored_value(records, smoothed, "gpu_peak").count() == 0


@pytest.mark.parametrize("most", [1, 3, 4, 7, 50])
def test_thinning_equals_definition(spark, small_buckets, most):
    rng = random.Random(most)
    rows, expected = [], {}
    for run in range(25):
        points = [(s, float(rng.randint(0, 2))) for s in range(rng.randint(1, 40))]
        if run % 5 == 0 and len(points) > 1:
            points[-1] = (points[-2][0], points[-2][1])  # a repeated last point
        if run % 5 == 1:
            points[-1] = (points[-1][0], NAN)
        if run % 5 == 2:
            points = [(7, 1.0)] * len(points)
        rows += [(run, i, s, "loss", v) for i, (s, v) in enumerate(points)]
        expected[run] = [str(p) for p in naive.thinned([tuple(p) for p in points], most)]
    long = spark.createDataFrame(rows, "run_id long, record_seq long, global_step long, name string, value double")
    found = by_run(series.downsample_series(long, most).collect(), "global_step", "value")
    assert {run: [str(p) for p in points] for run, points in found.items()} == expected


def test_plots_choose_and_label(spark):
    long = spark.createDataFrame(
        [(1, 0, 0, "train_loss", 1.0), (1, 0, 0, "other", 1.0)],
        "run_id long, record_seq long, global_step long, name string, value double",
    )
    found = series.plot_series(long, ["train_loss", "absent"], 10).collect()
    assert [(r["name"], r["label"]) for r in found] == [("train_loss", "Train Loss")]
    names = spark.createDataFrame([("a/b_c",)], "m string").select(file_safe(F.col("m")), axis_label(F.col("m")))
    assert tuple(names.first()) == ("a_b_c", "A/b C")


def test_masked_mean_counts_weights(spark):
    rows = spark.createDataFrame([(1, 5, 2.0, 3), (1, 6, 4.0, 1), (1, -100, 99.0, 7)], "k int, label int, nll double, n long")
    assert tuple(intervals.masked_mean_loss(rows, ["k"], weight="n").first()) == (1, 2.5, 4)
    assert tuple(intervals.masked_mean_loss(rows, ["k"]).first()) == (1, 3.0, 2)


def test_catalog_overwrites_best_and_final(spark):
    steps = spark.createDataFrame([(1, s, s // 4) for s in range(1, 9)], "run_id long, global_step long, chunk_id long")
    best = spark.createDataFrame([(1, 0, 2, 0, 3.0), (1, 1, 6, 1, 2.0)], OBSERVED)
    chunks = steps.filter("global_step in (3, 7)")
    found = summary.checkpoint_catalog(steps, best, best.limit(1), chunks, 4, "a/loss")
    assert found.count() == 2 + 2 + 1 + 2 + 1
    latest = {r["checkpoint_name"]: r["global_step"] for r in summary.latest_checkpoints(found).collect()}
    assert latest == {
        "checkpoint-step-00000004.pt": 4,
        "checkpoint-step-00000008.pt": 8,
        "best-a_loss.pt": 6,
        "a_loss-step-00000002.pt": 2,
        "checkpoint-chunk-000000.pt": 3,
        "checkpoint-chunk-000001.pt": 7,
        "final_checkpoint.pt": 8,
    }


def test_a_hot_run_is_spread(spark, small_buckets):
    """A run with most of the rows meets no task as a whole: its rows have many buckets."""
    rows = [(0, s, 1, 1) for s in range(1, 400)] + [(r, 1, 1, 1) for r in range(1, 50)]
    steps = spark.createDataFrame(rows, "run_id long, global_step long, tokens long, samples long")
    found = intervals.running_totals(steps)
    totals = {(r["run_id"], r["global_step"]): r["tokens_seen"] for r in found.collect()}
    assert totals == {(run, step): step for run, step, _, _ in rows}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(run_id" in plan and "__bucket" in plan.split("Window")[1]
