import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

import naive
from seqloom.functions.tokenizers import CharTokenizer
from seqloom.operators.ordered import by_value
from seqloom.plans.metric_queries import _drained
from seqloom.sources import progress as store
from seqloom.streaming.ingest import ingest_stream
from seqloom.streaming.metrics import _interval_parts, interval_stream, monitor_stream


def parts(spark, path, frames):
    """One file per frame, in order of time."""
    for frame in frames:
        frame.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).parquet(path)


def drain(stream, path):
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{path}/out")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/out").collect()


def ingest(spark, rows, path, **options):
    query = ingest_stream(
        rows,
        CharTokenizer(),
        lambda batch: by_value(batch, "k"),
        f"{path}/sequences",
        f"{path}/progress",
        f"{path}/stream",
        chunk_size=4,
        context_length=8,
        batch_size=2,
        **options,
    )
    query.awaitTermination()


def expected_sequences(groups):
    out, chunk = [], 0
    for texts in groups:
        texts = [t.strip() for t in texts if t.strip()]
        for start in range(0, len(texts), 4):
            ids = [[ord(c) % 31 + 1 for c in t] + [0] for t in texts[start : start + 4]]
            out += [(chunk, s, *w) for s, w in enumerate(naive.windows(ids, 8))]
            chunk += 1
    return out


@pytest.mark.parametrize("cap", [None, 13])
def test_ingest_numbers_chunks_over_batches_and_repeats_nothing(spark, tmp_path, cap):
    rng = random.Random(2)
    groups = [[rng.choice(["", "abc def", " x ", "lorem ipsum dolor"]) for _ in range(n)] for n in (11, 9, 5)]
    frames, k = [], 0
    for texts in groups:
        frames.append(spark.createDataFrame([(k + i, t) for i, t in enumerate(texts)], "k long, text string"))
        k += len(texts)
    rows = parts(spark, f"{tmp_path}/in", frames[:2])
    ingest(spark, rows, tmp_path, total_documents=cap)
    # more files, a new query on the same checkpoint
    rows = parts(spark, f"{tmp_path}/in", frames[2:])
    ingest(spark, rows, tmp_path, total_documents=cap)
    found = spark.read.parquet(f"{tmp_path}/sequences").select("chunk_id", "seq_id", "input_ids", "labels")
    kept, left = [], cap
    for texts in groups:
        docs = [t for t in texts if t.strip()][: left if left is not None else None]
        kept.append(docs)
        left = None if left is None else left - len(docs)
    assert sorted(map(tuple, found.collect())) == expected_sequences(kept)
    done = store.load_progress(spark, f"{tmp_path}/progress").first()
    assert done["trained_documents"] == sum(map(len, kept))
    assert done["next_chunk_id"] == sum(-(-len(docs) // 4) for docs in kept)


def test_a_batch_that_runs_again_replaces_its_output(spark, tmp_path):
    frame = spark.createDataFrame([(i, "some text here") for i in range(6)], "k long, text string")
    rows = parts(spark, f"{tmp_path}/in", [frame])
    ingest(spark, rows, tmp_path)
    before = spark.read.parquet(f"{tmp_path}/sequences").count()
    # a lost stream checkpoint: batch 0 runs again, over output and progress of its first try
    query = ingest_stream(
        rows, CharTokenizer(), lambda batch: by_value(batch, "k"), f"{tmp_path}/sequences",
        f"{tmp_path}/progress", f"{tmp_path}/other", chunk_size=4, context_length=8, batch_size=2,
    )
    query.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/sequences").count() == before
    assert store.load_progress(spark, f"{tmp_path}/progress").first()["trained_documents"] == 6


def test_interval_stream_equals_batch(spark, tmp_path):
    rng = random.Random(5)
    rows = {run: [rng.random() for _ in range(rng.randint(1, 50))] for run in range(12)}
    table = [
        (run, (s - 1) // 10, s, loss, 1.0, 5, 2, s % 10 == 0 or s == len(losses))
        for run, losses in rows.items()
        for s, loss in enumerate(losses, 1)
    ]
    frame = spark.createDataFrame(
        table,
        "run_id long, chunk_id long, global_step long, loss double, grad_norm double, tokens long, "
        "samples long, last_in_chunk boolean",
    )
    cut = [frame.filter(F.col("global_step").between(low, high)) for low, high in ((1, 13), (14, 15), (16, 99))]
    found = drain(interval_stream(parts(spark, f"{tmp_path}/in", cut), 4), tmp_path)
    for run, losses in rows.items():
        mine = sorted((r["global_step"], r["train_loss"], r["tokens_seen"]) for r in found if r["run_id"] == run)
        expected = naive.records(losses, 4, 10)
        assert [m[0] for m in mine] == [s for s, _ in expected]
        assert [m[1] for m in mine] == pytest.approx([x for _, x in expected])
        assert [m[2] for m in mine] == [5 * s for s, _ in expected]


def test_intervals_of_a_short_run_take_no_frame_operation(monkeypatch):
    """A run's rows are summed as plain arrays; chunks that alternate inside an interval stay one part each."""
    nan, names = float("nan"), ["global_step", "chunk_id", "loss", "grad_norm", "tokens", "samples", "last_in_chunk"]
    rows = [(3, 0, 1.0, 1.0, 5, 2, False), (1, 0, nan, 2.0, 5, 2, False), (3, 1, 3.0, 3.0, 5, 2, None), (4, 0, 4.0, 4.0, 5, 2, False), (5, 1, 5.0, 5.0, 7, 2, True)]
    frames = [pd.DataFrame(rows[:2], columns=names), pd.DataFrame(rows[2:], columns=names)]
    for name in ("groupby", "sort_values"):
        monkeypatch.delattr(pd.DataFrame, name, raising=False)
    got = [tuple(part.values()) for part in _interval_parts(frames, 4)]
    assert repr(got) == repr([(0, 1, 4, 3, nan, 7.0, 15, 6, True), (1, 1, 3, 1, 3.0, 3.0, 5, 2, False), (1, 2, 5, 1, 5.0, 5.0, 7, 2, True)])
    empty = pd.DataFrame([(nan, 0, 1.0, 1.0, 5, 2, False)], columns=names)
    assert _interval_parts([empty], 4) == []


def test_stream_parts_are_written_by_more_than_one_task(spark, tmp_path):
    """A part is one micro-batch of several files, and the next part goes on with its state."""
    table = [(run, 0, s, 1.0, 1.0, 5, 2, s == 12) for run in range(40) for s in range(1, 13)]
    schema = "run_id long, chunk_id long, global_step long, loss double, grad_norm double, tokens long, samples long, last_in_chunk boolean"
    frame, source = spark.createDataFrame(table, schema).repartition(4), f"{tmp_path}/in"
    frame.limit(0).write.parquet(source)
    found = _drained(interval_stream(spark.readStream.schema(frame.schema).parquet(source), 8), source, frame.where("global_step <= 6"), frame.where("global_step > 6"))
    assert sorted(map(tuple, found.select("run_id", "global_step", "interval_steps", "tokens_seen").collect())) == sorted(x for r in range(40) for x in ((r, 8, 8, 40), (r, 12, 4, 60)))
    assert len(spark.read.parquet(source).inputFiles()) >= 8


def test_monitor_stream_equals_batch(spark, tmp_path):
    rng = random.Random(6)
    runs = {
        run: [(seq, 3 * seq + 1, float("nan") if rng.random() < 0.05 else rng.random()) for seq in range(rng.randint(1, 40))]
        for run in range(15)
    }
    frame = spark.createDataFrame(
        [(run, *row) for run, rows in runs.items() for row in rows],
        "run_id long, record_seq long, global_step long, value double",
    )
    cut = [frame.filter(F.col("record_seq").between(low, high)) for low, high in ((0, 6), (7, 7), (8, 99))]
    stream = monitor_stream(
        parts(spark, f"{tmp_path}/in", cut), 4, "max", 0.05,
        threshold=0.6, stop_threshold=0.7, patience=20, warmup=10,
    )
    found = drain(stream, tmp_path)
    for run, rows in runs.items():
        mine = sorted((r for r in found if r["run_id"] == run), key=lambda r: r["record_seq"])
        smooth = naive.smoothed([v for _, _, v in rows], 4)
        assert [r["smoothed"] for r in mine] == pytest.approx(smooth, nan_ok=True)
        seen = [(seq, step, v) for (seq, step, _), v in zip(rows, smooth)]
        assert [r["record_seq"] for r in mine if r["is_best"]] == naive.best(seen, "max", 0.05)
        assert [r["record_seq"] for r in mine if r["reaches_threshold"]] == [s for s, _, v in seen if v >= 0.6][:1]
        stop = naive.early_stop(seen, "max", 0.05, 10, 0.7, 20)
        first = next(((r["record_seq"], r["stop_reason"]) for r in mine if r["stop_reason"]), None)
        assert first == stop


def test_rows_behind_a_cap_wait_for_a_higher_one(spark, tmp_path):
    frames = [
        spark.createDataFrame([(100 * f + i, f"doc {100 * f + i}") for i in range(30)], "k long, text string")
        for f in range(3)
    ]
    rows = parts(spark, f"{tmp_path}/in", frames[:2])
    ingest(spark, rows, tmp_path, total_documents=18)
    assert store.load_progress(spark, f"{tmp_path}/progress").first()["trained_documents"] == 18
    ingest(spark, rows, tmp_path, total_documents=18)  # nothing new: nothing changes
    ingest(spark, rows, tmp_path, total_documents=40)
    done = store.load_progress(spark, f"{tmp_path}/progress").first()
    assert (done["trained_documents"], done["source_rows_consumed"]) == (40, 40)
    rows = parts(spark, f"{tmp_path}/in", frames[2:])
    ingest(spark, rows, tmp_path, total_documents=200)
    done = store.load_progress(spark, f"{tmp_path}/progress").first()
    assert (done["trained_documents"], done["source_rows_consumed"]) == (90, 90)
    assert store.load_pending(spark, f"{tmp_path}/progress") == []
    found = spark.read.parquet(f"{tmp_path}/sequences").select("chunk_id", "seq_id", "input_ids", "labels")
    groups, texts = [], [f"doc {100 * f + i}" for f in range(3) for i in range(30)]
    for a, b in ((0, 18), (18, 30), (30, 40), (40, 60), (60, 90)):  # a set of rows ends in a short chunk
        groups.append(texts[a:b])
    assert sorted(map(tuple, found.collect())) == expected_sequences(groups)


def test_blank_rows_at_the_end_are_counted(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a b"), (2, " "), (3, "")], "k long, text string")
    blank = spark.createDataFrame([(4, " "), (5, "")], "k long, text string")
    ingest(spark, parts(spark, f"{tmp_path}/in", [frame, blank]), tmp_path)
    done = store.load_progress(spark, f"{tmp_path}/progress").first()
    assert (done["trained_documents"], done["source_rows_consumed"]) == (1, 5)


@pytest.mark.parametrize("files", [1, 3])
def test_ingest_query_reads_a_folder_of_files(spark, tmp_path, files):
    from seqloom.plans import corpus_queries

    rows = [(n, "en", "s", f"text {n} " * (n % 5), 0) for n in range(250)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string, n_chars long")
    docs.repartition(files).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_queries.stream_ingest(spark, str(tmp_path)).collect()
    assert len(got) > 3
    assert sorted(got) == sorted(corpus_queries.pack_sequences(spark, str(tmp_path)).collect())
