import datetime
import math

import pytest
from pyspark.sql import functions as F

from seqloom import RunOptions
from test_metrics import simulate
from seqloom.functions.tokenizers import CharTokenizer
from seqloom.operators import summary
from seqloom.plans import corpus, metrics
from seqloom.sources import progress as progress_store
from seqloom.sources.metrics_log import load_metrics_log

TOKENIZER = CharTokenizer()


def options(tmp_path, **changes):
    small = dict(
        dataset_name="toy", dataset_config=None, total_documents=23, chunk_size=5, context_length=16,
        batch_size=2, shuffle_buffer=0, output_dir=f"{tmp_path}/run",
    )
    return RunOptions(**{**small, **changes})


def test_toy_run(spark, tmp_path):
    chosen = options(tmp_path)
    rows = corpus.open_corpus(spark, chosen)
    end = corpus.prepare_corpus(rows, "row_idx", chosen, TOKENIZER).first()
    assert (end["trained_documents"], end["next_chunk_id"], end["stop_reason"]) == (23, 5, "total_documents")
    assert end["source_rows_consumed"] == 23


@pytest.mark.parametrize("streaming,buffer", [(True, 0), (True, 8), (False, 8)])
def test_resuming_gives_what_one_run_gives(spark, tmp_path, streaming, buffer):
    rows = corpus.open_corpus(spark, options(tmp_path, total_documents=40)).withColumn(
        "text", F.when(F.col("row_idx") % 7 == 3, F.lit(" ")).otherwise(F.col("text"))
    )
    common = dict(streaming=streaming, shuffle_buffer=buffer)

    def sequences(folder):
        return sorted(
            map(tuple, spark.read.parquet(f"{folder}/sequences").select("chunk_id", "seq_id", "input_ids").collect())
        )

    once = options(tmp_path, output_dir=f"{tmp_path}/once", total_documents=30, **common)
    end = corpus.prepare_corpus(rows, "row_idx", once, TOKENIZER).first()
    for cap in (10, 15, 30, 30):
        again = options(tmp_path, output_dir=f"{tmp_path}/parts", total_documents=cap, **common)
        resumed = corpus.prepare_corpus(rows, "row_idx", again, TOKENIZER).first()
        assert resumed["trained_documents"] == cap
    assert sequences(f"{tmp_path}/parts") == sequences(f"{tmp_path}/once")
    assert resumed.asDict() == end.asDict()
    rest = options(tmp_path, output_dir=f"{tmp_path}/parts", total_documents=1000, **common)
    last = corpus.prepare_corpus(rows, "row_idx", rest, TOKENIZER).first()
    assert (last["trained_documents"], last["stop_reason"]) == (34, "dataset_exhausted")


@pytest.mark.parametrize("streaming,buffer", [(True, 0), (True, 8), (False, 8)])
def test_a_killed_run_repeats_one_range(spark, tmp_path, monkeypatch, streaming, buffer):
    rows = corpus.open_corpus(spark, options(tmp_path, total_documents=60)).withColumn(
        "text", F.when(F.col("row_idx") % 7 == 3, F.lit(" ")).otherwise(F.col("text"))
    )
    common = dict(streaming=streaming, shuffle_buffer=buffer, total_documents=48)
    once = options(tmp_path, output_dir=f"{tmp_path}/once", **common)
    end = corpus.prepare_corpus(rows, "row_idx", once, TOKENIZER).first()

    committed, saved = [], progress_store.save_progress
    write = progress_store.commit_output

    def output(part, *rest):
        committed.append(part.select("first_chunk_id").first()[0])
        write(part, *rest)

    def dies(record, path):
        if len(committed) == 3:
            raise KeyboardInterrupt
        saved(record, path)

    monkeypatch.setattr(progress_store, "commit_output", output)
    monkeypatch.setattr(progress_store, "save_progress", dies)
    again = options(tmp_path, output_dir=f"{tmp_path}/ranges", **common)
    with pytest.raises(KeyboardInterrupt):
        corpus.prepare_corpus(rows, "row_idx", again, TOKENIZER, commit_every=2)
    assert committed == [0, 2, 4]
    kept = progress_store.load_progress(spark, f"{again.output_dir}/progress").first()
    assert (kept["trained_documents"], kept["next_chunk_id"]) == (20, 4)
    resumed = corpus.prepare_corpus(rows, "row_idx", again, TOKENIZER, commit_every=2).first()
    assert committed == [0, 2, 4, 4, 6, 8]

    def sequences(run):
        found = spark.read.parquet(f"{run.output_dir}/sequences")
        return sorted(map(tuple, found.select("chunk_id", "seq_id", "input_ids", "labels").collect()))

    assert sequences(again) == sequences(once)
    assert resumed.asDict() == end.asDict()


def test_ranges_of_a_run_without_rows(spark, tmp_path):
    chosen = options(tmp_path, chunk_size=1)
    rows = corpus.open_corpus(spark, chosen)
    end = corpus.prepare_corpus(rows.limit(0), "row_idx", chosen, TOKENIZER, commit_every=1).first()
    assert (end["trained_documents"], end["stop_reason"]) == (0, "dataset_exhausted")
    with pytest.raises(ValueError, match="positive"):
        corpus.prepare_corpus(rows, "row_idx", chosen, TOKENIZER, commit_every=0)


def test_batches_of_a_run(spark, tmp_path):
    chosen = options(tmp_path, epochs=2)
    found = corpus.training_batches(corpus.open_corpus(spark, chosen), "row_idx", chosen, TOKENIZER)
    shapes = found.select(*[F.size(c) for c in ("input_ids", "labels", "attention_mask")], "batch_len")
    assert all(len(set(r)) == 1 for r in shapes.collect())
    assert found.select("epoch").distinct().count() == 2


def test_missing_text_column(spark, tmp_path):
    rows = spark.range(3)
    with pytest.raises(KeyError, match="among: id"):
        corpus.prepare_corpus(rows, "id", options(tmp_path), TOKENIZER)


def steps(spark, runs):
    start = datetime.datetime(2024, 1, 1)
    rows = [
        (run, s, (s - 1) // 10, 1, loss, 1.0, 2e-4, 5, 2, start + datetime.timedelta(seconds=s))
        for run, losses in runs.items()
        for s, loss in enumerate(losses, 1)
    ]
    return spark.createDataFrame(
        rows,
        "run_id long, global_step long, chunk_id long, epoch long, loss double, grad_norm double, "
        "learning_rate double, tokens long, samples long, ts timestamp_ntz",
    )


def test_analysis_of_runs(spark, tmp_path):
    runs = {1: [3 * math.exp(-i / 20) for i in range(60)], 2: [1.0] * 45, 3: [2.0] * 5}
    chosen = options(
        tmp_path, metrics_every_steps=4, metric_smoothing_window=2, early_stop_threshold=0.6,
        early_stop_patience_steps=16, max_steps=42, save_every_steps=20, best_checkpoint_min_delta=0.3,
        save_threshold_checkpoint=True, threshold_checkpoint_value=1.0, max_plot_points=3,
    )
    found = metrics.analyse_steps(steps(spark, runs), chosen)
    stops = {r["run_id"]: (r["global_step"], r["stop_reason"]) for r in found.stops.collect()}
    expected = {
        run: simulate(losses, 4, 10, 2, 0, 42, "min", 0.0, 0, 0.6, 16) for run, losses in runs.items()
    }
    assert stops == expected
    assert [reason for _, reason in expected.values()] == ["metric_threshold", "metric_patience", "dataset_exhausted"]
    last = {r["run_id"]: r["s"] for r in found.records.groupBy("run_id").agg(F.max("global_step").alias("s")).collect()}
    assert last == {run: step for run, (step, _) in expected.items()}
    assert [r["global_step"] for r in found.best.filter("run_id = 2").collect()] == [4]
    assert found.thresholds.count() == 2
    needed = found.taken.select("run_id", "chunk_id").distinct().withColumn("expected_steps", F.lit(10))
    chunks = summary.completed_chunks(found.taken, needed).withColumn("documents", F.lit(3))
    catalog = metrics.checkpoints(found, chosen, chunks)
    names = {r["checkpoint_name"] for r in catalog.filter("run_id = 2").collect()}
    assert names == {
        "checkpoint-step-00000020.pt", "best-train_loss.pt", "train_loss-step-00000004.pt",
        "checkpoint-chunk-000000.pt", "checkpoint-chunk-000001.pt", "final_checkpoint.pt",
    }
    summary_rows = summary.run_summary(found.taken, chunks, found.stops)
    metrics.save_analysis(found, chosen, summary_rows)
    log = load_metrics_log(spark, f"{chosen.output_dir}/metrics")
    assert log.filter("name = 'train_loss'").count() == found.records.count()
    kept = {r["run_id"]: r for r in spark.read.json(f"{chosen.output_dir}/train_summary").collect()}
    assert (kept[2]["trained_documents"], kept[2]["tokens_seen"], kept[3]["trained_documents"]) == (6, 100, 0)
    settings = {r["name"]: r["value"] for r in spark.read.json(f"{chosen.output_dir}/run_config").collect()}
    assert settings["max_steps"] == "42"


def test_watching_an_unknown_metric_changes_nothing(spark, tmp_path):
    chosen = options(tmp_path, early_stop_metric="absent", early_stop_threshold=1.0, best_checkpoint_metric="global_step")
    found = metrics.analyse_steps(steps(spark, {1: [0.5] * 12}), chosen)
    assert found.stops.first()["stop_reason"] == "dataset_exhausted"
    assert [r["value"] for r in found.best.collect()] == [10.0]


@pytest.mark.parametrize("buffer", [8, 10_000])
def test_a_grown_source_is_read_to_its_end(spark, tmp_path, buffer):
    chosen = options(tmp_path, total_documents=500, streaming=True, shuffle_buffer=buffer)
    rows = corpus.open_corpus(spark, options(tmp_path, total_documents=200))
    first = corpus.prepare_corpus(rows.where("row_idx < 100"), "row_idx", chosen, TOKENIZER).first()
    assert (first["trained_documents"], first["stop_reason"]) == (100, "dataset_exhausted")
    second = corpus.prepare_corpus(rows, "row_idx", chosen, TOKENIZER).first()
    assert (second["trained_documents"], second["source_rows_consumed"]) == (200, 200)
    with pytest.raises(ValueError, match="lost 100"):
        corpus.prepare_corpus(rows.where("row_idx >= 100"), "row_idx", chosen, TOKENIZER)


def test_another_seed_or_size_is_refused(spark, tmp_path):
    rows = corpus.open_corpus(spark, options(tmp_path, total_documents=60))
    for streaming in (True, False):
        common = dict(streaming=streaming, shuffle_buffer=8, output_dir=f"{tmp_path}/run{streaming}")
        corpus.prepare_corpus(rows, "row_idx", options(tmp_path, total_documents=20, **common), TOKENIZER)
        with pytest.raises(ValueError, match="begun with the order"):
            again = options(tmp_path, total_documents=40, seed=7, **common)
            corpus.prepare_corpus(rows, "row_idx", again, TOKENIZER)
    with pytest.raises(ValueError, match="had 60 rows"):
        again = options(tmp_path, total_documents=40, **common)
        corpus.prepare_corpus(rows.where("row_idx < 50"), "row_idx", again, TOKENIZER)


def test_an_order_that_was_not_finished_is_made_again(spark, tmp_path):
    chosen = options(tmp_path, total_documents=60, streaming=True, shuffle_buffer=8)
    rows = corpus.open_corpus(spark, chosen)
    spark.createDataFrame([(0, 0)], "__key long, row_idx long").write.parquet(f"{chosen.output_dir}/order/0")
    done = corpus.prepare_corpus(rows, "row_idx", chosen, TOKENIZER).first()
    assert done["trained_documents"] == 60
