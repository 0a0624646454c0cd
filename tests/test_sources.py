import json
import math

import pytest
from pyspark.sql import functions as F

from seqloom.functions.text import WHITESPACE, unicode_strip
from seqloom.operators import corpus
from seqloom.operators.ordered import by_width
from seqloom.operators.summary import progress_history
from seqloom.session import shared_folder
from seqloom.sources import corpus as sources
from seqloom.sources import progress as store
from seqloom.sources.metrics_log import append_metrics_log, load_metrics_log, parse_metric_lines


def test_toy_corpus_repeats(spark):
    rows = sources.toy_corpus(spark, 10).orderBy("row_idx").collect()
    assert [r["text"] for r in rows] == [sources.TOY_TEXTS[i % 4] for i in range(10)]


def test_toy_chunk_of_three(spark):
    rows = corpus.assign_chunks(sources.toy_corpus(spark, 8), 3)
    first = corpus.chunk_manifest(rows).orderBy("chunk_id").first()
    assert (first["documents"], first["source_rows"]) == (3, 3)


def test_toy_stream_is_endless_form(spark):
    stream = sources.toy_stream(spark)
    assert stream.isStreaming and stream.columns == ["row_idx", "text"]


def test_scan_of_config_and_split(spark, tmp_path):
    spark.range(5).write.json(f"{tmp_path}/wiki/en/train")
    found = sources.scan_corpus(spark, f"{tmp_path}/wiki", "en", "train", fmt="json")
    assert found.count() == 5
    stream = sources.scan_corpus(spark, f"{tmp_path}/wiki", "en", "train", "json", streaming=True)
    assert stream.isStreaming and stream.columns == ["id"]


def test_missing_text_column_names_the_others(spark):
    df = spark.createDataFrame([(1, "x")], "b int, a string")
    with pytest.raises(KeyError, match="no text column 'text' among: a, b"):
        corpus.normalize_text(df)


def test_strip_equals_python(spark):
    marks = [chr(c) for c in range(0x3002) if not 0xD800 <= c <= 0xDFFF]
    texts = [m + "a" + m + "b" + m for m in marks] + ["", " ", "\x1c", "x\n", " \x1fx y \n"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = dict(rows.select("i", unicode_strip(F.col("t"))).collect())
    assert [found[i] for i in range(len(texts))] == [t.strip() for t in texts]
    assert {m for m in marks if m.isspace()} == {chr(c) for c in WHITESPACE}


def test_null_text_rules(spark):
    df = spark.createDataFrame([(0, None), (1, " "), (2, " a ")], "k int, text string")
    assert [r["text"] for r in corpus.nonempty_docs(df).collect()] == ["a"]
    kept = corpus.nonempty_docs(df, null_text="literal").orderBy("k").collect()
    assert [r["text"] for r in kept] == ["None", "a"]


LINES = [
    '{"global_step": 1, "run_id": 7, "record_seq": 0, "loss": 1.5, "tokens": 3}',
    "",
    "   ",
    '{"global_step": 2',
    '{"global_step": 3.0, "loss": 1}',
    '{"global_step": "4", "loss": 1}',
    '{"loss": 1}',
    '{"global_step": 5, "loss": "1.5", "done": true, "note": null, "list": [1], "x": {"y": 1}}',
    '{"global_step": 6, "loss": NaN, "up": Infinity, "down": -Infinity, "ok": 1e3}',
    '{"global_step": 8, "loss": -0.25, "text": "a: NaN, b"}',
    "[1, 2]",
    "12",
    "null",
    '{"global_step": 9, "a name with space": 2, "big": 123456789012}',
]


def python_reading(lines):
    out = []
    for line in lines:
        try:
            record = json.loads(line)
        except ValueError:
            continue
        if not isinstance(record, dict) or type(record.get("global_step")) is not int:
            continue
        for name, value in record.items():
            if name not in ("global_step", "run_id", "record_seq") and type(value) in (int, float):
                out.append((record["global_step"], name, str(float(value))))
    return sorted(out)


def test_tolerant_log_equals_python(spark):
    lines = spark.createDataFrame([(line,) for line in LINES], "value string")
    found = parse_metric_lines(lines).collect()
    assert sorted((r["global_step"], r["name"], str(r["value"])) for r in found) == python_reading(LINES)


def test_boolean_step_is_malformed(spark):
    lines = spark.createDataFrame([('{"global_step": true, "loss": 1}',)], "value string")
    assert parse_metric_lines(lines).count() == 0


def test_log_appends_and_keeps_nan(spark, tmp_path):
    path = f"{tmp_path}/log"
    assert load_metrics_log(spark, path).count() == 0
    for seq, loss in enumerate([1.0, math.nan]):
        row = [(7, seq, 10 * seq, loss, None)]
        append_metrics_log(
            spark.createDataFrame(
                row, "run_id long, record_seq long, global_step long, loss double, gpu double"
            ),
            path,
        )
    rows = load_metrics_log(spark, path).orderBy("record_seq").collect()
    assert [(r["record_seq"], r["name"]) for r in rows] == [(0, "loss"), (1, "loss")]
    assert rows[0]["value"] == 1.0 and math.isnan(rows[1]["value"])
    text = "".join(r["value"] for r in spark.read.text(path).collect())
    assert '"loss":NaN' in text  # as Python's json writes and reads it


def test_progress_defaults_and_newest(spark, tmp_path):
    path = f"{tmp_path}/progress"
    assert store.load_progress(spark, path).first().asDict() == store.PROGRESS_DEFAULTS
    manifest = spark.createDataFrame([(0, 5, 6), (1, 5, 9)], "chunk_id long, documents long, source_rows long")
    store.save_progress(progress_history(manifest).filter("chunk_id = 0"), path)
    store.save_progress(progress_history(manifest).filter("chunk_id = 1"), path)
    found = store.load_progress(spark, path).first()
    assert (found["trained_documents"], found["source_rows_consumed"]) == (10, 15)
    assert (found["next_chunk_id"], found["checkpoint_path"]) == (2, "checkpoint-chunk-000001.pt")


def test_output_is_replaced_per_partition(spark, tmp_path):
    out, progress = f"{tmp_path}/out", f"{tmp_path}/progress"
    for value in ("first", "again"):
        rows = spark.createDataFrame([(0, value)], "chunk_id long, v string")
        manifest = rows.select("chunk_id", F.lit(1).alias("documents"), F.lit(1).alias("source_rows"))
        store.commit_chunks(rows, progress_history(manifest), out, progress)
    store.commit_output(spark.createDataFrame([(1, "next")], "chunk_id long, v string"), out, "chunk_id")
    assert sorted(r["v"] for r in spark.read.parquet(out).collect()) == ["again", "next"]


def test_resume_checks_that_both_agree(spark, tmp_path):
    progress = store.load_progress(spark, f"{tmp_path}/none")
    assert store.check_resume(progress, 0)["next_chunk_id"] == 0
    with pytest.raises(ValueError, match="progress is at step 0, the checkpoint at 12"):
        store.check_resume(progress, 12)


def test_resume_continues_where_the_first_run_stopped(spark):
    texts = ["a", " ", "b", None, "c", "d", "", "e", "f", " ", "g"]
    rows = spark.createDataFrame(list(enumerate(texts)), "row_idx long, text string")
    whole = corpus.assign_chunks(rows, 2).select("row_idx", "chunk_id").collect()
    first = corpus.chunk_manifest(corpus.assign_chunks(rows, 2, total_documents=4))
    done = first.agg(F.sum("source_rows"), F.sum("documents")).first()
    rest = corpus.assign_chunks(corpus.skip_rows(rows, done[0]), 2, order=by_width("row_idx"), first_chunk_id=2)
    resumed = {r["row_idx"]: r["chunk_id"] for r in rest.select("row_idx", "chunk_id").collect()}
    assert resumed == {r["row_idx"]: r["chunk_id"] for r in whole if r["row_idx"] >= done[0]}


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
