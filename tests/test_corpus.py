import random

import pytest
from pyspark.sql import functions as F

import naive
from seqloom.functions.tokenizers import CharTokenizer, PythonTokenizer
from seqloom.operators import batching, corpus, packing
from seqloom.operators.ordered import by_hash, by_value, by_width, ordinal

BLANKS = ["", "  ", "\t\n", None, " "]


def documents(spark, seed, count, longest=30):
    rng = random.Random(seed)
    texts = [
        rng.choice(BLANKS) if rng.random() < 0.3 else "".join(rng.choices("abc dé😀", k=rng.randint(1, longest)))
        for _ in range(count)
    ]
    keys = rng.sample(range(10 * count), count)
    rows = spark.createDataFrame(list(zip(keys, texts)), "key long, text string")
    return rows, [text for _, text in sorted(zip(keys, texts))]


def char_ids(text):
    return [ord(c) % 31 + 1 for c in text] + [0]


def clean(texts):
    return [t.strip() for t in texts if t is not None and t.strip()]


@pytest.mark.parametrize("buckets", [1, 3, 40])
@pytest.mark.parametrize("cap", [None, 7, 23, 1000])
def test_manifest_equals_pull_loop(spark, buckets, cap):
    rows, texts = documents(spark, buckets, 60)
    order = by_value(rows, "key", buckets=buckets)
    found = corpus.chunk_manifest(corpus.assign_chunks(rows, 5, order=order, total_documents=cap))
    expected = naive.chunks(texts, 5, cap)
    assert [tuple(r)[1:] for r in found.orderBy("chunk_id").collect()] == expected
    index = packing.index_corpus(rows, CharTokenizer(), 5, order=order, total_documents=cap)
    indexed = index.chunks.select("chunk_id", "documents", "source_rows").orderBy("chunk_id")
    assert [tuple(r)[1:] for r in indexed.collect()] == expected


def test_cap_continues_an_earlier_run(spark):
    rows, texts = documents(spark, 5, 60)
    order = by_value(rows, "key", buckets=4)
    found = corpus.assign_chunks(
        rows, 5, order=order, total_documents=20, documents_before=12, first_chunk_id=3
    )
    manifest = corpus.chunk_manifest(found).orderBy("chunk_id").collect()
    assert [tuple(r)[1:] for r in manifest] == naive.chunks(texts, 5, 8)
    assert [r["chunk_id"] for r in manifest] == [3, 4]


@pytest.mark.parametrize(
    "seed,length,chunk,buckets,block",
    [(1, 4, 3, 1, 8), (2, 7, 10, 5, 14), (3, 1, 4, 20, 16), (4, 64, 5, 9, 64), (5, 16, 1000, 12, 32), (6, 5, 1, 3, 5)],
)
def test_packing_equals_definition(spark, monkeypatch, seed, length, chunk, buckets, block):
    monkeypatch.setattr(packing, "BLOCK_TOKENS", block)
    rows, texts = documents(spark, seed, 80)
    index = packing.index_corpus(
        rows, CharTokenizer(), chunk, order=by_value(rows, "key", buckets=buckets)
    )
    docs = packing.chunk_documents(index)
    found = packing.pack_sequences(docs, length).orderBy("chunk_id", "seq_id").collect()
    texts = clean(texts)
    expected = []
    for number in range(0, len(texts), chunk):
        ids = [char_ids(t) for t in texts[number : number + chunk]]
        for seq, (inputs, labels) in enumerate(naive.windows(ids, length)):
            expected.append((number // chunk, seq, inputs, labels))
    assert [tuple(r) for r in found] == expected
    counts = packing.sequence_counts(index.chunks, length).orderBy("chunk_id").collect()
    assert sum(r["sequences"] for r in counts) == len(expected)
    # the same without buckets: every block travels
    plain = packing.pack_sequences(docs.drop("__bucket"), length).orderBy("chunk_id", "seq_id")
    assert [tuple(r) for r in plain.collect()] == expected


def test_packing_pair(spark):
    rows = spark.createDataFrame([(0, "one two three four"), (1, "five six")], "row_idx long, text string")
    index = packing.index_corpus(rows, CharTokenizer(), 10)
    counts = packing.sequence_counts(index.chunks, 4)
    assert tuple(counts.first()) == (0, 28, 7)
    packed = packing.pack_sequences(packing.chunk_documents(index), 4)
    assert all(r["input_ids"][1:] == r["labels"][:-1] for r in packed.collect())
    batches = batching.assign_batches(counts, 4, 2, shuffle=False)
    first = batching.collate_batches(packed, 0, batches).filter("batch_id = 0").collect()
    assert [len(r["input_ids"]) for r in first] == [4, 4]


def test_one_token_chunk_is_an_error(spark):
    chunks = spark.createDataFrame([(0, 1)], "chunk_id long, chunk_tokens long")
    with pytest.raises(Exception, match="a chunk needs two tokens or more"):
        packing.sequence_counts(chunks, 4).collect()
    docs = spark.createDataFrame(
        [(0, 0, 1, 1, [0])], "chunk_id long, tok_start long, n_tok long, chunk_tokens long, tokens array<int>"
    )
    with pytest.raises(Exception, match="a chunk needs two tokens or more"):
        packing.pack_windows(docs, 4).collect()


@pytest.mark.parametrize("bad", [0, -1])
def test_bad_sizes(spark, bad):
    rows = spark.createDataFrame([(0, "a")], "row_idx long, text string")
    with pytest.raises(ValueError, match="chunk_size must be positive"):
        corpus.assign_chunks(rows, bad)
    with pytest.raises(ValueError, match="context_length must be positive"):
        packing.sequence_counts(rows, bad)


def test_python_tokenizer_packs_the_same(spark):
    class WordEncoder:
        """A stand-in for a pretrained encoder; local, so that it travels by value."""

        eos_token_id = 99

        def encode(self, text, add_special_tokens=False):
            return [len(word) for word in text.split()]

    rows, texts = documents(spark, 9, 40)
    index = packing.index_corpus(
        rows, PythonTokenizer(WordEncoder), 6, order=by_value(rows, "key", buckets=5)
    )
    found = packing.pack_sequences(packing.chunk_documents(index), 8).orderBy("chunk_id", "seq_id")
    expected = []
    texts = clean(texts)
    for number in range(0, len(texts), 6):
        ids = [WordEncoder().encode(t) + [99] for t in texts[number : number + 6]]
        expected += naive.windows(ids, 8)
    assert [(r["input_ids"], r["labels"]) for r in found.collect()] == expected


def test_trained_tokenizer_from_a_library(spark):
    tokenizers = pytest.importorskip("tokenizers")

    def build():
        words = {"[UNK]": 0, "a": 1, "b": 2}
        made = tokenizers.Tokenizer(tokenizers.models.WordLevel(words, unk_token="[UNK]"))
        made.pre_tokenizer = tokenizers.pre_tokenizers.Whitespace()
        return made

    rows = spark.createDataFrame([("a b zz a",)], "text string")
    found = packing.tokenize_docs(rows, PythonTokenizer(build, eos_token_id=3)).first()
    assert found["tokens"] == [1, 2, 0, 1, 3]


def test_char_tokenizer_beyond_the_basic_plane(spark):
    text = "aé　😀\U0010ffff"
    rows = spark.createDataFrame([(text,), ("",)], "text string")
    found = {r["text"]: r["tokens"] for r in packing.tokenize_docs(rows, CharTokenizer()).collect()}
    assert found == {text: char_ids(text), "": [0]}


def test_token_offsets(spark, small_buckets):
    rng = random.Random(3)
    sizes = [rng.randint(1, 9) for _ in range(50)]
    rows = spark.createDataFrame([(i // 17, i, n) for i, n in enumerate(sizes)], "chunk_id long, row_idx long, n_tok long")
    for r in packing.token_offsets(rows).collect():
        start = r["chunk_id"] * 17
        assert r["tok_start"] == sum(sizes[start : r["row_idx"]])
        assert r["chunk_tokens"] == sum(sizes[start : start + 17])


def test_shuffles_are_reproducible_permutations(spark):
    rows = spark.range(100).withColumnRenamed("id", "key")
    full = corpus.shuffle_full(rows, 42, "key")
    one = dict(full.collect())
    assert sorted(one.values()) == list(range(100)) and one == dict(full.repartition(13).collect())
    assert one != dict(corpus.shuffle_full(rows, 43, "key").collect())
    placed = rows.withColumn("row_idx", F.col("key"))
    near = dict(corpus.shuffle_buffered(placed, 42, "key", 16).collect())
    assert sorted(near.values()) == list(range(100))
    assert all(old // 16 == new // 16 for old, new in near.items()) and near != {i: i for i in range(100)}
    assert corpus.shuffle_buffered(placed, 42, "key", 0) is placed


def test_skip_is_a_pushed_filter(spark, tmp_path):
    spark.range(10).withColumnRenamed("id", "row_idx").write.parquet(f"{tmp_path}/t")
    found = corpus.skip_rows(spark.read.parquet(f"{tmp_path}/t"), 7)
    assert found.count() == 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(row_idx,7)" in plan
    assert corpus.skip_rows(found, 0) is found


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_any_number_of_partitions_gives_the_same(spark, partitions):
    rows, _ = documents(spark, 11, 70)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        results = []
        for count in ("8", str(partitions)):
            spark.conf.set("spark.sql.shuffle.partitions", count)
            index = packing.index_corpus(rows, CharTokenizer(), 9, order=by_hash(rows, 1, "key"))
            packed = packing.pack_sequences(packing.chunk_documents(index), 8)
            batches = batching.assign_batches(packing.sequence_counts(index.chunks, 8), 8, 3, 2)
            collated = batching.collate_batches(packed, 0, batches)
            shown = collated.select("chunk_id", "epoch", "batch_id", "seq_id", "input_ids", "labels")
            results.append(sorted(map(tuple, shown.collect())))
        assert results[0] == results[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_order_of_ties_dates_and_bad_columns(spark):
    rows = spark.createDataFrame([(1, 5), (1, 3), (0, 9), (1, 4)], "a int, b int")
    found = ordinal(rows, by_value(rows, "a", ["b"], buckets=3)).collect()
    assert sorted((r["row_idx"], r["a"], r["b"]) for r in found) == [(0, 0, 9), (1, 1, 3), (2, 1, 4), (3, 1, 5)]
    days = rows.select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("b")).alias("day"), "b")
    placed = ordinal(days, by_value(days, "day", buckets=2)).orderBy("row_idx").collect()
    assert [r["b"] for r in placed] == [3, 4, 5, 9]
    with pytest.raises(TypeError, match="cannot order by"):
        texts = rows.select(F.col("a").cast("string"))
        by_value(texts, "a")
    with pytest.raises(KeyError, match="no column.s. c among"):
        by_value(rows, "c")


def test_a_null_key_fails_instead_of_losing_rows(spark):
    rows = spark.createDataFrame([(1,), (None,)], "row_idx long")
    with pytest.raises(Exception, match="row_idx must not be null"):
        ordinal(rows, by_width("row_idx"), "p").collect()


def batches_of(spark, sizes, length, batch, **options):
    chunks = spark.createDataFrame(list(enumerate(sizes)), "chunk_id long, chunk_tokens long")
    counts = packing.sequence_counts(chunks, length)
    return counts, batching.assign_batches(counts, length, batch, **options)


def test_batches_cover_every_sequence_once_per_epoch(spark, small_buckets):
    counts, found = batches_of(spark, [100, 2, 37, 65], 4, 3, epochs=3)
    rows = found.collect()
    for chunk, size in enumerate([100, 2, 37, 65]):
        sequences = -(-(size - 1) // 4)
        for epoch in range(3):
            mine = [r for r in rows if (r["chunk_id"], r["epoch"]) == (chunk, epoch)]
            assert sorted(r["seq_id"] for r in mine) == list(range(sequences))
            assert sorted(r["rank"] for r in mine) == list(range(sequences))
            for r in mine:
                batch = [x for x in mine if x["batch_id"] == r["batch_id"]]
                assert r["batch_len"] == max(x["n_tokens"] for x in batch) and len(batch) <= 3
    assert [r["expected_steps"] for r in batching.expected_steps(counts, 3, 3).orderBy("chunk_id").collect()] == [
        -(-(-(-(s - 1) // 4)) // 3) * 3 for s in [100, 2, 37, 65]
    ]


def test_steps_run_over_chunks_epochs_batches(spark):
    counts, found = batches_of(spark, [30, 9, 50], 4, 3, epochs=2)
    batches = sorted({(r["chunk_id"], r["epoch"], r["batch_id"]) for r in found.collect()})
    steps = {tuple(r)[:3]: r["global_step"] for r in batching.global_steps(counts, 3, 2, first_step=5).collect()}
    assert steps == {batch: 6 + i for i, batch in enumerate(batches)}


def test_a_large_chunk_is_generated_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(batching, "STRETCH", 7)
    _, found = batches_of(spark, [400, 5], 4, 8)
    rows = found.collect()
    assert sorted(r["seq_id"] for r in rows if r["chunk_id"] == 0) == list(range(100))


def test_padding_masks_and_counts(spark):
    rows = spark.createDataFrame(
        [(0, 0, 0, [1, 0, 2], [0, 2, 3]), (0, 0, 0, [5], [6])],
        "chunk_id long, epoch long, batch_id long, input_ids array<int>, labels array<int>",
    )
    padded = batching.collate_batches(rows, pad_token_id=0)
    found = {tuple(r["input_ids"]): (r["labels"], r["attention_mask"]) for r in padded.collect()}
    assert found == {
        (1, 0, 2): ([0, 2, 3], [1, 1, 1]),  # a real id that equals the pad id stays visible
        (5, 0, 0): ([6, -100, -100], [1, 0, 0]),
    }
    assert tuple(batching.label_counts(padded).first()) == (0, 0, 0, 4, 2)


def test_label_counts_agree_with_the_assignment(spark):
    rows, _ = documents(spark, 21, 60)
    index = packing.index_corpus(rows, CharTokenizer(), 11, order=by_value(rows, "key"))
    packed = packing.pack_sequences(packing.chunk_documents(index), 8)
    batches = batching.assign_batches(packing.sequence_counts(index.chunks, 8), 8, 4, 2)
    from_labels = batching.label_counts(batching.collate_batches(packed, 0, batches))
    from_counts = batching.batch_token_counts(batches)
    assert sorted(map(tuple, from_labels.collect())) == sorted(map(tuple, from_counts.collect()))


def test_texts_are_shuffled_once(spark):
    """From the bucket exchange on, packing inside a bucket needs no other exchange."""
    rows, _ = documents(spark, 31, 60)
    index = packing.index_corpus(rows, CharTokenizer(), 11, order=by_value(rows, "key"))
    docs = packing.chunk_documents(index)
    packed = packing.pack_sequences(docs, 8)
    plan = packed._jdf.queryExecution().executedPlan().toString().splitlines()
    joined = next(i for i, line in enumerate(plan) if "ObjectHashAggregate(keys=[__bucket" in line)
    window = next(i for i, line in enumerate(plan) if i > joined and "Window" in line)
    assert not [line for line in plan[joined:window] if "Exchange" in line]


def test_rows_of_sequences_are_never_broadcast(spark):
    """The planner takes the rows of an explode for as many as the chunks; a broadcast passes the driver."""
    counts = spark.createDataFrame([(n, 900, 225) for n in range(3)], "chunk_id long, chunk_tokens long, sequences long")
    windows = spark.range(3 * 225).selectExpr("id div 225 AS chunk_id", "id % 225 AS seq_id", "array(1, 2, 3, 4, 5) AS tokens")
    batches = batching.assign_batches(counts, 4, 8, 2)
    collated = batching.collate_batches(windows, 0, batches)
    for made in (batches, batching.batch_token_counts(batches), collated):
        assert "BroadcastHashJoin" not in made._jdf.queryExecution().executedPlan().toString()
    assert collated.count() == batches.count() == 3 * 225 * 2


def test_a_python_tokenizer_holds_the_ids_of_a_slice(spark):
    """All ids of an Arrow batch of 10,000 texts at once take gigabytes in a worker."""
    import pandas as pd

    from seqloom.functions.batches import SLICE

    class CharEncoder:
        def encode(self, text, add_special_tokens=False):
            return [ord(c) for c in text]

    texts = pd.Series([None if n % 7 == 0 else "ab " * (n % 5) for n in range(1000)])
    encode = PythonTokenizer(CharEncoder, eos_token_id=0)._udf.func
    parts = list(encode(iter([texts, texts[:3]])))
    assert max(len(part) for part in parts) <= SLICE
    rows = spark.createDataFrame([(n, t) for n, t in enumerate(texts) if t is not None], "n long, text string").coalesce(1)
    made = packing.tokenize_docs(rows, PythonTokenizer(CharEncoder, eos_token_id=0)).collect()
    assert {r.n: r.tokens for r in made} == {n: [ord(c) for c in t] + [0] for n, t in enumerate(texts) if t is not None}
