"""Registered queries over the corpus, and the SQL each must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions.text import WHITESPACE
from seqloom.functions.tokenizers import CharTokenizer, PythonTokenizer
from seqloom.operators import batching, corpus, packing
from seqloom.operators.intervals import masked_mean_loss
from seqloom.operators.ordered import by_hash, by_value
from seqloom.operators.summary import progress_history
from seqloom.plans import fixtures as fx
from seqloom.session import new_folder, written
from seqloom.sources import progress as progress_store
from seqloom.sources.corpus import TOY_TEXTS, scan_corpus, toy_texts
from seqloom.streaming.ingest import ingest_stream

L, B, E, C = fx.CONTEXT, fx.BATCH, fx.EPOCHS, fx.CHUNK_SIZE
TOKENIZER = CharTokenizer()


def _words(*arrays: str) -> list:
    """Arrays as text, the form both engines print alike."""
    return [F.array_join(F.col(a).cast("array<string>"), " ").alias(a) for a in arrays]


def _index(spark: SparkSession, sf_dir: str) -> packing.CorpusIndex:
    docs = fx.documents(spark, sf_dir).select("doc_id", "text")
    return packing.index_corpus(docs, TOKENIZER, C, order=by_value(docs, "doc_id"))


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.sequence_counts(_index(spark, sf_dir).chunks, L)


def _batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batching.assign_batches(_counts(spark, sf_dir), L, B, E, fx.SEED)


def _padded_chunks(spark: SparkSession, sf_dir: str, **options: object) -> DataFrame:
    rows = fx.padded_documents(spark, sf_dir)
    return corpus.assign_chunks(rows, C, order=by_value(rows, "row_key"), **options)


def scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan_corpus(spark, sf_dir, split="documents.parquet")
    return rows.select("doc_id", "lang", "source", F.length("text").cast("bigint").alias("chars"))


def toy_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.documents(spark, sf_dir).select("doc_id", "source", F.length("text").alias("replaced_chars"))
    ordered = corpus.row_ordinal(docs, by_value(docs, "doc_id"))
    return toy_texts(ordered, keep=("doc_id", "source", "replaced_chars"))


def row_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.documents(spark, sf_dir).select("doc_id", "n_chars")
    return corpus.row_ordinal(docs, by_value(docs, "n_chars", ["doc_id"])).select("doc_id", "row_idx")


def shuffle_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.documents(spark, sf_dir).select("doc_id")
    return corpus.shuffle_full(docs, fx.SEED, "doc_id")


def shuffle_buffered(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.documents(spark, sf_dir).select("doc_id")
    placed = corpus.row_ordinal(docs, by_value(docs, "doc_id"))
    return corpus.shuffle_buffered(placed, fx.SEED, "doc_id", buffer_size=64)


def skip_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.skip_rows(shuffle_full(spark, sf_dir), 37)


def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.normalize_text(fx.padded_documents(spark, sf_dir))


def nonempty_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.nonempty_docs(fx.padded_documents(spark, sf_dir))


def nonempty_docs_literal_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.nonempty_docs(fx.padded_documents(spark, sf_dir), null_text="literal")


def cap_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.padded_documents(spark, sf_dir)
    return corpus.cap_documents(rows, 150, order=by_hash(rows, fx.SEED, "row_key"))


def assign_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _padded_chunks(spark, sf_dir).select("row_key", "accepted", "accepted_before", "chunk_id")


def chunk_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.chunk_manifest(_padded_chunks(spark, sf_dir))


def chunk_manifest_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.chunk_manifest(_padded_chunks(spark, sf_dir, total_documents=150))


def tokenize_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = packing.tokenize_docs(corpus.nonempty_docs(fx.spread_documents(spark, sf_dir)), TOKENIZER)
    return docs.select("doc_id", "n_tok", *_words("tokens"))


class _OrdTokenizer:
    """The character tokenizer as a user's Python object."""

    eos_token_id = 0

    def encode(self, text: str, add_special_tokens: bool = False) -> list[int]:
        return [ord(c) % 31 + 1 for c in text]


def tokenize_python(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = corpus.nonempty_docs(fx.spread_documents(spark, sf_dir))
    return packing.tokenize_docs(docs, PythonTokenizer(_OrdTokenizer)).select(
        "doc_id", "n_tok", *_words("tokens")
    )


def token_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = corpus.shuffle_full(fx.documents(spark, sf_dir).select("doc_id", "text"), fx.SEED, "doc_id")
    docs = corpus.assign_chunks(rows, C).filter("accepted")
    sized = docs.select(
        "doc_id", "chunk_id", "row_idx", (TOKENIZER.count(F.col("text")) + 1).cast("bigint").alias("n_tok")
    )
    return packing.token_offsets(sized).drop("row_idx")


def sequence_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(spark, sf_dir)


def pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = packing.chunk_documents(_index(spark, sf_dir))
    packed = packing.pack_sequences(docs, L)
    return packed.select("chunk_id", "seq_id", *_words("input_ids", "labels"))


def shift_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = packing.tokenize_docs(corpus.nonempty_docs(fx.spread_documents(spark, sf_dir)), TOKENIZER)
    shifted = packing.shift_labels(docs.select("doc_id", "tokens"))
    return shifted.select("doc_id", *_words("input_ids", "labels"))


def assign_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batches(spark, sf_dir)


def collate_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = _index(spark, sf_dir)
    sequences = packing.pack_windows(packing.chunk_documents(index), L)
    batches = batching.assign_batches(packing.sequence_counts(index.chunks, L), L, B, E, fx.SEED)
    collated = batching.collate_batches(sequences, TOKENIZER.eos_token_id, batches)
    return collated.select(
        "chunk_id", "epoch", "batch_id", "seq_id", *_words("input_ids", "labels", "attention_mask")
    )


def expected_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batching.expected_steps(_counts(spark, sf_dir), B, E)


def batch_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batching.batch_token_counts(_batches(spark, sf_dir))


def global_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batching.global_steps(_counts(spark, sf_dir), B, E)


def masked_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loss of each batch under the token frequencies of the corpus."""
    index = _index(spark, sf_dir)
    batches = batching.assign_batches(packing.sequence_counts(index.chunks, L), L, B, 1, fx.SEED)
    sequences = packing.pack_windows(packing.chunk_documents(index), L)
    collated = batching.collate_batches(sequences, TOKENIZER.eos_token_id, batches)
    keys = ["chunk_id", "batch_id"]
    # Equal labels of a batch share one loss: count them first, per batch and label.
    counted = written(
        collated.select(*keys, F.explode("labels").alias("label"))
        .groupBy(*keys, "label")
        .agg(F.count("*").alias("weight")),
        "labels",
    )
    real = counted.filter(F.col("label") != batching.IGNORED_LABEL)
    frequency = real.groupBy("label").agg(F.sum("weight").alias("n"))
    total = frequency.agg(F.sum("n").alias("n")).first()["n"]
    losses = frequency.select("label", (-F.log(F.col("n") / F.lit(total))).alias("nll"))
    result = masked_mean_loss(counted.join(losses, "label", "left"), keys, weight="weight")
    return result.withColumn("mean_loss", F.round("mean_loss", 6))


def load_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The progress after the whole corpus, and the defaults where nothing was committed."""
    path = new_folder(spark, "progress")
    empty = progress_store.load_progress(spark, path).withColumn("state", F.lit("new"))
    progress_store.save_progress(progress_commit(spark, sf_dir), path)
    return empty.unionByName(
        progress_store.load_progress(spark, path).withColumn("state", F.lit("committed"))
    )


def progress_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commit every chunk with its progress, and read the progress back from the store."""
    manifest = written(corpus.chunk_manifest(_padded_chunks(spark, sf_dir)), "manifest")
    history = progress_history(manifest, batching.expected_steps(_counts(spark, sf_dir), B, E))
    output, store = new_folder(spark, "chunks"), new_folder(spark, "progress")
    progress_store.commit_chunks(manifest, history, output, store)
    kept = spark.read.parquet(output).select((F.col("chunk_id") + 1).alias("__next"))
    found = spark.read.schema(progress_store.PROGRESS_SCHEMA).json(store)
    found = found.withColumn("chunk_id", F.col("next_chunk_id") - 1).select(*history.columns)
    return found.join(kept, F.col("next_chunk_id") == F.col("__next"), "left_semi")


def resume_from_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the first half of the chunks, commit, resume behind them, and give all chunks."""
    rows = fx.padded_documents(spark, sf_dir)
    ordered = written(corpus.row_ordinal(rows, by_value(rows, "row_key")), "ordinal")
    output, store = new_folder(spark, "chunks"), new_folder(spark, "progress")

    manifest = corpus.chunk_manifest(corpus.assign_chunks(ordered, C))
    half = manifest.filter(F.col("chunk_id") < manifest.count() // 2)
    progress_store.commit_chunks(half, progress_history(half), output, store)

    done = progress_store.load_progress(spark, store).first()
    rest = corpus.assign_chunks(
        corpus.skip_rows(ordered, done["source_rows_consumed"]),
        C,
        first_chunk_id=done["next_chunk_id"],
    )
    resumed = corpus.chunk_manifest(rest)
    start = {name: done[name] for name in ("trained_documents", "source_rows_consumed", "global_step")}
    progress_store.commit_chunks(resumed, progress_history(resumed, start=start), output, store)
    return spark.read.parquet(output).select(
        F.col("chunk_id").cast("bigint"), "documents", "source_rows"
    )


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as a stream, of one file or a folder of files: a pattern names either.

    All files are one micro-batch, as a batch ends its last chunk and the chunks here run through the
    whole table.
    """
    rows = scan_corpus(
        spark, sf_dir, split="documents.parque[t]", streaming=True, schema=fx.documents(spark, sf_dir).schema
    ).select("doc_id", "text")
    output = new_folder(spark, "sequences")
    query = ingest_stream(
        rows,
        TOKENIZER,
        lambda batch: by_value(batch, "doc_id"),
        output,
        new_folder(spark, "progress"),
        new_folder(spark, "stream"),
        chunk_size=C,
        context_length=L,
        batch_size=B,
        epochs=E,
    )
    query.awaitTermination()
    return spark.read.parquet(output).select("chunk_id", "seq_id", *_words("input_ids", "labels"))


QUERIES = {
    "scan_corpus": scan,
    "toy_source": toy_source,
    "row_ordinal": row_ordinal,
    "shuffle_full": shuffle_full,
    "shuffle_buffered": shuffle_buffered,
    "skip_rows": skip_rows,
    "normalize_text": normalize_text,
    "nonempty_docs": nonempty_docs,
    "nonempty_docs_literal_null": nonempty_docs_literal_null,
    "cap_documents": cap_documents,
    "assign_chunks": assign_chunks,
    "chunk_manifest": chunk_manifest,
    "chunk_manifest_capped": chunk_manifest_capped,
    "tokenize_docs": tokenize_docs,
    "tokenize_python": tokenize_python,
    "token_offsets": token_offsets,
    "sequence_counts": sequence_counts,
    "pack_sequences": pack_sequences,
    "shift_labels": shift_labels,
    "assign_batches": assign_batches,
    "collate_batches": collate_batches,
    "expected_steps": expected_steps,
    "batch_token_counts": batch_token_counts,
    "global_steps": global_steps,
    "masked_mean_loss": masked_loss,
    "load_progress": load_progress,
    "progress_commit": progress_commit,
    "resume_from_progress": resume_from_progress,
    "stream_ingest": stream_ingest,
}

# --- the same in DuckDB SQL -----------------------------------------------------------------

_STRIP = "||".join(f"chr({code})" for code in WHITESPACE)

_PADDED = f"""raw AS (
  SELECT doc_id * 2 + v AS row_key,
         CASE WHEN v = 0 THEN chr(9) || chr(28) || ' ' || text || ' ' || chr(8195) || chr(10)
              WHEN doc_id % 3 = 0 THEN '   '
              WHEN doc_id % 3 = 1 THEN chr(160) || chr(9) || chr(8195)
         END AS text
  FROM documents, (SELECT unnest([0, 1]) AS v)),
clean AS (SELECT row_key, trim(text, {_STRIP}) AS text FROM raw),
flagged AS (SELECT *, coalesce(length(text), 0) > 0 AS accepted FROM clean),
counted AS (
  SELECT *, (coalesce(sum(accepted::BIGINT) OVER (ORDER BY row_key
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS accepted_before
  FROM flagged)"""


def _docs_sql(order: str = "doc_id") -> str:
    return f"""docs AS (
  SELECT doc_id, text, (row_number() OVER (ORDER BY {order}) - 1) // {C} AS chunk_id,
         row_number() OVER (ORDER BY {order}) - 1 AS row_idx, length(text) + 1 AS n_tok
  FROM (SELECT doc_id, trim(text, {_STRIP}) AS text FROM documents) WHERE length(text) > 0),
placed AS (
  SELECT *, (sum(n_tok) OVER (PARTITION BY chunk_id ORDER BY row_idx) - n_tok)::BIGINT AS tok_start,
         (sum(n_tok) OVER (PARTITION BY chunk_id))::BIGINT AS chunk_tokens
  FROM docs)"""


_COUNTS = f"""{_docs_sql()},
counts AS (
  SELECT chunk_id, sum(n_tok)::BIGINT AS chunk_tokens,
         ceil((sum(n_tok) - 1) / {L})::BIGINT AS sequences
  FROM docs GROUP BY chunk_id)"""

_IDS = "list_append(list_transform(string_split(text, ''), lambda c: unicode(c) % 31 + 1), 0)"

_PACKED = f"""{_COUNTS},
flat AS (
  SELECT chunk_id, chunk_tokens, tok_start + unnest(range(n_tok)) AS pos, unnest({_IDS}) AS tok
  FROM placed),
windows AS (
  SELECT chunk_id, chunk_tokens, pos // {L} AS seq_id, pos, tok FROM flat
  UNION ALL
  SELECT chunk_id, chunk_tokens, pos // {L} - 1, pos, tok FROM flat WHERE pos % {L} = 0 AND pos > 0),
packed AS (
  SELECT chunk_id, seq_id, list(tok ORDER BY pos) AS tokens FROM windows
  WHERE seq_id < ceil((chunk_tokens - 1) / {L}) GROUP BY chunk_id, seq_id),
sequences AS (
  SELECT chunk_id, seq_id, tokens[1:len(tokens) - 1] AS input_ids, tokens[2:] AS labels FROM packed)"""


def _batches_sql(epochs: int) -> str:
    return f"""seqs AS (
  SELECT chunk_id, chunk_tokens, sequences AS n, unnest(range(sequences)) AS seq_id FROM counts),
passes AS (SELECT *, unnest(range({epochs})) AS epoch FROM seqs),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY chunk_id, epoch
              ORDER BY md5('{fx.SEED}:' || chunk_id || ':' || epoch || ':' || seq_id), seq_id) - 1 AS rank
  FROM passes),
sized AS (
  SELECT chunk_id, epoch, rank // {B} AS batch_id, rank, seq_id,
         least({L}, chunk_tokens - 1 - seq_id * {L}) AS n_tokens FROM ranked),
batches AS (
  SELECT *, max(n_tokens) OVER (PARTITION BY chunk_id, epoch, batch_id) AS batch_len FROM sized)"""


def _text(array: str, name: str) -> str:
    return f"array_to_string({array}, ' ') AS {name}"


def _manifest_sql(where: str = "") -> str:
    return f"""manifest AS (
  SELECT accepted_before // {C} AS chunk_id, sum(accepted::BIGINT)::BIGINT AS documents,
         count(*) AS source_rows
  FROM counted {where} GROUP BY 1 HAVING sum(accepted::BIGINT) > 0)"""


_TOYS = ", ".join("'" + text.replace("'", "''") + "'" for text in TOY_TEXTS)
_SHUFFLED = (
    f"SELECT doc_id, row_number() OVER (ORDER BY md5('{fx.SEED}:' || doc_id), doc_id) - 1 AS row_idx "
    "FROM documents"
)
_TOKENS = f"""SELECT doc_id, n_tok, {_text(_IDS, "tokens")} FROM docs"""
_HISTORY = f"""WITH {_PADDED}, {_manifest_sql()}, {_COUNTS},
steps AS (SELECT chunk_id, ceil(sequences / {B})::BIGINT * {E} AS n FROM counts),
history AS (
  SELECT chunk_id,
         (sum(documents) OVER w)::BIGINT AS trained_documents,
         (sum(source_rows) OVER w)::BIGINT AS source_rows_consumed,
         (sum(n) OVER w)::BIGINT AS global_step,
         chunk_id + 1 AS next_chunk_id,
         printf('checkpoint-chunk-%06d.pt', chunk_id) AS checkpoint_path
  FROM manifest JOIN steps USING (chunk_id) WINDOW w AS (ORDER BY chunk_id))"""

ORACLES = {
    "scan_corpus": "SELECT doc_id, lang, source, length(text) AS chars FROM documents",
    "toy_source": f"""SELECT row_idx, doc_id, source, replaced_chars, [{_TOYS}][row_idx % 4 + 1] AS text
        FROM (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_idx, doc_id, source,
                     length(text) AS replaced_chars FROM documents)""",
    "row_ordinal": "SELECT doc_id, row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS row_idx FROM documents",
    "shuffle_full": _SHUFFLED,
    "shuffle_buffered": f"""WITH o AS (
          SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 64 AS blk FROM documents)
        SELECT doc_id, blk * 64 + row_number() OVER (PARTITION BY blk
                 ORDER BY md5('{fx.SEED}:' || doc_id), doc_id) - 1 AS row_idx FROM o""",
    "skip_rows": f"SELECT * FROM ({_SHUFFLED}) WHERE row_idx >= 37",
    "normalize_text": f"WITH {_PADDED} SELECT row_key, text FROM clean",
    "nonempty_docs": f"WITH {_PADDED} SELECT row_key, text FROM flagged WHERE accepted",
    "nonempty_docs_literal_null": f"""WITH {_PADDED}
        SELECT row_key, coalesce(text, 'None') AS text FROM clean
        WHERE length(coalesce(text, 'None')) > 0""",
    "cap_documents": f"""WITH {_PADDED}
        SELECT row_key, text FROM flagged WHERE accepted
        ORDER BY md5('{fx.SEED}:' || row_key), row_key LIMIT 150""",
    "assign_chunks": f"""WITH {_PADDED}
        SELECT row_key, accepted, accepted_before, accepted_before // {C} AS chunk_id FROM counted""",
    "chunk_manifest": f"WITH {_PADDED}, {_manifest_sql()} SELECT * FROM manifest",
    "chunk_manifest_capped": f"""WITH {_PADDED}, {_manifest_sql('WHERE accepted_before < 150')}
        SELECT * FROM manifest""",
    "tokenize_docs": f"WITH {_docs_sql()} {_TOKENS}",
    "tokenize_python": f"WITH {_docs_sql()} {_TOKENS}",
    "token_offsets": f"""WITH {_docs_sql(f"md5('{fx.SEED}:' || doc_id), doc_id")}
        SELECT doc_id, chunk_id, n_tok, tok_start, chunk_tokens FROM placed""",
    "sequence_counts": f"WITH {_COUNTS} SELECT * FROM counts",
    "pack_sequences": f"""WITH {_PACKED}
        SELECT chunk_id, seq_id, {_text('input_ids', 'input_ids')}, {_text('labels', 'labels')}
        FROM sequences""",
    "shift_labels": f"""WITH {_docs_sql()}, t AS (SELECT doc_id, {_IDS} AS tokens FROM docs)
        SELECT doc_id, {_text('tokens[1:len(tokens) - 1]', 'input_ids')},
               {_text('tokens[2:]', 'labels')} FROM t""",
    "assign_batches": f"WITH {_COUNTS}, {_batches_sql(E)} SELECT * FROM batches",
    "collate_batches": f"""WITH {_PACKED}, {_batches_sql(E)}
        SELECT chunk_id, epoch, batch_id, seq_id,
               {_text('list_resize(input_ids, batch_len, 0)', 'input_ids')},
               {_text('list_resize(labels, batch_len, -100)', 'labels')},
               {_text('list_resize(list_transform(input_ids, lambda x: 1), batch_len, 0)', 'attention_mask')}
        FROM sequences JOIN batches USING (chunk_id, seq_id)""",
    "expected_steps": f"""WITH {_COUNTS}
        SELECT *, ceil(sequences / {B})::BIGINT AS batches,
               ceil(sequences / {B})::BIGINT * {E} AS expected_steps FROM counts""",
    "batch_token_counts": f"""WITH {_COUNTS}, {_batches_sql(E)}
        SELECT chunk_id, epoch, batch_id, sum(n_tokens)::BIGINT AS tokens, count(*) AS samples
        FROM batches GROUP BY ALL""",
    "global_steps": f"""WITH {_COUNTS}, {_batches_sql(E)},
        b AS (SELECT DISTINCT chunk_id, epoch, batch_id FROM batches)
        SELECT *, row_number() OVER (ORDER BY chunk_id, epoch, batch_id) AS global_step FROM b""",
    "masked_mean_loss": f"""WITH {_PACKED}, {_batches_sql(1)},
        l AS (SELECT chunk_id, batch_id, unnest(labels) AS label
              FROM sequences JOIN batches USING (chunk_id, seq_id)),
        f AS (SELECT label, -ln(count(*) / (SELECT count(*) FROM l)) AS nll FROM l GROUP BY label)
        SELECT chunk_id, batch_id, round(avg(nll), 6) AS mean_loss, count(*) AS label_count
        FROM l JOIN f USING (label) GROUP BY chunk_id, batch_id""",
    "load_progress": f"""{_HISTORY}
        SELECT trained_documents, source_rows_consumed, next_chunk_id, global_step, checkpoint_path,
               'committed' AS state
        FROM history WHERE chunk_id = (SELECT max(chunk_id) FROM history)
        UNION ALL SELECT 0, 0, 0, 0, '', 'new'""",
    "progress_commit": f"{_HISTORY} SELECT * FROM history",
    "resume_from_progress": f"WITH {_PADDED}, {_manifest_sql()} SELECT * FROM manifest",
    "stream_ingest": f"""WITH {_PACKED}
        SELECT chunk_id, seq_id, {_text('input_ids', 'input_ids')}, {_text('labels', 'labels')}
        FROM sequences""",
}
