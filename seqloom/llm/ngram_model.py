"""Operator 10, language-model scores by deleted interpolation.

The model mixes bigram, unigram and uniform estimates. The mixture weights depend on how often the
context was seen (one set per power of two) and are learned by expectation-maximisation: one fold of
the training documents is deleted from the counts and the weights are fitted to that fold's counts.
The scores use the counts of all training documents.

Nothing is broadcast and no table goes through the driver. Texts become blocks of about
`block_tokens` tokens, written once. Each block asks for the corpus counts of its different words,
then of its different bigrams, as packed sorted hashes, one row per block and shard of the hash
range; the shard adds up what all blocks sent and answers each with the totals. Shards are cut so
that each holds about `shard_keys` keys, and a frequent word or bigram comes at most once per block,
so no key is hot. Expectation-maximisation reads the shards' deleted counts in parallel, round by
round; only its sums per weight reach the driver. A lost executor costs the running stage only:
blocks and answers are tables in the shared folder.

Words are told apart by 64-bit hashes.

Defined results: null and blank texts consist of the end token; with no training rows all counts are
zero and a text has base score 0; repeated rows count as often as they are there; a null key
is neither held out nor learned from.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DoubleType, LongType, StringType, StructField, StructType

from seqloom.llm.common import fold, narrow, table
from seqloom.llm.packed import as_table, pack, pack_keys, shard_bits, shard_slices, unpack, unpack_keys
from seqloom.session import written

FOLDS, HELD_OUT, DELETED = 7, 2, 3
BLOCK_TOKENS = 1 << 20
SHARD_KEYS = 1 << 20
ROUNDS, CLOSE = 12, 1e-3
BUCKETS = 64
#: What a document's counts are for: the main part, the deleted part, no training.
MAIN, LEFT_OUT, UNSEEN, KEYLESS = 0, 1, 2, 3


@dataclass(frozen=True)
class Totals:
    """Training tokens, their main part, and different training tokens."""

    tokens: int
    main: int
    types: int


def _pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = left * np.uint64(0x9E3779B97F4A7C15) + right
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(32))


def _bucket(counts: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one more than the power of two it has reached."""
    return np.frexp(counts.astype(np.float64))[1].clip(0, BUCKETS - 1)


class Block:
    """Documents as numbers of words; numbers are places among the block's sorted word hashes."""

    def __init__(self, kinds: np.ndarray, lengths: np.ndarray, tokens: np.ndarray, words: np.ndarray):
        self.kinds, self.lengths, self.tokens, self.words = kinds, lengths, tokens, words
        self.kind_of_token = np.repeat(kinds, lengths)

    @staticmethod
    def of(texts: list[str | None], kinds: list[int]) -> Block:
        import xxhash

        seen: dict[bytes, int] = {b"": 0}  # the end token; no word is empty
        lengths, numbers = [], []
        for text in texts:
            words = (text or "").encode().lower().split()
            numbers.extend([seen.setdefault(w, len(seen)) for w in words])
            numbers.append(0)
            lengths.append(len(words) + 1)
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in seen), dtype=np.uint64, count=len(seen))
        words, place = np.unique(hashes, return_inverse=True)
        tokens = place[np.array(numbers, dtype=np.int64)]
        return Block(np.array(kinds, dtype=np.uint8), np.array(lengths, dtype=np.int64), tokens, words)

    def packed(self) -> tuple[bytes, bytes, bytes, bytes]:
        return pack(self.kinds), pack(self.lengths), pack(self.tokens), pack_keys(self.words)

    @staticmethod
    def unpacked(row: pa.Table) -> Block:
        parts = [row.column(name)[0].as_py() for name in ("kinds", "lengths", "tokens", "words")]
        kinds, lengths, tokens = (unpack(p).astype(np.int64) for p in parts[:3])
        return Block(kinds, lengths, tokens, unpack_keys(parts[3]))

    def counts(self, numbers: np.ndarray, kind: int, size: int) -> np.ndarray:
        return np.bincount(numbers[self.kind_of_token == kind], minlength=size)

    def contexts(self) -> np.ndarray:
        """The number of the word before each token; `len(words)` stands for the start of a text."""
        before = np.roll(self.tokens, 1)
        before[np.cumsum(self.lengths) - self.lengths] = len(self.words)
        return before

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Different bigram keys, sorted; a place of each; the number of each token's bigram."""
        import xxhash

        hashes = np.append(self.words, np.uint64(xxhash.xxh64_intdigest(b" ")))  # no word is a space
        return np.unique(_pair_keys(hashes[self.contexts()], self.words[self.tokens]), return_index=True, return_inverse=True)


def _requests(block: str, bits: int, keys: np.ndarray, main: np.ndarray, left: np.ndarray, sides=None) -> list[dict]:
    """One row per shard of the hash range that the block has keys in."""
    rows = []
    for shard, a, b in shard_slices(keys, bits):
        row = {"shard": shard, "block": block, "keys": pack_keys(keys[a:b]), "main": pack(main[a:b]), "left": pack(left[a:b])}
        if sides is not None:
            row["sides"] = pack(np.concatenate([side[a:b][left[a:b] > 0] for side in sides]))
        rows.append(row)
    return rows


REQUEST = StructType(
    [StructField("shard", LongType()), StructField("block", StringType())]
    + [StructField(name, BinaryType()) for name in ("keys", "main", "left", "sides")]
)
ANSWER = StructType(
    [
        StructField("block", StringType()),
        StructField("shard", LongType()),
        StructField("counts", BinaryType()),
        StructField("main_counts", BinaryType()),
        StructField("tokens", LongType()),
        StructField("main_tokens", LongType()),
        StructField("types", LongType()),
        StructField("deleted", BinaryType()),
    ]
)


def _answer(requests: pa.Table) -> pa.Table:
    """The totals of one shard for every block that asked, and a row of sums without a block."""
    rows = requests.to_pylist()
    keys = [unpack_keys(r["keys"]) for r in rows]
    main, left = (np.concatenate([unpack(r[name]) for r in rows]) for name in ("main", "left"))
    found, place = np.unique(np.concatenate(keys), return_inverse=True)
    main_sum, left_sum = (np.bincount(place, weights=n, minlength=len(found)).astype(np.int64) for n in (main, left))
    total = main_sum + left_sum
    answers, end = [], 0
    for row, own in zip(rows, keys, strict=True):
        at, end = place[end : end + len(own)], end + len(own)
        answers.append({"block": row["block"], "shard": row["shard"], "counts": pack(total[at]), "main_counts": pack(main_sum[at])})
        if row["sides"] is not None:
            del answers[-1]["main_counts"]
    sums = {"shard": rows[0]["shard"], "tokens": int(total.sum()), "main_tokens": int(main_sum.sum()), "types": int((total > 0).sum())}
    if rows[0]["sides"] is not None:  # bigrams: counts of context and word, the same from every block
        asked = left > 0
        sides = [unpack(r["sides"]).reshape(2, -1) for r in rows]
        spread = np.zeros((2, len(found)), dtype=np.int64)
        spread[:, place[asked]] = np.concatenate(sides, axis=1)
        kept = left_sum > 0
        sums["deleted"] = pack(np.concatenate([left_sum[kept], main_sum[kept], spread[0][kept], spread[1][kept]]))
    return as_table([*answers, sums], ANSWER)


def _exchange(requests: DataFrame, label: str) -> DataFrame:
    return written(requests.groupBy("shard").applyInArrow(_answer, ANSWER), label)


def _aligned(answers: pa.Table, name: str = "counts") -> np.ndarray:
    """Counts in the order of the block's sorted keys: shards are ranges of them."""
    rows = sorted(zip(answers.column("shard").to_pylist(), answers.column(name).to_pylist(), strict=True))
    return np.concatenate([unpack(data) for _, data in rows]).astype(np.int64)


def to_blocks(docs: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of documents (`doc_id`, `text`, `kind`), written to the shared folder."""
    schema = StructType(
        [StructField("block", StringType()), StructField("ids", ArrayType(docs.schema["doc_id"].dataType))]
        + [StructField(name, BinaryType()) for name in ("kinds", "lengths", "tokens", "words")]
        + [StructField(name, LongType()) for name in ("n_tokens", "n_words")]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)

        def block(ids, texts, kinds):
            made = Block.of(texts, kinds)
            row = dict(zip(("kinds", "lengths", "tokens", "words"), made.packed(), strict=True))
            row |= {"block": uuid.uuid4().hex, "ids": ids, "n_tokens": len(made.tokens), "n_words": len(made.words)}
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        ids, texts, kinds, size = [], [], [], 0
        for batch in batches:
            for key, text, kind in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids.append(key)
                texts.append(text)
                kinds.append(kind)
                size += len(text or "") // 5 + 1
                if size >= block_tokens:
                    yield block(ids, texts, kinds)
                    ids, texts, kinds, size = [], [], [], 0
        if ids:
            yield block(ids, texts, kinds)

    return written(docs.select("doc_id", "text", "kind").mapInArrow(run, schema), "token-blocks")


def learn_weights(deleted: DataFrame, totals: Totals, rounds: int = ROUNDS, close: float = CLOSE) -> np.ndarray:
    """Weights of bigram, unigram and uniform estimate by context bucket, by EM on the deleted counts."""
    uniform, main = 1.0 / (totals.types + 1), max(1, totals.main)
    weights = np.full((BUCKETS, 3), 1.0 / 3)
    for _ in range(rounds):
        now = weights.copy()

        def expect(batches: Iterable[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((BUCKETS, 3))
            for batch in batches:
                for data in batch.column(0).to_pylist():
                    n, both, context, word = unpack(data).astype(np.float64).reshape(4, -1)
                    bucket = _bucket(context)
                    parts = np.stack([both / np.maximum(context, 1), word / main, np.full(len(n), uniform)], axis=1) * now[bucket]
                    parts *= (n / parts.sum(axis=1))[:, None]
                    for k in range(3):
                        sums[:, k] += np.bincount(bucket, weights=parts[:, k], minlength=BUCKETS)
            yield pa.RecordBatch.from_pydict({"bucket": list(range(BUCKETS)), **{f"s{k}": sums[:, k] for k in range(3)}})

        found = deleted.mapInArrow(expect, "bucket long, s0 double, s1 double, s2 double").groupBy("bucket")
        sums = np.zeros((BUCKETS, 3))
        for row in found.agg(*(F.sum(f"s{k}") for k in range(3))).collect():
            sums[row[0]] = row[1:]
        seen = sums.sum(axis=1) > 0
        weights[seen] = sums[seen] / sums[seen].sum(axis=1, keepdims=True)
        if seen.any():  # contexts of a frequency that the deleted fold lacks mix as all do
            weights[~seen] = sums.sum(axis=0) / sums.sum()
        if np.abs(weights - now).max() < close:
            break
    return weights


def score_documents(
    docs: DataFrame,
    folds: int = FOLDS,
    held_out: int = HELD_OUT,
    deleted: int = DELETED,
    block_tokens: int = BLOCK_TOKENS,
    shard_keys: int = SHARD_KEYS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 of probabilities)."""
    fold_of = fold(F.col("doc_id"), folds)
    kind = F.when(fold_of.isNull(), KEYLESS).when(fold_of == held_out, UNSEEN).when(fold_of == deleted, LEFT_OUT).otherwise(MAIN)
    source = narrow(docs, id_col, text_col).withColumn("kind", kind)
    blocks = to_blocks(source, block_tokens)
    sizes = blocks.agg(F.sum("n_words"), F.sum("n_tokens")).first()
    word_bits, pair_bits = (shard_bits(n or 0, shard_keys) for n in sizes)

    def ask_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                row = pa.Table.from_batches([batch.slice(n, 1)])
                block, size = Block.unpacked(row), row.column("n_words")[0].as_py()
                main, left = (block.counts(block.tokens, k, size) for k in (MAIN, LEFT_OUT))
                yield from as_table(_requests(row.column("block")[0].as_py(), word_bits, block.words, main, left), REQUEST).to_batches()

    words = _exchange(blocks.mapInArrow(ask_words, REQUEST), "word-counts")
    sums = words.where("block is null").agg(F.sum("tokens"), F.sum("main_tokens"), F.sum("types")).first()
    totals = Totals(*(n or 0 for n in sums))

    def ask_pairs(row: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block.unpacked(row)
        keys, first, number = block.pairs()
        main, left = (block.counts(number, k, len(keys)) for k in (MAIN, LEFT_OUT))
        seen = _aligned(answers, "main_counts")
        starts = np.append(seen, 0)  # a text starts as often as one ends
        starts[-1] = seen[block.tokens[block.lengths[0] - 1]]
        sides = starts[block.contexts()[first]], seen[block.tokens[first]]
        return as_table(_requests(row.column("block")[0].as_py(), pair_bits, keys, main, left, sides), REQUEST)

    asked = words.where("block is not null")
    pairs = _exchange(
        blocks.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(ask_pairs, REQUEST), "pair-counts"
    )
    weights = learn_weights(pairs.where("deleted is not null").select("deleted"), totals)

    schema = StructType(
        [docs.select(F.col(id_col).alias("doc_id")).schema["doc_id"], StructField("held_out", BooleanType())]
        + [StructField(name, LongType()) for name in ("n_tokens", "n_known", "train_tokens")]
        + [StructField(name, DoubleType()) for name in ("base_score", "score")]
    )
    arrow = to_arrow_schema(schema)

    def score(row: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block.unpacked(row)
        of_pairs = answers.column("of_pairs").to_numpy(zero_copy_only=False).astype(bool)
        words_seen = _aligned(answers.filter(pa.array(~of_pairs)))
        pairs_seen = _aligned(answers.filter(pa.array(of_pairs)))
        count = words_seen[block.tokens]
        starts = np.append(words_seen, words_seen[block.tokens[block.lengths[0] - 1]])
        context = starts[block.contexts()]
        both = pairs_seen[block.pairs()[2]]
        mix = weights[_bucket(context)]
        estimate = mix[:, 0] * both / np.maximum(context, 1) + mix[:, 1] * count / max(1, totals.tokens)
        model = np.log10(estimate + mix[:, 2] / (totals.types + 1))
        base = np.log10((count + 1) / (totals.tokens + totals.types + 1))
        first = np.cumsum(block.lengths) - block.lengths
        columns = {
            "doc_id": row.column("ids").combine_chunks().flatten(),
            "held_out": block.kinds == UNSEEN,
            "n_tokens": block.lengths,
            "n_known": np.add.reduceat((count > 0).astype(np.int64), first),
            "train_tokens": np.full(len(first), totals.tokens),
            "base_score": np.add.reduceat(base, first),
            "score": np.add.reduceat(model, first),
        }
        return pa.table([pa.array(columns[f.name]).cast(f.type) for f in arrow], schema=arrow)

    answered = words.select("block", "shard", "counts", F.lit(False).alias("of_pairs")).union(
        pairs.select("block", "shard", "counts", F.lit(True).alias("of_pairs"))
    )
    answered = answered.where("block is not null")
    return blocks.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(score, schema)


def op10_ngram_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
