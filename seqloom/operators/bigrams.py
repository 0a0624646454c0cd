"""Bigram counts that blocks of documents ask of a base corpus, each different bigram once per block.

Tokens become blocks of documents, written once. A block of the base sends the counts of its different
bigrams, a block of the scored documents asks for those of its own: a row per block and shard of the
bigrams' hash, its bigrams sorted in one compressed text. A shard adds up what was sent and answers each
block that asked. A frequent bigram comes at most once per block, so no shard is hot. The hash only
deals bigrams out to shards; they are told apart by their words. A bigram with an empty second word
stands for all bigrams of its first one.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StringType, StructField, StructType

from seqloom.functions.batches import slices
from seqloom.session import written

#: Tokens of a block, and characters of all texts to a shard.
BLOCK, SHARD = 1 << 20, 1 << 24

_REQUEST = [
    StructField("shard", LongType()),
    StructField("block", StringType()),
    StructField("pairs", BinaryType()),
    StructField("counts", BinaryType()),
]
_ANSWER = "block string, shard long, counts binary"


def _packed(values: np.ndarray | memoryview) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(values)


def _unpacked(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


def _numbers(values: np.ndarray) -> bytes:
    """Not negative whole numbers, byte planes apart: most of the upper bytes are zero."""
    return _packed(np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes())


def _as_numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(_unpacked(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


class _Pairs:
    """The different bigrams of some texts by shard, and the place of each token's bigram among them."""

    def __init__(self, tokens: pa.Array, lengths: np.ndarray, shards: int):
        coded = tokens.cast(pa.large_string()).dictionary_encode()
        order = pc.sort_indices(coded.dictionary).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(1, len(order) + 1)
        words = pa.concat_arrays([pa.array([""], pa.large_string()), coded.dictionary.take(pa.array(order))])
        own = rank[coded.indices.to_numpy(zero_copy_only=False)]
        before = np.roll(own, 1)
        before[np.cumsum(lengths) - lengths] = 0  # a text starts behind an empty word
        size = len(words)
        keys, place = np.unique(np.concatenate([before * size + own, before * size]), return_inverse=True)
        first, second = keys // size, keys % size
        hashes = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words.to_pylist()], np.uint64)
        mixed = (hashes[first] * np.uint64(0x9E3779B97F4A7C15) + hashes[second]) * np.uint64(0xD6E8FEB86659FD93)
        shard = ((mixed >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)
        dealt = np.argsort(shard, kind="stable")
        at = np.empty(len(keys), np.int64)
        at[dealt] = np.arange(len(keys))
        places = at[place].reshape(2, -1)
        #: Of each token's bigram, and of the one that stands for all with the same first word.
        self.places, self.contexts = places
        lines = pc.binary_join_element_wise(words, pa.scalar("\n", pa.large_string()), pa.scalar("", pa.large_string()))
        text = pc.binary_join_element_wise(
            words.take(pa.array(first[dealt])), lines.take(pa.array(second[dealt])), pa.scalar(" ", pa.large_string())
        )
        self.size, self.shard = len(keys), shard[dealt]
        self.ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        self.text = memoryview(text.buffers()[2])

    def by_shard(self) -> Iterator[tuple[int, int, int, bytes]]:
        """(shard, first, end, bigrams): the places of each shard that has any, and their bigrams, a line each."""
        found, first = np.unique(self.shard, return_index=True)
        for shard, a, b in zip(found, first, [*first[1:], self.size], strict=True):
            yield int(shard), int(a), int(b), _packed(self.text[self.ends[a] : self.ends[b]])


def _answer(requests: pa.Table) -> pa.Table:
    """The counts of one shard for every block that asked."""
    rows = requests.to_pylist()
    parts = [_unpacked(row["pairs"]) for row in rows]
    text = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.concatenate([[0], np.flatnonzero(text == 10) + 1]).astype(np.int64)
    lines = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(text)])
    own = lines.dictionary_encode()
    numbers = own.indices.to_numpy(zero_copy_only=False)
    cuts = np.searchsorted(ends, np.cumsum([len(part) for part in parts]))
    totals, answers = np.zeros(len(own.dictionary), np.int64), []
    for row, a, b in zip(rows, [0, *cuts[:-1]], cuts, strict=True):
        if row["counts"] is not None:
            totals[numbers[a:b]] += _as_numbers(row["counts"])
    for row, a, b in zip(rows, [0, *cuts[:-1]], cuts, strict=True):
        if row["counts"] is None:
            answers.append({"block": row["block"], "shard": row["shard"], "counts": _numbers(totals[numbers[a:b]])})
    return pa.Table.from_pylist(answers, pa.schema([("block", pa.string()), ("shard", pa.int64()), ("counts", pa.binary())]))


def _texts(batch: pa.RecordBatch, block: int) -> Iterator[tuple[pa.RecordBatch, pa.Array, np.ndarray]]:
    """Neighbours of a batch, about `block` tokens together, with their tokens and numbers of tokens."""
    sizes = pc.list_value_length(batch.column("tokens")).to_numpy(zero_copy_only=False).astype(np.int64)
    for first, end in slices(sizes.tolist(), len(sizes), block):
        part = batch.slice(first, end - first)
        yield part, part.column("tokens").flatten(), sizes[first:end]


def log_chances(
    base: DataFrame, docs: DataFrame, tokens: Column, size: int, extra: float, key: str, text: str, block: int = BLOCK, shard: int = SHARD
) -> DataFrame:
    """key, `tokens` and `log` of every row of `docs` with a token: how many, and the sum of their log chances.

    `tokens` makes the tokens of `text` in either table, none of them empty or with white space; `size` is
    how many different words the model has.
    """
    lengths = base.select(F.length(text).alias("n")).unionByName(docs.select(F.length(text).alias("n")))
    shards = max(8, -(-(lengths.agg(F.sum("n")).first()[0] or 0) // shard))
    some = F.size("tokens") > 0
    given = base.select(tokens.alias("tokens")).where(some)
    asked = docs.select(F.col(key).alias("key"), tokens.alias("tokens")).where(some)

    def give(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, words, lengths in _texts(batch, block):
                pairs = _Pairs(words, lengths, shards)
                counts = np.bincount(np.concatenate([pairs.places, pairs.contexts]), minlength=pairs.size)
                rows = [{"shard": n, "pairs": text, "counts": _numbers(counts[a:b])} for n, a, b, text in pairs.by_shard()]
                yield pa.RecordBatch.from_pylist(rows, to_arrow_schema(StructType(_REQUEST)))

    names = ("ids", "lengths", "places", "contexts")
    kinds = (ArrayType(asked.schema["key"].dataType), ArrayType(LongType()), BinaryType(), BinaryType())
    schema = StructType([*_REQUEST, *(StructField(*field) for field in zip(names, kinds, strict=True))])

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, words, lengths in _texts(batch, block):
                pairs, name = _Pairs(words, lengths, shards), uuid.uuid4().hex
                context = np.zeros(pairs.size, np.int64)
                context[pairs.places] = pairs.contexts
                row = {"block": name, "ids": part.column("key").to_pylist(), "lengths": lengths.tolist()}
                row |= {"places": _numbers(pairs.places), "contexts": _numbers(context)}
                rows = [{"shard": n, "block": name, "pairs": text} for n, _, _, text in pairs.by_shard()]
                yield pa.RecordBatch.from_pylist([row, *rows], to_arrow_schema(schema))

    blocks = written(asked.mapInArrow(ask, schema), "bigram-blocks")
    columns = [field.name for field in _REQUEST]
    requests = blocks.where("shard is not null").select(columns).unionByName(given.mapInArrow(give, StructType(_REQUEST)))
    answers = requests.groupBy("shard").applyInArrow(_answer, _ANSWER)
    found = StructType([StructField(key, kinds[0].elementType), StructField("tokens", LongType()), StructField("log", DoubleType())])

    def score(own: pa.Table, answered: pa.Table) -> pa.Table:
        row = own.slice(0, 1)
        order = np.argsort(answered.column("shard").to_numpy())
        parts = answered.column("counts").to_pylist()
        counts = np.concatenate([_as_numbers(parts[n]) for n in order])
        places, context = (_as_numbers(row.column(name)[0].as_py()) for name in ("places", "contexts"))
        lengths = row.column("lengths").combine_chunks().flatten().to_numpy()
        logs = np.log((counts + extra) / (counts[context] + extra * size))
        sums = np.add.reduceat(logs[places], np.cumsum(lengths) - lengths)
        return pa.table([row.column("ids").combine_chunks().flatten(), pa.array(lengths), pa.array(sums)], to_arrow_schema(found))

    documents = blocks.where("shard is null").select("block", *names)
    return documents.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, found)
