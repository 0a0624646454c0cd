"""Operator 9, substring deduplication with repeated-phrase automata.

A window is `window` consecutive words. Every window after the first with the same words goes: each
word it covers is removed, judged on the input.

Texts become blocks of about `block_words` words, written once. Recurring passages are confirmed in
two exchanges of packed hashes between blocks and shards of the hash range:

1. Anchors. Of the `gram`-word groups in a window, the one with the least hash is its anchor. Equal
   windows have equal anchors, and about one group in eight is an anchor. Blocks learn which
   of their anchors occur twice or more anywhere; other windows are unique.
2. Windows. For each different remaining window a block sends its hash and its first place here; the
   shard answers which of them recur, and whether the first place of all is in that block.

Then every block compiles its recurring windows into an Aho-Corasick automaton, one shard of all
phrases, and streams its documents through it. Every occurrence but the first of all is removed.

Nothing is broadcast or collected. A passage comes at most once per block to a shard, so a frequent
one is not hot, and no task holds more than a block or a shard. Words and windows are told apart
across blocks by 64-bit hashes, inside a block by the words themselves.

Defined results: null and blank texts have no words; texts shorter than a window are kept; rows
repeated under one key hold the same windows at the same places, so that neither repeats the other;
null keys come after all others.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from seqloom.llm.common import narrow, table
from seqloom.llm.packed import as_table, pack, pack_keys, shard_bits, shard_slices, unpack, unpack_keys
from seqloom.session import written

WINDOW, GRAM = 20, 6
BLOCK_WORDS = 1 << 18
SHARD_KEYS = 1 << 20
#: Keys order as unsigned numbers; a null key is the last.
LAST = np.uint64(2**64 - 1)
_SIGN = np.uint64(1 << 63)
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

BLOCK = StructType(
    [StructField("block", StringType()), StructField("ids", ArrayType(LongType())), StructField("texts", BinaryType())]
    + [StructField("n_words", LongType()), StructField("anchors", BinaryType()), StructField("times", BinaryType())]
)
REQUEST = StructType(
    [StructField("shard", LongType()), StructField("block", StringType())]
    + [StructField(name, BinaryType()) for name in ("keys", "times", "docs", "starts")]
)
ANSWER = StructType(
    [StructField("block", StringType()), StructField("shard", LongType())]
    + [StructField(name, BinaryType()) for name in ("keys", "first")]
)


def _rolled(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every `size` consecutive ones, at the place of the first; shorter ends are left out."""
    rolled = np.zeros(max(0, len(hashes) - size + 1), dtype=np.uint64)
    for k in range(size):
        rolled = rolled * _BASE + hashes[k : k + len(rolled)]
    rolled ^= rolled >> np.uint64(31)
    rolled *= _MIX
    return rolled ^ (rolled >> np.uint64(32))


def _sliding(values: np.ndarray, size: int, least: bool) -> np.ndarray:
    """The least or greatest of every `size` consecutive values, by doubling."""
    pick, width = np.minimum if least else np.maximum, 1
    while width < size:
        step = min(width, size - width)
        values = pick(values[: len(values) - step], values[step:])
        width += step
    return values


class Block:
    """Documents as one row of word numbers, with the hash of each window."""

    def __init__(self, ids: list[int | None], texts: bytes, window: int, gram: int):
        import xxhash
        import zstandard

        data = zstandard.ZstdDecompressor().decompress(texts)
        self.ids, self.window, self.gram = ids, window, gram
        self.documents = data.split(b"\n")
        words = data.split()
        place = {w: n for n, w in enumerate(dict.fromkeys(words))}
        self.numbers = np.fromiter(map(place.__getitem__, words), dtype=np.int64, count=len(words))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, place), dtype=np.uint64, count=len(place))
        self.hashes = hashes[self.numbers] if len(place) else np.zeros(0, dtype=np.uint64)
        self.lengths = np.array([d.count(b" ") + 1 if d else 0 for d in self.documents], dtype=np.int64)
        self.firsts = np.cumsum(self.lengths) - self.lengths
        self.rank = np.array([LAST if i is None else np.uint64(i % 2**64) ^ _SIGN for i in ids], dtype=np.uint64)
        ends = np.repeat(self.firsts + self.lengths, self.lengths)
        places = np.arange(len(self.numbers))
        self.whole = (places + window <= ends)[: max(0, len(places) - window + 1)]
        self.keys = _rolled(self.hashes, window)

    @staticmethod
    def of(row: pa.Table, window: int, gram: int) -> Block:
        return Block(row.column("ids")[0].as_py(), row.column("texts")[0].as_py(), window, gram)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """The anchor of every window; the group hash of every place that is an anchor of some window."""
        if len(self.keys) == 0:
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
        groups = _rolled(self.hashes, self.gram)
        return _sliding(groups, self.window - self.gram + 1, True), groups[self.anchor_places(self.whole)]

    def anchor_places(self, windows: np.ndarray) -> np.ndarray:
        """Where the anchors of the marked windows are."""
        groups, width = _rolled(self.hashes, self.gram), self.window - self.gram + 1
        border = np.zeros(width - 1, dtype=np.uint64)
        chosen = np.where(windows, _sliding(groups, width, True), np.uint64(0))
        return np.flatnonzero(_sliding(np.concatenate([border, chosen, border]), width, False) == groups)

    def places(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Document rank and start of windows."""
        document = np.searchsorted(self.firsts, at, side="right") - 1
        return self.rank[document], at - self.firsts[document]

    def phrases(self) -> str:
        """One character per word, in the order of the block."""
        codes = self.numbers + 1
        return (codes + 0x800 * (codes >= 0xD800)).astype("<u4").tobytes().decode("utf-32-le")

    def classes(self) -> str:
        """One of 64 characters per word: nodes of an automaton search their children one by one."""
        return (48 + self.numbers * 29 % 64).astype(np.uint8).tobytes().decode("latin-1")


def to_blocks(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Blocks of documents (`doc_id`, `text`), written to the shared folder.

    A block has its words, single-spaced, and its anchors with how often they occur (2: twice or more).
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        arrow, squeeze = to_arrow_schema(BLOCK), zstandard.ZstdCompressor(level=3).compress

        def block(ids, texts, size):
            row = {"block": uuid.uuid4().hex, "ids": ids, "texts": squeeze(b"\n".join(texts)), "n_words": size}
            keys, times = np.unique(Block(ids, row["texts"], window, gram).anchors()[1], return_counts=True)
            row |= {"anchors": pack_keys(keys), "times": pack(np.minimum(times, 2))}
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        ids, texts, size = [], [], 0
        for batch in batches:
            for key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = (text or "").encode().split()  # bytes: ASCII white space only
                ids.append(key)
                texts.append(b" ".join(words))
                size += len(words)
                if size >= block_words:
                    yield block(ids, texts, size)
                    ids, texts, size = [], [], 0
        if ids:
            yield block(ids, texts, size)

    return written(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, BLOCK), "text-blocks")


def _recurring_anchors(requests: pa.Table) -> pa.Table:
    """For each block, those of its keys in this shard that occur twice or more anywhere."""
    rows = requests.to_pylist()
    keys = [unpack_keys(r["keys"]) for r in rows]
    times = np.concatenate([unpack(r["times"]) for r in rows])
    found, place = np.unique(np.concatenate(keys), return_inverse=True)
    often = np.bincount(place, weights=times, minlength=len(found)) > 1
    answers, end = [], 0
    for row, own in zip(rows, keys, strict=True):
        kept, end = own[often[place[end : end + len(own)]]], end + len(own)
        answers.append({"block": row["block"], "shard": row["shard"], "keys": pack_keys(kept)})
    return as_table(answers, ANSWER)


def _recurring_windows(requests: pa.Table) -> pa.Table:
    """For each block, its keys that recur, and whether its first place is the first of all."""
    rows = requests.to_pylist()
    keys = [unpack_keys(r["keys"]) for r in rows]
    times, docs, starts = (np.concatenate([unpack(r[name]) for r in rows]) for name in ("times", "docs", "starts"))
    merged = np.concatenate(keys)
    order = np.lexsort((starts, docs, merged))
    opens = np.ones(len(order), dtype=bool)
    opens[1:] = merged[order][1:] != merged[order][:-1]
    group = np.cumsum(opens) - 1
    lead = order[opens][group]
    first, often = np.zeros(len(order), dtype=bool), np.zeros(len(order), dtype=bool)
    first[order] = (docs[order] == docs[lead]) & (starts[order] == starts[lead])
    often[order] = np.bincount(group, weights=times[order])[group] > 1
    answers, end = [], 0
    for row, own in zip(rows, keys, strict=True):
        at, end = slice(end, end + len(own)), end + len(own)
        kept = often[at]
        answers.append({"block": row["block"], "shard": row["shard"], "keys": pack_keys(own[kept]), "first": pack(first[at][kept])})
    return as_table(answers, ANSWER)


def _known(answers: pa.Table) -> tuple[np.ndarray, np.ndarray | None]:
    """All answered keys, sorted as the shards are ranges, and their marks."""
    rows = sorted(answers.select(["shard", "keys", "first"]).to_pylist(), key=lambda r: r["shard"])
    keys = np.concatenate([unpack_keys(r["keys"]) for r in rows])
    return keys, np.concatenate([unpack(r["first"]) for r in rows]).astype(bool) if rows[0]["first"] is not None else None


def _find(values: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values are among the sorted keys, and where."""
    if not len(keys):
        return np.zeros(len(values), dtype=bool), np.zeros(len(values), dtype=np.int64)
    place = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return keys[place] == values, place


def _ask_windows(block: Block, recurring: np.ndarray) -> dict[str, np.ndarray]:
    """Different windows with a recurring anchor, by key: how often they are here (2: twice or more) and where first."""
    anchors, _ = block.anchors()
    at = np.flatnonzero(block.whole & _find(anchors, recurring)[0])
    docs, starts = block.places(at) if len(at) else (np.zeros(0, dtype=np.uint64), at)
    keys = block.keys[at]
    order = np.lexsort((starts, docs, keys))
    keys, docs, starts = keys[order], docs[order], starts[order]
    opens = np.ones(len(keys), dtype=bool)
    opens[1:] = keys[1:] != keys[:-1]
    moved = opens.copy()
    moved[1:] |= (docs[1:] != docs[:-1]) | (starts[1:] != starts[:-1])
    times = np.bincount(np.cumsum(opens) - 1, weights=moved) if len(keys) else np.zeros(0)
    return {"keys": keys[opens], "times": np.minimum(times, 2), "docs": docs[opens], "starts": starts[opens]}


def _kept(block: Block, recurring: np.ndarray, first_here: np.ndarray) -> np.ndarray:
    """Which words stay, by streaming the documents through the automaton of the recurring phrases.

    The automaton holds the anchors of the recurring windows, as classes of words. The windows around
    a hit are compared with the recurring ones word by word.
    """
    import ahocorasick

    kept = np.ones(len(block.numbers), dtype=bool)
    repeated, place = _find(block.keys, recurring)
    repeated &= block.whole
    at = np.flatnonzero(repeated)
    if not len(at):
        return kept
    window, stream, classes = block.window, block.phrases(), block.classes()
    number_of = {stream[start : start + window]: n for start, n in zip(at.tolist(), place[at].tolist(), strict=True)}
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for start in block.anchor_places(repeated).tolist():
        automaton.add_word(classes[start : start + block.gram])
    automaton.make_automaton()
    found = []
    for begin, length in zip(block.firsts.tolist(), block.lengths.tolist(), strict=True):
        if length >= window:
            back = begin - block.gram + 1
            found += [back + last for last, _ in automaton.iter(classes[begin : begin + length])]
    around = np.zeros(len(kept) + 1, dtype=np.int64)  # starts of windows that hold a hit
    spots = np.array(found)
    np.add.at(around, np.maximum(spots - (window - block.gram), 0), 1)
    np.add.at(around, spots + 1, -1)
    starts = np.flatnonzero((np.cumsum(around)[: len(block.whole)] > 0) & block.whole)
    numbers = [number_of.get(stream[start : start + window], -1) for start in starts.tolist()]
    hits = starts[np.array(numbers) >= 0]
    numbers = [n for n in numbers if n >= 0]
    hits, numbers = np.array(hits), np.array(numbers)
    docs, starts = block.places(hits)
    order = np.lexsort((starts, docs, numbers))
    opens = np.ones(len(order), dtype=bool)
    opens[1:] = numbers[order][1:] != numbers[order][:-1]
    lead = order[opens][np.cumsum(opens) - 1]
    original = np.zeros(len(order), dtype=bool)
    original[order] = (docs[order] == docs[lead]) & (starts[order] == starts[lead])
    gone = hits[~(original & first_here[numbers])]
    cover = np.zeros(len(kept) + 1, dtype=np.int64)
    np.add.at(cover, gone, 1)
    np.add.at(cover, gone + window, -1)
    return np.cumsum(cover[:-1]) == 0


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    block_words: int = BLOCK_WORDS,
    shard_keys: int = SHARD_KEYS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_removed, kept: the words that stay, single-spaced."""
    blocks = to_blocks(narrow(docs, id_col, text_col), window, gram, block_words)
    words = blocks.agg(F.sum("n_words")).first()[0] or 0
    bits = shard_bits(words // 4, shard_keys)

    def rows(block: str, columns: dict[str, np.ndarray]) -> pa.Table:
        made = []
        for shard, a, b in shard_slices(columns["keys"], bits):
            packed = {name: pack(column[a:b]) for name, column in columns.items() if name != "keys"}
            made.append({"shard": shard, "block": block, "keys": pack_keys(columns["keys"][a:b]), **packed})
        return as_table(made, REQUEST)

    def ask_anchors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                columns = {"keys": unpack_keys(row["anchors"]), "times": unpack(row["times"])}
                yield from rows(row["block"], columns).to_batches()

    def ask_windows(row: pa.Table, answers: pa.Table) -> pa.Table:
        recurring = _known(answers)[0] if answers.num_rows else np.zeros(0, dtype=np.uint64)
        return rows(row.column("block")[0].as_py(), _ask_windows(Block.of(row, window, gram), recurring))

    result = StructType(
        [StructField("doc_id", LongType()), StructField("n_words", LongType()), StructField("n_removed", LongType())]
        + [StructField("kept", StringType())]
    )

    def remove(row: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block.of(row, window, gram)
        keys, first = _known(answers) if answers.num_rows else (np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=bool))
        kept = _kept(block, keys, first)
        found = []
        for key, text, begin, size in zip(
            block.ids, block.documents, block.firsts.tolist(), block.lengths.tolist(), strict=True
        ):
            stays = kept[begin : begin + size]
            removed = size - int(stays.sum())
            if removed:
                text = b" ".join(itertools.compress(text.split(b" "), stays.tolist()))
            found.append({"doc_id": key, "n_words": size, "n_removed": removed, "kept": text.decode()})
        return as_table(found, result)

    asked = blocks.select("block", "anchors", "times").mapInArrow(ask_anchors, REQUEST)
    anchors = written(asked.groupBy("shard").applyInArrow(_recurring_anchors, ANSWER), "anchors")
    blocks = blocks.select("block", "ids", "texts")
    asked = blocks.groupBy("block").cogroup(anchors.groupBy("block")).applyInArrow(ask_windows, REQUEST)
    windows = written(asked.groupBy("shard").applyInArrow(_recurring_windows, ANSWER), "windows")
    return blocks.groupBy("block").cogroup(windows.groupBy("block")).applyInArrow(remove, result)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i + 1:i + 20], ' ') AS p
  FROM (SELECT doc_id, w, unnest(range(0, len(w) - 19)) AS i FROM d)
), later AS (
  SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY p ORDER BY doc_id, i) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i + 1, i + 21)) AS k FROM later
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM d
), stays AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY k) AS kept
  FROM words ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n_kept, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN stays USING (doc_id)"""
