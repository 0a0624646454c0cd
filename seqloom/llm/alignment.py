"""Operator 12, alignment of the tokens of two tokenizers by sparse incidence products.

Both tokenizers cut the same bytes. A and B are the incidence matrices of tokens and bytes, in rows
of compressed columns (CSR); the row products of A·Bᵀ (Gustavson: the row of a token is the sum of
the rows of Bᵀ its bytes name) are the overlap links, and their values the bytes in common. Overlap
links whose tokens end at the same byte cut the text into groups. With the incidence of tokens and
groups the same product gives the links of all tokens that share a group.

Byte-level vocabulary A gets a space and the text, piece vocabulary B the text, to which it adds the
space itself; strings of special tokens are ordinary text. Texts of a slice are multiplied together:
their matrices are the blocks of one diagonal, as a text always ends a group. Products are made in
blocks of rows that hold at most `PRODUCTS` terms (a row alone may have more), so that memory is that
of one slice or one longer text.

How often a pair of ids is linked is counted over the corpus in one aggregation. Of two linked tokens
one is the end of the other, so the number of different pairs is bounded by the two vocabularies
(each token has no more ends than bytes), never by the corpus: `link_counts` may be broadcast. The
links of a text are written beside its other results and meet the counts in a scan; no text and no
link is shuffled, only counts.

Defined results: texts that are null, empty, or not given back by either vocabulary have no tokens:
zeros and an empty `groups_sha256`; very long texts are read whole; a repeated row gives a repeated
result and its links count again; a null key is returned as null; an empty table gives an empty table;
other columns are never looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from seqloom.llm.bpe import Codec
from seqloom.llm.common import long_field, narrow, per_slice, string_field, table
from seqloom.session import written

#: Terms of a product that are held at a time.
PRODUCTS = 1 << 18
#: Characters of the texts that are aligned together.
CHARACTERS = 1 << 17


@dataclass
class Csr:
    """A matrix of zeros and ones by rows: row i has its ones in `columns[ends[i]:ends[i + 1]]`."""

    ends: np.ndarray
    columns: np.ndarray
    width: int

    @staticmethod
    def stretches(lengths: np.ndarray) -> Csr:
        """Row i has the next `lengths[i]` columns."""
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return Csr(ends, np.arange(ends[-1]), int(ends[-1]))

    @staticmethod
    def labels(labels: np.ndarray, width: int) -> Csr:
        """Row i has the one column `labels[i]`."""
        return Csr(np.arange(len(labels) + 1), labels, width)

    @property
    def height(self) -> int:
        return len(self.ends) - 1

    def transposed(self) -> Csr:
        rows = np.repeat(np.arange(self.height), np.diff(self.ends))
        if (self.columns[1:] < self.columns[:-1]).any():
            rows = rows[np.argsort(self.columns, kind="stable")]
        ends = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=self.width))])
        return Csr(ends, rows, self.height)

    def terms(self, other: Csr) -> np.ndarray:
        """The number of terms of each row of the product: the symbolic pass."""
        sizes = np.concatenate([[0], np.cumsum(np.diff(other.ends)[self.columns])])
        return np.diff(sizes[self.ends])

    def product(self, other: Csr, most: int = PRODUCTS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, columns, values) of self·other, by row and column, in blocks of whole rows."""
        total = np.concatenate([[0], np.cumsum(self.terms(other))])
        first = 0
        while first < self.height:
            last = max(first + 1, int(np.searchsorted(total, total[first] + most, "right")) - 1)
            picked = self.columns[self.ends[first] : self.ends[last]]
            begin, size = other.ends[picked], np.diff(other.ends)[picked]
            count = total[last] - total[first]
            inside = np.arange(count) - np.repeat(np.cumsum(size) - size, size)
            columns = other.columns[np.repeat(begin, size) + inside]
            rows = np.repeat(np.arange(first, last), np.diff(total)[first:last])
            cells = rows * other.width + columns
            if (cells[1:] < cells[:-1]).any():  # never in products of stretches
                order = np.argsort(cells, kind="stable")
                cells, rows, columns = cells[order], rows[order], columns[order]
            new = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]])[:count])
            yield rows[new], columns[new], np.diff(new, append=count)
            first = last


def groups_of(a: Csr, b: Csr) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The overlap links that end together (their places in A, in B), the group of each token of A and
    of B, and the number of overlap links of each token of A."""
    ends: list[tuple[np.ndarray, np.ndarray]] = []
    overlaps = np.zeros(a.height, np.int64)
    for rows, columns, _ in a.product(b.transposed()):
        together = a.ends[rows + 1] == b.ends[columns + 1]
        ends.append((rows[together], columns[together]))
        overlaps += np.bincount(rows, minlength=a.height)
    left, right = (np.concatenate(side) for side in zip(*ends, strict=True))
    group_a = np.searchsorted(left, np.arange(a.height))
    group_b = np.searchsorted(right, np.arange(b.height))
    return left, right, group_a, group_b, overlaps


def _offsets(table: pa.Array) -> np.ndarray:
    return np.frombuffer(table.buffers()[1], np.int64)[table.offset : table.offset + len(table) + 1]


def _joined(table: pa.Array, places: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The entries of `table` at `places`, joined, and where each begins (and the last one ends)."""
    if not len(places):
        return b"", np.zeros(1, np.int64)
    taken = table.take(pa.array(places))
    return taken.buffers()[2].to_pybytes(), _offsets(taken)


class Aligner:
    """The two tokenizers, the bytes of their tokens, and the alignment of the texts of a slice."""

    def __init__(self, byte_level: str | None = None, pieces: str | None = None):
        import public_tokenizers
        import sentencepiece

        self._a = Codec.of(byte_level)
        self._b = sentencepiece.SentencePieceProcessor(model_file=pieces or public_tokenizers.path("piece_bpe_32k.model"))
        self.size_a, self.size_b = max(self._a.bytes_of) + 1, self._b.get_piece_size()
        self._bytes_a = pa.array([self._a.bytes_of.get(i, b"") for i in range(self.size_a)], pa.large_binary())
        self._bytes_b = pa.array([self._piece(i) for i in range(self.size_b)], pa.large_binary())
        self.length_a, self.length_b = (np.diff(_offsets(x)) for x in (self._bytes_a, self._bytes_b))
        # ids as they stand in a list of groups: inside their side of a group, and as its last
        sides = ((self.size_a, "|"), (self.size_b, ";"))
        self._shown = pa.array([f"{i}{end}" for size, close in sides for i in range(size) for end in (",", close)], pa.large_string())

    def _piece(self, i: int) -> bytes:
        piece = self._b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self._b.is_byte(i) else piece.replace("▁", " ").encode()

    def tokens(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of both sides, and where each text's begin and end in them (a row per text and one more).

        A text has none where either side does not give back the space and the text.
        """
        raw = [f" {text}".encode() if text else b"" for text in texts]
        sides = (
            ([self._a.encode_ordinary(" " + text) if text else [] for text in texts], self._bytes_a),
            (self._b.encode([text or "" for text in texts], num_threads=1), self._bytes_b),
        )
        fits = np.ones(len(texts), bool)
        made = []
        for ids, table in sides:
            flat = np.fromiter(chain.from_iterable(ids), np.int64)
            at = np.concatenate([[0], np.cumsum([len(own) for own in ids])])
            data, ends = _joined(table, flat)
            ends = ends[at].tolist()
            fits &= [data[i:j] == own for i, j, own in zip(ends, ends[1:], raw, strict=False)]
            made.append((flat, np.diff(at)))
        kept = [flat[np.repeat(fits, counts)] for flat, counts in made]
        counts = np.stack([counts * fits for _, counts in made], axis=1)
        return *kept, np.concatenate([np.zeros((1, 2), np.int64), np.cumsum(counts, axis=0)])

    def _listed(self, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The groups as a1,a2|b1;a3|b2,b3; and where each token, in that order, begins."""
        codes = np.empty(len(a) + len(b), np.int64)
        last_a, last_b = (np.diff(group, append=-1) != 0 for group in (group_a, group_b))
        codes[np.arange(len(a)) + np.searchsorted(group_b, group_a)] = 2 * a + last_a
        codes[np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")] = 2 * (self.size_a + b) + last_b
        return _joined(self._shown, codes)

    def align(self, texts: list[str | None]) -> Iterator[Aligned]:
        """The alignment of each text."""
        a, b, at = self.tokens(texts)
        if not len(a):
            for _ in texts:
                yield Aligned(self, a, b, a, a, a, a, 0, 0, b"")
            return
        by_byte_a, by_byte_b = Csr.stretches(self.length_a[a]), Csr.stretches(self.length_b[b])
        left, right, group_a, group_b, overlaps = groups_of(by_byte_a, by_byte_b)
        by_group_a, by_group_b = Csr.labels(group_a, len(left)), Csr.labels(group_b, len(left))
        shared = np.concatenate([[0], np.cumsum(by_group_a.terms(by_group_b.transposed()))])
        overlaps = np.concatenate([[0], np.cumsum(overlaps)])
        data, begins = self._listed(a, b, group_a, group_b)
        for (i, j), (k, m) in zip(at, at[1:], strict=False):
            first, end = np.searchsorted(left, [i, k])
            yield Aligned(
                self, a[i:k], b[j:m], left[first:end] - i, right[first:end] - j, group_a[i:k] - first, group_b[j:m] - first,
                int(overlaps[k] - overlaps[i]), int(shared[k] - shared[i]), data[begins[i + j] : begins[k + m]][:-1],
            )


@dataclass
class Aligned:
    """One text: ids of both sides, links that end together (as places), groups of the tokens, counts of links."""

    aligner: Aligner
    a: np.ndarray
    b: np.ndarray
    left: np.ndarray
    right: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    n_overlaps: int
    n_shared: int
    #: The groups, as a1,a2|b1;a3|b2,b3.
    listed: bytes

    def pairs(self) -> np.ndarray:
        """The id pairs of the links that end together, one number each."""
        return self.a[self.left] * self.aligner.size_b + self.b[self.right]

    def links(self, kind: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(places in A, places in B, values) of the product of `kind`: "overlap" or "shared"."""
        if kind == "overlap":
            left = Csr.stretches(self.aligner.length_a[self.a])
            right = Csr.stretches(self.aligner.length_b[self.b])
        else:
            left, right = (Csr.labels(g, len(self.left)) for g in (self.group_a, self.group_b))
        yield from left.product(right.transposed())


def alignments(
    docs: DataFrame,
    byte_level: str | None = None,
    pieces: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_groups: bool = False,
) -> DataFrame:
    """doc_id, counts of tokens, groups and links, `pairs` (a link's ids: A's times the size of B, plus B's)
    and the digest of the groups, and the groups as text if asked."""

    def prepare():
        aligner = Aligner(byte_level, pieces)

        def values(found: Aligned) -> tuple:
            n = len(found.left)
            digest = hashlib.sha256(found.listed).hexdigest() if n else ""
            row = len(found.a), len(found.b), n, n, found.n_overlaps, found.n_shared, digest, found.pairs()
            return (*row, found.listed.decode()) if with_groups else row

        return lambda texts: [values(found) for found in aligner.align(texts)]

    counts = [long_field(name) for name in ("n_a", "n_b", "n_groups", "n_links", "n_overlaps", "n_shared")]
    fields = [*counts, string_field("groups_sha256"), StructField("pairs", ArrayType(LongType()))]
    return per_slice(narrow(docs, id_col, text_col), prepare, fields + [string_field("groups")] * with_groups, CHARACTERS)


def token_links(
    docs: DataFrame,
    kind: str = "overlap",
    byte_level: str | None = None,
    pieces: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, place_a, place_b, id_a, id_b, value: a row per link of a product, "overlap" (the value is the
    bytes in common) or "shared" (tokens of one group; as many as the product of a group's sides)."""
    if kind not in ("overlap", "shared"):
        raise ValueError(f"kind must be overlap or shared, not {kind!r}")
    slim = narrow(docs, id_col, text_col)
    names = ("place_a", "place_b", "id_a", "id_b", "value")
    schema = StructType([slim.schema["doc_id"], *map(long_field, names)])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(byte_level, pieces)
        for batch in batches:
            keys = batch.column("doc_id").cast(arrow[0].type)
            for n, text in enumerate(batch.column("text")):
                for found in aligner.align([text.as_py()]):
                    for i, j, value in found.links(kind) if len(found.a) else ():
                        columns = [pa.array(x) for x in (i, j, found.a[i], found.b[j], value)]
                        key = keys.take(pa.array([n] * len(i), pa.int64()))
                        yield pa.RecordBatch.from_arrays([key, *columns], schema=arrow)

    return slim.mapInArrow(run, schema)


def link_counts(aligned: DataFrame) -> DataFrame:
    """pair, n: how many links of all texts hold each id pair linked."""
    return aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))


def with_corpus_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """`aligned` with n_best (links whose count is the highest of their B id) and count_sum, without `pairs`."""
    counted = link_counts(aligned).toArrow()  # bounded by the vocabularies, see above
    pairs, n = (counted.column(name).to_numpy().astype(np.int64) for name in ("pair", "n"))
    order = np.argsort(pairs)
    pairs, n = pairs[order], n[order]
    highest = np.zeros(size_b, np.int64)
    np.maximum.at(highest, pairs % size_b, n)
    known = aligned.sparkSession.sparkContext.broadcast((pairs, n, n == highest[pairs % size_b]))

    kept = [field for field in aligned.schema if field.name != "pairs"]
    schema = StructType([*kept, long_field("n_best"), long_field("count_sum")])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = known.value
        for batch in batches:
            lists = batch.column("pairs")
            at = np.searchsorted(pairs, lists.flatten().to_numpy())
            ends = np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy()))])
            sums = [np.concatenate([[0], np.cumsum(x[at])])[ends] for x in (best.astype(np.int64), n)]
            columns = [batch.column(field.name) for field in kept] + [pa.array(np.diff(x)) for x in sums]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return aligned.mapInArrow(run, schema)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = written(alignments(table(spark, sf_dir, "documents")), "aligned")
    return with_corpus_counts(aligned, Aligner().size_b)
