"""Operator 6, byte-pair encoding and decoding by tree concatenation.

A text is split at its special tokens and, as the vocabulary's pattern says, into pieces. A piece
that the pattern leaves unsplit for more than `leaf` bytes is cut into leaves, which are encoded in
parallel threads; neighbours are then joined pairwise, up the tree. To join two encodings, a window
of the last tokens of the left and the first of the right is encoded anew and grows until its first
token is the left side's and its last the right side's again (or it holds the whole side). A token
sequence is the encoding of its bytes exactly if every two neighbours are, so agreement of one token
at both ends makes the joined sequence exact. Work per join follows the window, not the text.

Ids and bytes equal those of the library the vocabulary file belongs to, its special token
included. Defined results: null is an empty text; the empty text has no tokens and decodes to itself;
a repeated row gives a repeated result; a null key is returned as null.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, IntegerType, StructField

from seqloom.llm.common import long_field, narrow, per_document, sha256, string_field, table

#: Bytes of an unsplit piece that are encoded at once; longer pieces become a tree.
LEAF = 512

#: Fixed value: the vocabulary's split pattern, with the Unicode property for white space.
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)

#: The same pattern for the leaf encoder, whose `\s` is that property.
LEAF_PIECES = (
    PIECES.replace(r"[^\p{White_Space}", r"[^\s")
    .replace(r"\P{White_Space}", r"\S")
    .replace(r"\p{White_Space}", r"\s")
)


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a visible character: itself, or the next one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class Codec:
    """Encoder and decoder over one byte-level vocabulary file."""

    def __init__(self, vocabulary: str, leaf: int = LEAF):
        import regex
        import tiktoken

        spec = json.loads(Path(vocabulary).read_text(encoding="utf-8"))
        byte = _byte_of_char()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        words = {w: i for w, i in spec["model"]["vocab"].items() if w not in self.special}
        ranks = {bytes(map(byte.__getitem__, word)): number for word, number in words.items()}
        self.bytes_of = {number: piece for piece, number in ranks.items()}
        self.bytes_of |= {number: word.encode() for word, number in self.special.items()}
        self.shown = {number: str(number) for number in self.bytes_of}
        self.leaf = leaf
        self._base = tiktoken.Encoding("base", pat_str=LEAF_PIECES, mergeable_ranks=ranks, special_tokens={})
        self._pieces = regex.compile(PIECES)
        long = max(1, leaf // 4)  # a character has four bytes at most
        kinds = (r"\p{L}", r"\p{N}", r"[^\p{White_Space}\p{L}\p{N}]", r"\p{White_Space}")
        self._unsplit = regex.compile("|".join(f"{kind}{{{long},}}" for kind in kinds))
        self._specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    @staticmethod
    def of(vocabulary: str | None = None, leaf: int = LEAF) -> Codec:
        if vocabulary is None:
            import public_tokenizers

            vocabulary = public_tokenizers.path("byte_bpe_50k.json")
        return Codec(vocabulary, leaf)

    def piece(self, data: bytes) -> list[int]:
        """The encoding of bytes that stay in one piece."""
        return self._base._encode_single_piece(data)

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbouring encoded stretches of one piece."""
        if not left or not right:
            return left + right
        width = 2
        while True:
            head, tail = left[-width:], right[:width]
            seam = self.piece(b"".join(self.bytes_of[i] for i in head + tail))
            whole_left, whole_right = width >= len(left), width >= len(right)
            if (whole_left or seam[0] == head[0]) and (whole_right or seam[-1] == tail[-1]):
                return left[: len(left) - len(head)] + seam + right[len(tail) :]
            width *= 2

    def tree(self, data: bytes) -> list[int]:
        """Leaves by halving, encoded in parallel, joined pairwise."""
        bounds = [0, len(data)]
        while max(b - a for a, b in zip(bounds, bounds[1:], strict=False)) > self.leaf:
            middles = [(a + b) // 2 for a, b in zip(bounds, bounds[1:], strict=False)]
            bounds = sorted({*bounds, *middles})
        leaves = [data[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
        with ThreadPoolExecutor(4) as threads:
            level = list(threads.map(self.piece, leaves))
        while len(level) > 1:
            pairs = [self.join(*level[n : n + 2]) for n in range(0, len(level) - 1, 2)]
            level = pairs + level[len(pairs) * 2 :]
        return level[0]

    def encode_ordinary(self, text: str) -> list[int]:
        """The encoding of a text in which the strings of special tokens are ordinary text."""
        if len(text) < self.leaf // 4 or not self._unsplit.search(text):
            return self._base.encode_ordinary(text)
        ids: list[int] = []
        for found in self._pieces.finditer(text):
            data = found.group().encode()
            ids += self.piece(data) if len(data) <= self.leaf else self.tree(data)
        return ids

    def encode(self, text: str) -> list[int]:
        if self._specials is None or not self._specials.search(text):
            return self.encode_ordinary(text)
        ids: list[int] = []
        for part in self._specials.split(text):
            if part in self.special:
                ids.append(self.special[part])
            elif part:
                ids += self.encode_ordinary(part)
        return ids

    def decode(self, ids: list[int]) -> str:
        """Bytes of all tokens, special ones included; invalid sequences become replacement characters."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def _per_text(docs: DataFrame, vocabulary: str | None, leaf: int, fields, values: Callable) -> DataFrame:
    def prepare():
        codec = Codec.of(vocabulary, leaf)
        return lambda text: values(codec, text or "")

    return per_document(docs, prepare, fields)


def encode_documents(
    docs: DataFrame, vocabulary: str | None = None, leaf: int = LEAF, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and `ids`, the token ids of the whole text."""
    fields = [StructField("ids", ArrayType(IntegerType()))]
    return _per_text(narrow(docs, id_col, text_col), vocabulary, leaf, fields, lambda c, t: (c.encode(t),))


def round_trip(
    docs: DataFrame,
    vocabulary: str | None = None,
    leaf: int = LEAF,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """doc_id, the number of tokens, digests of the ids and of the text decoded from them; the ids if asked."""

    def values(codec: Codec, text: str) -> tuple:
        ids = codec.encode(text)
        shown = ",".join(map(codec.shown.__getitem__, ids))
        found = len(ids), sha256(shown), sha256(codec.decode(ids))
        return (*found, ids) if with_ids else found

    fields = [long_field("n_tokens"), string_field("ids_sha256"), string_field("decoded_sha256")]
    fields += [StructField("ids", ArrayType(IntegerType()))] * with_ids
    return _per_text(narrow(docs, id_col, text_col), vocabulary, leaf, fields, values)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
