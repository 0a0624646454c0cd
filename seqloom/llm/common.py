"""What the operators of this package share: reading, folds, span digests, per-document Arrow tasks."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

#: ASCII white space as the contracts list it.
SPACE = r"\x20\x09-\x0D"

#: Texts whose results a task holds at a time.
SLICE = 128

#: Characters of the texts that a task works on together; a longer text is a slice of its own.
SLICE_CHARACTERS = 1 << 19

Span = tuple[int, int, str]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def narrow(docs: DataFrame, id_col: str | Column = "doc_id", text_col: str = "text") -> DataFrame:
    """Key and text only, under fixed names: other columns can neither clash nor be read."""
    key = F.col(id_col) if isinstance(id_col, str) else id_col
    return docs.select(key.alias("doc_id"), F.col(text_col).alias("text"))


def lowered(text: Column) -> Column:
    """Lower-cases A to Z only; `lower` does the same, faster, where a text is all ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, ascii_uppercase, ascii_lowercase)
    )


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo `folds`; null for a null key."""
    return (F.crc32(key.cast("string")) % folds).cast("int")


def held_out(key: Column, folds: int, kept: int = 2) -> Column:
    """True in the fold that is never learned from; a null key is not in it."""
    return F.coalesce(fold(key, folds) == kept, F.lit(False))


def trains(key: Column, folds: int, kept: int = 2) -> Column:
    """True where a row may be learned from; a null key has no fold and never is."""
    return F.coalesce(fold(key, folds) != kept, F.lit(False))


def spans_text(spans: Iterable[Span], order: dict[str, int]) -> str:
    """kind:start:end by start, then by the order of kinds, comma-joined."""
    ordered = sorted(spans, key=lambda s: (s[0], order[s[2]], s[1]))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in ordered)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def per_document(
    docs: DataFrame, prepare: Callable[[], Callable[[str | None], tuple]], fields: list[StructField]
) -> DataFrame:
    """Run one function over every text, in Arrow batches, next to its key.

    `docs` has `doc_id` and `text`. `prepare` runs once per task and returns the function, which
    gets a text or None and returns the values of `fields`. Rows stay where the scan put them: no
    shuffle, memory of one Arrow batch and the results of `SLICE` texts, and a lost task is run again
    from its file split.
    """
    schema = StructType([docs.schema["doc_id"], *fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = prepare()
        for batch in batches:
            for first in range(0, batch.num_rows, SLICE):
                part = batch.slice(first, SLICE)
                found = [work(text) for text in part.column("text").to_pylist()]
                columns = zip(*found, strict=True)
                arrays = [pa.array(c, type=f.type) for c, f in zip(columns, list(arrow)[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(arrow[0].type), *arrays], schema=arrow)

    return docs.mapInArrow(run, schema)


def per_slice(
    docs: DataFrame,
    prepare: Callable[[], Callable[[list[str | None]], list[tuple]]],
    fields: list[StructField],
    characters: int = SLICE_CHARACTERS,
) -> DataFrame:
    """As `per_document`, with one call for the texts of a slice.

    A slice has at most `SLICE` texts and `characters` characters, or one text that is longer.
    """
    schema = StructType([docs.schema["doc_id"], *fields])
    arrow = to_arrow_schema(schema)

    def slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
        first = held = 0
        for n, text in enumerate(texts):
            length = len(text or "")
            if n > first and (n - first == SLICE or held + length > characters):
                yield first, n
                first, held = n, 0
            held += length
        if first < len(texts):
            yield first, len(texts)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = prepare()
        for batch in batches:
            texts, keys = batch.column("text").to_pylist(), batch.column("doc_id").cast(arrow[0].type)
            for first, end in slices(texts):
                columns = zip(*work(texts[first:end]), strict=True)
                arrays = [pa.array(c, type=f.type) for c, f in zip(columns, list(arrow)[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([keys.slice(first, end - first), *arrays], schema=arrow)

    return docs.mapInArrow(run, schema)


def long_field(name: str) -> StructField:
    return StructField(name, LongType())


def string_field(name: str) -> StructField:
    return StructField(name, StringType())
