"""Numpy work over the texts of Arrow batches, beside the other columns: no shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

#: Texts, and characters of them, that are worked on together; a longer text is alone.
SLICE, CHARACTERS = 256, 1 << 19


def slices(lengths: list[int], rows: int = SLICE, characters: int = CHARACTERS) -> Iterator[tuple[int, int]]:
    """(first, end) of neighbours that have few rows and characters together."""
    first = held = 0
    for n, length in enumerate(lengths):
        if n > first and (n - first == rows or held + length > characters):
            yield first, n
            first, held = n, 0
        held += length
    if first < len(lengths):
        yield first, len(lengths)


def with_columns_of_texts(
    rows: DataFrame, text: str, work: Callable[[list[str]], list[pa.Array | np.ndarray]], fields: list[StructField]
) -> DataFrame:
    """`rows` without `text`, and the columns that `work` makes of the texts (null as empty) of a slice."""
    kept = [field for field in rows.schema if field.name != text]
    schema = StructType([*kept, *fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [value or "" for value in batch.column(text).to_pylist()]
            for first, end in slices([len(value) for value in texts]):
                part = batch.slice(first, end - first)
                columns = [part.column(field.name) for field in kept] + [pa.array(x) for x in work(texts[first:end])]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return rows.mapInArrow(run, schema)


class Words:
    """The words of several texts one after the other, numbered inside their text; one place behind each text."""

    def __init__(self, texts: list[str]):
        words = [text.encode().split() for text in texts]  # bytes: ASCII white space only
        self.counts = np.array([len(own) for own in words], np.int64)
        flat = pa.array([word for own in words for word in own], pa.large_binary()).dictionary_encode()
        own = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        known = flat.dictionary.cast(pa.large_string())
        lengths = pa.compute.utf8_length(known).to_numpy(zero_copy_only=False).astype(np.int64)[own]
        ends = np.cumsum(self.counts)
        place = np.repeat(np.arange(len(texts)), self.counts)
        #: A number for each word, equal inside a text only; those of the places between are negative.
        self.numbers = np.insert(own + place * (len(known) + 1), ends, -1 - np.arange(len(texts)))
        self.text = np.insert(place, ends, np.arange(len(texts)))
        self.lengths = np.insert(lengths, ends, 0)


def ranked(pairs: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """For each of `size` places a number: equal `pairs` (of the places `at`) alike, negative if there is one only."""
    order = np.argsort(pairs, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = pairs[order[1:]] != pairs[order[:-1]]
    number = np.cumsum(new) - 1
    often = np.bincount(number, minlength=1)[number] > 1
    found = -1 - np.arange(size)
    found[at[order[often]]] = number[often]
    return found


def doubled(left: np.ndarray, right: np.ndarray, shift: int) -> np.ndarray:
    """Numbers of the groups that begin with a group of `left` and end, `shift` words on, with one of `right`."""
    size = len(left)
    at = np.flatnonzero((left[: max(0, size - shift)] >= 0) & (right[shift:] >= 0))
    return ranked(left[at] * size + right[at + shift], at, size)
