"""Tokenizers: a text column in, an ARRAY<INT> column of ids out.

A tokenizer has `eos_token_id`, `encode(text)` and `count(text)`; both methods build Columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from seqloom.functions.batches import slices


class Tokenizer(Protocol):
    eos_token_id: int

    def encode(self, text: Column) -> Column: ...

    def count(self, text: Column) -> Column: ...


class CharTokenizer:
    """One id per character, from its code point. Runs inside the JVM."""

    # Modulus and shift of the character ids, and the boundary id.
    modulus = 31
    shift = 1
    eos_token_id = 0

    def encode(self, text: Column) -> Column:
        # split gives one empty string for an empty text
        characters = F.when(F.length(text) > 0, F.split(text, "")).otherwise(
            F.array().cast("array<string>")
        )
        return F.transform(characters, lambda c: F.ascii(c) % self.modulus + self.shift)

    def count(self, text: Column) -> Column:
        return F.length(text)


class PythonTokenizer:
    """Any Python encoder with `encode(text, add_special_tokens=False)` and `eos_token_id`.

    `factory` is called once per Python worker, so that a large vocabulary is loaded once and not
    shipped with each batch. Rows travel in Arrow batches.
    """

    def __init__(self, factory: Callable[[], Any], eos_token_id: int | None = None) -> None:
        boundary = eos_token_id if eos_token_id is not None else factory().eos_token_id
        if boundary is None:
            raise ValueError("the tokenizer has no eos_token_id")
        self.eos_token_id = int(boundary)
        self._udf = _encoder_udf(factory)

    def encode(self, text: Column) -> Column:
        return self._udf(text)

    def count(self, text: Column) -> Column:
        return F.size(self._udf(text))


def _encoder_udf(factory: Callable[[], Any]) -> Callable[[Column], Column]:
    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = factory()
        for texts in batches:
            # Ids are many times their text in Python: those of a slice at a time leave the worker.
            for first, end in slices([len(text or "") for text in texts]):
                yield texts.iloc[first:end].map(
                    lambda text: None if text is None else _ids(encoder.encode(text, add_special_tokens=False))
                )

    return encode


def _ids(encoded: Any) -> list[int]:
    """Plain lists, and objects that carry the list in `.ids`."""
    return list(getattr(encoded, "ids", encoded))
