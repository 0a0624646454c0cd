"""Expressions over ARRAY columns of numbers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def squared_norm(vector: Column) -> Column:
    """Sum of squares in DOUBLE."""
    return F.aggregate(
        vector, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
    )


def softmax(logits: Column) -> Column:
    """Probabilities; shifted by the largest logit so that exp cannot overflow."""
    peak = F.array_max(logits).cast("double")
    shifted = bind(peak, lambda m: F.transform(logits, lambda x: F.exp(x.cast("double") - m)))
    return bind(shifted, divided_by_sum)


def top_k(scores: Column, k: int) -> Column:
    """The k largest scores as ARRAY<STRUCT<index, score>>, best first; ties take the lower index."""
    negated = F.transform(
        scores, lambda x, i: F.struct((-x).alias("negated"), i.cast("bigint").alias("index"))
    )
    best = F.slice(F.array_sort(negated), 1, k)
    return F.transform(
        best, lambda s: F.struct(s["index"].alias("index"), (-s["negated"]).alias("score"))
    )


def divided_by_sum(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
    return bind(total, lambda t: F.transform(values, lambda x: x / t))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Compute `value` once and use it many times in `body`, as lambdas have no local names."""
    return F.element_at(F.transform(F.array(value), body), 1)
