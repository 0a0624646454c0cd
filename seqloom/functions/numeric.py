"""Number expressions whose NaN rules differ from Spark's ordering of NaN above everything."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cap on the mean loss, and the floor of an elapsed time in seconds.
LOSS_CAP = 20.0
ELAPSED_FLOOR = 1e-9


def perplexity(mean_loss: Column) -> Column:
    """exp of the loss, capped so that it stays finite; NaN stays NaN (`least` would drop it)."""
    capped = F.when(F.isnan(mean_loss), mean_loss).otherwise(F.least(mean_loss, F.lit(LOSS_CAP)))
    return F.exp(capped)


def rate(amount: Column, elapsed: Column) -> Column:
    return amount / F.greatest(elapsed, F.lit(ELAPSED_FLOOR))


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Seconds between two timestamps, independent of the session time zone."""
    gap = end - start
    return (
        F.extract(F.lit("DAY"), gap) * F.lit(86400.0)
        + F.extract(F.lit("HOUR"), gap) * F.lit(3600.0)
        + F.extract(F.lit("MINUTE"), gap) * F.lit(60.0)
        + F.extract(F.lit("SECOND"), gap).cast("double")
    )


def reaches(value: Column, threshold: float, mode: str) -> Column:
    """At or past the threshold in the better direction. NaN never reaches it."""
    _check_mode(mode)
    hit = value <= threshold if mode == "min" else value >= threshold
    return ~F.isnan(value) & hit


def as_minimised(value: Column, mode: str) -> Column:
    """Turn a value to be maximised into one to be minimised."""
    _check_mode(mode)
    return value if mode == "min" else -value


def ceil_div(amount: Column, by: int) -> Column:
    """Integer division of a non-negative amount, rounded up."""
    return int_div(amount + F.lit(by - 1), by)


def int_div(amount: Column, by: int | Column) -> Column:
    """Exact BIGINT division of a non-negative amount, rounded down (no detour over DOUBLE)."""
    divisor = (by if isinstance(by, Column) else F.lit(by)).cast("bigint")
    whole = amount.cast("bigint")
    return F.call_function("div", whole, divisor)


def _check_mode(mode: str) -> None:
    if mode not in ("min", "max"):
        raise ValueError("mode must be 'min' or 'max'")
