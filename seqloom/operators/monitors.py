"""Monitors over the metric log: best so far, thresholds, early stops, the reason a run ended.

All take `observed` rows (keys, record_seq, global_step, chunk_id, value); `record_seq` is unique
in its key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.functions.numeric import as_minimised, reaches
from seqloom.operators.ordered import Running, by_value, by_width, running
from seqloom.session import written

RUN = ("run_id",)
POINT = ("record_seq", "global_step", "chunk_id", "value")

# The names of the reasons a run can end with.
METRIC_THRESHOLD = "metric_threshold"
METRIC_PATIENCE = "metric_patience"
EARLY_STOP_STEP = "early_stop_step"
MAX_STEPS = "max_steps"
DATASET_EXHAUSTED = "dataset_exhausted"
TOTAL_DOCUMENTS = "total_documents"


def first_row(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str] = POINT, order: Column | None = None
) -> DataFrame:
    """The earliest row of each key by aggregation, which combines before its shuffle.

    The order is the first column unless given, and unique. Column by column, as an aggregation of
    structs would have to sort its input.
    """
    place = order if order is not None else F.col(columns[0])
    return df.groupBy(*keys).agg(*[F.min_by(c, place).alias(c) for c in columns])


def best_events(
    observed: DataFrame, mode: str = "min", min_delta: float = 0.0, keys: Sequence[str] = RUN
) -> DataFrame:
    """Rows that improve on the best value so far by more than `min_delta`.

    The first value always counts, even NaN, and a NaN best is never replaced; a later NaN never
    counts. An improvement is always below every value before it: that test runs in parallel over
    buckets and is the whole answer for `min_delta=0`. Otherwise what passes it, a strictly falling
    series, goes through `_spaced`.
    """
    if min_delta < 0:
        raise ValueError("min_delta must not be negative")
    goal = as_minimised(F.col("value"), mode)
    scored = observed.withColumns(
        {
            "__nan": F.isnan("value"),
            "__goal": F.when(~F.isnan("value"), goal),
        }
    )
    # The first row of a key is the one whose number is the smallest up to itself, and it is NaN
    # where the smallest number of a NaN is that one.
    seq = F.col("record_seq")
    seen = running(
        scored,
        by_width("record_seq"),
        {
            "__lowest": Running("min", F.col("__goal")),
            "__first": Running("min", seq, inclusive=True),
            "__first_nan": Running("min", F.when(F.col("__nan"), seq), inclusive=True),
        },
        keys,
    )
    open_ended = ~F.col("__first_nan").eqNullSafe(F.col("__first"))
    lower = open_ended & ~F.col("__nan") & (F.col("__goal") < F.col("__lowest"))
    lows = seen.filter((F.col("__first") == seq) | F.coalesce(lower, F.lit(False)))
    if min_delta > 0:
        lows = _spaced(lows, keys, min_delta)
    return lows.select(*keys, *POINT)


def _spaced(lows: DataFrame, keys: Sequence[str], min_delta: float) -> DataFrame:
    """From a falling series keep each value more than `min_delta` below the one kept before.

    Each low points to the greatest one that far below it: a running maximum over lows and bounds in
    the order of their values, cut into buckets of it. What the first low of a key reaches is kept.
    Pointers are doubled: a round adds what the kept ones point to and joins the pointers with
    themselves, so that the rounds grow with the logarithm of the values kept, and a key with any
    number of lows is spread by its values. Only record lows come here, of a noisy series about the
    logarithm of its length.
    """
    lows = written(lows.select(*keys, *POINT, "__goal"), "lows")
    known = lows.filter(F.col("__goal").isNotNull())
    places = known.select(*keys, F.col("__goal").alias("__x"), F.lit(1).alias("__kind"), F.lit(None).cast("double").alias("__from"))
    bounds = known.select(*keys, (F.col("__goal") - F.lit(min_delta)).alias("__x"), F.lit(0), F.col("__goal"))
    points = places.union(bounds)  # at equal values the bound comes first
    below = Running("max", F.when(F.col("__kind") == 1, F.col("__x")))
    ranked = running(points, by_value(points, "__x", ["__kind"]), {"__to": below}, keys)
    jumps = ranked.filter((F.col("__kind") == 0) & F.col("__to").isNotNull()).select(*keys, "__from", "__to")
    kept = known.groupBy(*keys).agg(F.max("__goal").alias("__goal"))
    jumps = written(jumps, "jumps")
    while not jumps.isEmpty():
        here = kept.withColumnRenamed("__goal", "__from")
        reached = jumps.join(here, [*keys, "__from"], "left_semi").select(*keys, F.col("__to").alias("__goal"))
        kept = written(kept.union(reached), "kept-lows")
        onward = jumps.select(*keys, F.col("__from").alias("__to"), F.col("__to").alias("__end"))
        jumps = written(jumps.join(onward, [*keys, "__to"]).select(*keys, "__from", F.col("__end").alias("__to")), "jumps")
    chosen = known.join(kept, [*keys, "__goal"], "left_semi")
    # A NaN first value can never be improved on: it is the only row of its key here.
    return lows.filter(F.col("__goal").isNull()).unionByName(chosen.select(lows.columns))


def threshold_events(
    observed: DataFrame,
    threshold: float,
    mode: str = "min",
    once: bool = True,
    keys: Sequence[str] = RUN,
) -> DataFrame:
    """Rows at or past the threshold; only the first of each key with `once`."""
    hits = observed.filter(reaches(F.col("value"), threshold, mode)).select(*keys, *POINT)
    return first_row(hits, keys) if once else hits


def early_stop_threshold(
    observed: DataFrame, threshold: float, mode: str = "min", warmup: int = 0, keys: Sequence[str] = RUN
) -> DataFrame:
    """The first row at or past the threshold from step `warmup` on."""
    warm = observed.filter(F.col("global_step") >= F.lit(warmup))
    return threshold_events(warm, threshold, mode, True, keys)


def early_stop_patience(
    observed: DataFrame,
    patience: int,
    mode: str = "min",
    min_delta: float = 0.0,
    warmup: int = 0,
    keys: Sequence[str] = RUN,
) -> DataFrame:
    """The first row that comes `patience` steps or more after the last improvement.

    Improvements before step `warmup` are not seen. Adds `best_step`. 0 disables the rule.
    """
    warm = observed.filter(F.col("global_step") >= F.lit(warmup)).select(*keys, *POINT)
    if patience <= 0:
        return warm.filter(F.lit(False)).withColumn("best_step", F.lit(0).cast("bigint"))
    events = best_events(warm, mode, min_delta, keys).select(
        *keys, "record_seq", F.col("global_step").alias("__best")
    )
    marked = warm.join(events, [*keys, "record_seq"], "left")
    latest = Running("last", F.col("__best"), inclusive=True)
    followed = running(marked, by_width("record_seq"), {"best_step": latest}, keys)
    waited = F.col("global_step") - F.col("best_step") >= F.lit(patience)
    return first_row(followed.filter(waited), keys, [*POINT, "best_step"])


def fixed_step_stop(
    steps: DataFrame, early_stop_step: int = 0, max_steps: int = 0, keys: Sequence[str] = RUN
) -> DataFrame:
    """The first step at or past either limit; `early_stop_step` is tested first. 0 disables."""
    step = F.col("global_step")
    limits = [(EARLY_STOP_STEP, early_stop_step), (MAX_STEPS, max_steps)]
    code = F.lit(None).cast("int")
    for number, (_, limit) in reversed(list(enumerate(limits))):
        if limit > 0:
            code = F.when(step >= limit, F.lit(number)).otherwise(code)
    hits = steps.withColumn("__code", code).filter(F.col("__code").isNotNull())
    names = F.array(*[F.lit(name) for name, _ in limits])
    found = first_row(hits, keys, ["global_step", "chunk_id", "__code"])
    return found.withColumn("stop_reason", names[F.col("__code")]).drop("__code")


def stop_reason(
    steps: DataFrame,
    observed: DataFrame,
    every: int,
    early_stop_step: int = 0,
    max_steps: int = 0,
    threshold: float | None = None,
    patience: int = 0,
    mode: str = "min",
    min_delta: float = 0.0,
    warmup: int = 0,
    at_end: str | Column = DATASET_EXHAUSTED,
    keys: Sequence[str] = RUN,
) -> DataFrame:
    """Where and why each run ends: (keys, global_step, stop_reason).

    A record due by its step is tested before the fixed limits of that step; the record of what
    remains at a chunk's end comes after them. Between metric rules the threshold goes first. A run
    that nothing stops ends with its last step and `at_end`: a reason for all runs, or a column of
    `steps` read at the last step of each, null meaning that the dataset was exhausted.
    """
    last = F.max("global_step").alias("global_step")
    if isinstance(at_end, Column):
        said = F.coalesce(F.max_by(at_end, "global_step"), F.lit(DATASET_EXHAUSTED))
        ends = steps.groupBy(*keys).agg(last, said.alias("stop_reason"))
    else:
        ends = steps.groupBy(*keys).agg(last).withColumn("stop_reason", F.lit(at_end))
    candidates = ends.select(*keys, "global_step", F.lit(9).alias("priority"), "stop_reason")
    after_limits = F.when(F.col("global_step") % F.lit(every) == 0, F.lit(0)).otherwise(F.lit(4))

    def add(found: DataFrame, priority: Column, reason: Column) -> None:
        nonlocal candidates
        candidates = candidates.unionByName(
            found.select(*keys, "global_step", priority.alias("priority"), reason.alias("stop_reason"))
        )

    if threshold is not None:
        found = early_stop_threshold(observed, threshold, mode, warmup, keys)
        add(found, after_limits + 1, F.lit(METRIC_THRESHOLD))
    if patience > 0:
        found = early_stop_patience(observed, patience, mode, min_delta, warmup, keys)
        add(found, after_limits + 2, F.lit(METRIC_PATIENCE))
    if early_stop_step > 0 or max_steps > 0:
        found = fixed_step_stop(steps, early_stop_step, max_steps, keys)
        add(found, F.lit(3), F.col("stop_reason"))
    # A run has at most one candidate of each kind.
    place = F.col("global_step") * F.lit(16) + F.col("priority")
    return first_row(candidates, keys, ["global_step", "stop_reason"], place)
