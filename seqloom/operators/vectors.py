"""Norms, clipping, histograms, routing and picks over tables of vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from seqloom.functions.hashing import hash_bucket, seeded_hash, unit_interval
from seqloom.functions.numeric import int_div
from seqloom.functions.vectors import divided_by_sum, softmax, squared_norm, top_k
from seqloom.operators.ordered import (
    BUCKET,
    BUCKET_WIDTH,
    RowOrder,
    Running,
    join_same,
    running,
)

# Fixed value: what is added to a norm before dividing by it.
NORM_EPSILON = 1e-6
# Parts a group is ranked in before its final ranking.
SALTS = 64


def l2_norm(df: DataFrame, vector: str, keys: Sequence[str] = ()) -> DataFrame:
    """sqrt of the sum of all squared elements, over the table or per key."""
    return df.groupBy(*keys).agg(F.sqrt(F.sum(squared_norm(F.col(vector)))).alias("norm"))


def clip_to_norm(df: DataFrame, vector: str, key: str, max_norm: float) -> DataFrame:
    """Scale the vectors of a group so that their joint norm is at most `max_norm`.

    Adds `norm` and `scale`. The norms are one row per group: the planner broadcasts them if their
    measured size allows, and splits a hot group if it has to sort.
    """
    if max_norm <= 0:
        raise ValueError("max_norm must be positive")
    norms = l2_norm(df, vector, [key])
    scale = F.least(F.lit(1.0), F.lit(max_norm) / (F.col("norm") + F.lit(NORM_EPSILON)))
    return (
        join_same(df, norms, [key])
        .withColumn("scale", scale)
        .withColumn(vector, F.transform(vector, lambda x: x.cast("double") * F.col("scale")))
    )


def value_histogram(df: DataFrame, name: str, values: str, bins: int) -> DataFrame:
    """Counts in `bins` equal bins between each name's smallest and largest value.

    (name, bin, bin_low, bin_high, count); a name with one distinct value has one bin. Bounds come
    from the finite extremes of each row, and elements are counted per task before anything is
    shuffled. NaN and each infinity have a row of their own: no bin, and themselves as bounds.
    """
    if bins <= 0:
        raise ValueError("bins must be positive")
    finite = F.filter(values, lambda x: _finite(x.cast("double")))
    bounds = df.groupBy(name).agg(
        F.min(F.array_min(finite)).cast("double").alias("low"),
        F.max(F.array_max(finite)).cast("double").alias("high"),
    )
    low, high = F.col("low"), F.col("high")
    width = (high - low) / F.lit(bins)

    def place(x: Column) -> Column:
        x = x.cast("double")
        inside = F.when(high == low, F.lit(0)).otherwise(F.least(F.floor((x - low) / width), F.lit(bins - 1)))
        return F.struct(
            F.when(_finite(x), inside).cast("bigint").alias("bin"), F.when(~_finite(x), x).alias("odd")
        )

    return (
        join_same(df.select(name, values), bounds, [name])
        .select(name, "low", "high", F.inline(F.transform(F.filter(values, lambda x: x.isNotNull()), place)))
        .groupBy(name, "low", "high", "bin", "odd")
        .agg(F.count("*").alias("count"))
        .select(
            name,
            "bin",
            F.coalesce("odd", low + F.col("bin") * width).alias("bin_low"),
            F.coalesce("odd", low + (F.col("bin") + 1) * width).alias("bin_high"),
            "count",
        )
    )


def _finite(x: Column) -> Column:
    return ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))


def topk_routing(df: DataFrame, logits: Column, k: int) -> DataFrame:
    """Add `probabilities` over the experts and `routes`, the best k with weights that sum to 1."""
    if k < 1:
        raise ValueError("k must be between 1 and the number of experts")
    scored = df.withColumn("probabilities", softmax(logits))
    few = F.size("probabilities") < F.lit(k)
    checked = F.when(
        few, F.raise_error(F.lit("k must be between 1 and the number of experts"))
    ).otherwise(top_k(F.col("probabilities"), k))
    weights = divided_by_sum(F.col("__best.score"))
    routes = F.zip_with(
        F.col("__best.index"),
        F.col("__weights"),
        lambda e, w: F.struct(e.alias("expert"), w.alias("weight")),
    )
    return (
        scored.withColumn("__best", checked)
        .withColumn("__weights", weights)
        .withColumn("routes", routes)
        .drop("__best", "__weights")
    )


def expert_load_balance(routed: DataFrame) -> DataFrame:
    """Per expert: share of all slots, mean probability, and the table's balance score.

    One aggregation of the tokens to one row per expert; the score over those few rows repeats on
    each of them.
    """
    chosen = F.col("routes.expert")
    per_expert = F.transform(
        "probabilities",
        lambda p, i: F.struct(
            i.cast("bigint").alias("expert"),
            p.alias("probability"),
            F.when(F.array_contains(chosen, i.cast("bigint")), 1).otherwise(0).alias("chosen"),
            F.size(chosen).alias("slots"),
        ),
    )
    stats = (
        routed.select(F.inline(per_expert))
        .groupBy("expert")
        .agg(
            (F.sum("chosen") / F.sum("slots")).alias("load"),
            F.avg("probability").alias("mean_probability"),
        )
    )
    # One row per expert: the number of experts is the width of a vector.
    every = F.struct("expert", "load", "mean_probability")
    gathered = stats.agg(F.array_sort(F.collect_list(every)).alias("experts"))
    score = F.size("experts") * F.aggregate(
        "experts", F.lit(0.0), lambda acc, e: acc + e["load"] * e["mean_probability"]
    )
    return gathered.withColumn("balance_score", score).select(F.inline("experts"), "balance_score")


def weighted_pick(
    candidates: DataFrame,
    group: str,
    candidate: str,
    logit: str,
    temperature: float,
    top: int = 0,
    seed: int = 42,
) -> DataFrame:
    """Pick one candidate per group, as (group, candidate).

    Temperature 0 takes the largest logit. Otherwise one draw from the softmax of logit/temperature
    among the `top` largest (0 for all): running sums of the weights over the candidates in hash
    order, and the first to pass a seeded uniform number is taken. The order does not matter to a
    draw, and a hash order cuts a hot group into even slices. Ties go to the lower candidate.
    """
    if temperature < 0:
        raise ValueError("temperature must not be negative")
    if top < 0:
        raise ValueError("top must not be negative")
    if temperature == 0:
        best = F.struct(F.col(logit).alias("logit"), (-F.col(candidate)).alias("negated"))
        return (
            candidates.groupBy(group)
            .agg(F.max(best).alias("__best"))
            .select(group, (-F.col("__best.negated")).alias(candidate))
        )
    if top > 0:
        candidates = _largest(candidates, group, candidate, logit, top)
    # A struct is never null: the null group is a group like any other.
    candidates = candidates.withColumn("__group", F.struct(group))
    bounds = candidates.groupBy("__group").agg(
        F.max(logit).cast("double").alias("__peak"), F.count("*").alias("__size")
    )
    weighted = candidates.join(bounds, "__group").withColumns(
        {
            "__weight": F.exp((F.col(logit).cast("double") - F.col("__peak")) / F.lit(temperature)),
            "__hash": seeded_hash(seed, F.col(group), F.col(candidate)),
        }
    )
    slices = int_div(F.col("__size") + F.lit(BUCKET_WIDTH - 1), BUCKET_WIDTH)
    order = RowOrder(
        (F.col("__hash"), F.col(candidate)),
        lambda df: df.withColumn(BUCKET, hash_bucket(F.col("__hash"), slices)),
    )
    summed = running(
        weighted,
        order,
        {"__sum": Running("sum", F.col("__weight"), inclusive=True)},
        ["__group"],
        {"__total": "__sum"},
    )
    draw = unit_interval(seeded_hash(seed, F.col(group)))
    passed = F.col("__sum") > draw * F.col("__total")
    # Rounding may leave the last running sum a hair below the total: fall back to the last one.
    place = F.struct("__hash", candidate)
    return (
        summed.groupBy("__group")
        .agg(
            F.coalesce(F.min(F.when(passed, place)), F.max(place)).alias("__pick"),
        )
        .select(F.col("__group")[group].alias(group), F.col(f"__pick.{candidate}").alias(candidate))
    )


def _largest(
    candidates: DataFrame, group: str, candidate: str, logit: str, count: int
) -> DataFrame:
    """The `count` largest of each group: per salt first, so that a hot group is ranked in parts."""
    falling = [F.col(logit).desc(), F.col(candidate).asc()]
    salted = candidates.withColumn("__salt", F.pmod(F.xxhash64(candidate), F.lit(SALTS)))
    local = F.row_number().over(W.partitionBy(group, "__salt").orderBy(*falling))
    few = salted.withColumn("__rank", local).filter(F.col("__rank") <= count)
    # At most SALTS * count rows per group are left.
    final = F.row_number().over(W.partitionBy(group).orderBy(*falling))
    return few.withColumn("__rank", final).filter(F.col("__rank") <= count).drop("__salt", "__rank")


def context_cut(df: DataFrame, tokens: str, context_length: int) -> DataFrame:
    """Keep the last `context_length` ids."""
    if context_length <= 0:
        raise ValueError("context_length must be positive")
    start = F.greatest(F.lit(1), F.size(tokens) - F.lit(context_length - 1))
    return df.withColumn(tokens, F.slice(tokens, start, F.lit(context_length)))


def end_cut(df: DataFrame, tokens: str, end_id: int, start: Column | int = 0) -> DataFrame:
    """Cut after the first end id at or behind position `start`; unchanged without one."""
    offset = start if isinstance(start, Column) else F.lit(start)
    tail = F.slice(tokens, (offset + 1).cast("int"), F.size(tokens))
    found = F.array_position(tail, F.lit(end_id))
    keep = F.when(found > 0, offset + found).otherwise(F.size(tokens)).cast("int")
    return df.withColumn(tokens, F.slice(tokens, F.lit(1), keep))


def prompt_split(df: DataFrame, tokens: str, prompt_length: Column | int) -> DataFrame:
    """Add `prompt_ids` and `continuation_ids`."""
    length = (prompt_length if isinstance(prompt_length, Column) else F.lit(prompt_length)).cast("int")
    return df.withColumns(
        {
            "prompt_ids": F.slice(tokens, F.lit(1), length),
            "continuation_ids": F.slice(tokens, length + 1, F.size(tokens)),
        }
    )
