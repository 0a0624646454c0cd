"""Running values over a total order, without a window that holds a whole group.

A plain `Window.partitionBy(key).orderBy(x)` sorts all rows of a key in one task, and without a
key all rows of the table. Here the order is cut into buckets first:

1. local running value inside each (key, bucket), one shuffle of the rows;
2. one total per (key, bucket), combined before its shuffle, and a running value over the totals;
3. local value + carry of the earlier buckets.

A key that holds a third of the table is thus spread over as many tasks as it has buckets.
"""

from __future__ import annotations

import json
import math
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from seqloom.functions.hashing import HASH_BITS, hash_bucket, seeded_digest, seeded_hash
from seqloom.functions.numeric import int_div

BUCKET = "__bucket"
# Upper bound of buckets of an order over a whole table: their totals fit in one task and in a
# broadcast whatever the size of the data.
MAX_BUCKETS = 1 << 16
# Rows per bucket where the order is a unique integer inside its key.
BUCKET_WIDTH = 1 << 16
# Sampled rows per bucket where a value is split by its ties.
SPLIT_ROWS = 32


@dataclass(frozen=True)
class RowOrder:
    """A total order and a bucket that never decreases along it."""

    sort: tuple[Column, ...]
    add_bucket: Callable[[DataFrame], DataFrame]
    # Proven bound on the number of distinct buckets, or None if it grows with the data.
    max_buckets: int | None = None


def by_value(df: DataFrame, column: str, ties: Sequence[str] = (), buckets: int | None = None) -> RowOrder:
    """Order by a numeric, date or timestamp column with buckets of about equal row counts.

    The bucket bounds come from one approximate-quantile aggregate over that column alone. A value
    that fills several buckets is split further by `ties`, at splitters from a sample. Bounds and
    splitters steer only the balance, never the result. `column` and `ties` together must be unique.
    """
    _require(df, [column, *ties])
    count = buckets or default_buckets(df)
    if not 0 < count <= MAX_BUCKETS:
        raise ValueError(f"buckets must be between 1 and {MAX_BUCKETS}")
    number = _as_double(df, column)
    probabilities = [i / count for i in range(1, count)]
    found: Counter[float] = Counter()
    rows = 0
    if probabilities:
        quantiles = F.percentile_approx(number, probabilities, 10 * count).alias("q")
        row = df.agg(quantiles, F.count("*").alias("n")).first()
        found, rows = Counter(bound for bound in row["q"] or [] if math.isfinite(bound)), row["n"]
    bounds = sorted(found)
    splits = [float("-inf"), *bounds, float("inf")]

    def add_range(frame: DataFrame) -> DataFrame:
        key = "__order_key"
        keyed = frame.withColumn(key, _present(number, column))
        if not bounds:
            return keyed.withColumn(BUCKET, F.col(key).cast("bigint") * 0).drop(key)
        cut = Bucketizer(splits=splits, inputCol=key, outputCol=BUCKET).transform(keyed)
        return cut.withColumn(BUCKET, F.col(BUCKET).cast("bigint")).drop(key)

    parts = [1, *(found[bound] for bound in bounds)]
    add_bucket = add_range
    # Buckets of fewer rows than the sample takes are not worth a split.
    if max(parts) > 1 and rows >= SPLIT_ROWS * count:
        sample = add_range(df.select(column, *ties)).sample(SPLIT_ROWS * count / rows, seed=0)
        add_bucket = _split_ranges(sample, add_range, [column, *ties], parts)
    return RowOrder((F.col(column), *[F.col(t) for t in ties]), add_bucket, count)


def _split_ranges(
    sample: DataFrame, add_range: Callable[[DataFrame], DataFrame], columns: Sequence[str], parts: Sequence[int]
) -> Callable[[DataFrame], DataFrame]:
    """Cuts each range into its number of parts, by the tuple of `columns`; buckets are numbered on.

    A range is cut at tuples of equal distance in its sorted sample, SPLIT_ROWS times the buckets in
    all. A row finds its part by halving, so many parts cost little.
    """
    place = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    fields = [f"t{n}" for n in range(len(columns))]
    row = F.struct(*[F.col(c).alias(f) for f, c in zip(fields, columns, strict=True)])
    wide = F.get(F.from_json(F.lit(json.dumps(list(parts))), "array<int>"), F.col(BUCKET).cast("int"))
    tuples = F.array_sort(F.collect_list(row))
    cuts = F.transform(
        F.sequence(F.lit(1), F.col("__parts") - 1),
        lambda n: F.get(F.col("__sorted"), F.floor(n * F.size("__sorted") / F.col("__parts")).cast("int")),
    )
    grouped = sample.withColumn("__parts", wide).where("__parts > 1").groupBy(BUCKET, "__parts").agg(tuples.alias("__sorted"))
    kept = grouped.select(BUCKET, cuts.alias("cuts"))
    cut_type = kept.schema["cuts"].dataType.simpleString()
    found = {r[0]: r[1] for r in kept.select(BUCKET, F.to_json("cuts", place)).collect()}
    text = "[" + ",".join(found.get(n, "[]") for n in range(len(parts))) + "]"
    starts = list(accumulate(parts, initial=0))[:-1]
    halves = [1 << n for n in reversed(range(max(parts).bit_length()))]

    def add_bucket(frame: DataFrame) -> DataFrame:
        here = F.col(BUCKET).cast("int")
        own = F.get(F.from_json(F.lit(text), f"array<{cut_type}>", place), here)
        first = F.get(F.from_json(F.lit(json.dumps(starts)), "array<bigint>"), here)
        part = F.aggregate(
            F.array(*[F.lit(h) for h in halves]),
            F.lit(0),
            lambda at, half: F.when(F.get(own, at + half - 1) <= row, at + half).otherwise(at),
        )
        return add_range(frame).withColumn(BUCKET, first + part)

    return add_bucket


def by_hash(df: DataFrame, seed: int, key: str, buckets: int | None = None) -> RowOrder:
    """A seeded permutation: order by md5 of seed and key. The buckets are slices of the hash.

    Rows sort by the first 60 bits; the rest of the digest, then the key, decide between equal ones.
    """
    _require(df, [key])
    count = buckets or default_buckets(df)
    if not 0 < count <= MAX_BUCKETS:
        raise ValueError(f"buckets must be between 1 and {MAX_BUCKETS}")
    name, rest = "__order_hash", "__order_rest"

    def add_bucket(frame: DataFrame) -> DataFrame:
        # Columns, as a sort would compute an expression anew for each comparison.
        present = _present(F.col(key), key)
        tail = F.substring(seeded_digest(seed, present), HASH_BITS // 4 + 1, 17)
        hashed = frame.withColumns({name: seeded_hash(seed, present), rest: tail})
        return hashed.withColumn(BUCKET, hash_bucket(F.col(name), count))

    return RowOrder((F.col(name), F.col(rest), F.col(key)), add_bucket, count)


def by_width(column: str, ties: Sequence[str] = (), width: int | None = None) -> RowOrder:
    """Order by an integer column; a bucket spans `width` of its values.

    Holds at most `width` rows per bucket where the column is unique inside its key.
    """
    width = width or BUCKET_WIDTH
    return RowOrder(
        (F.col(column), *[F.col(t) for t in ties]),
        lambda frame: frame.withColumn(
            BUCKET, F.floor(_present(F.col(column), column) / F.lit(width)).cast("bigint")
        ),
    )


def default_buckets(df: DataFrame) -> int:
    """A few buckets per shuffle partition, so that hashing them spreads evenly."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(max(8 * partitions, 16), MAX_BUCKETS)


@dataclass(frozen=True)
class Running:
    """One running value: `op` over `value`, with or without the current row.

    `last` is the latest value that is not null; its order must be one unique column. Values of
    fixed width (numbers, not structs) keep the bucket totals a hash aggregation.
    """

    op: str  # sum, min, max or last
    value: Column
    inclusive: bool = False

    def aggregate(self, value: Column) -> Column:
        if self.op == "last":
            return F.last(value, ignorenulls=True)
        return {"sum": F.sum, "min": F.min, "max": F.max}[self.op](value)

    def total(self, order: RowOrder) -> Column:
        if self.op == "last":
            return F.max_by(self.value, F.when(self.value.isNotNull(), order.sort[0]))
        return self.aggregate(self.value)

    def combine(self, carry: Column, local: Column) -> Column:
        if self.op == "last":
            return F.coalesce(local, carry)
        if self.op == "sum":
            return F.coalesce(carry, F.lit(0)) + F.coalesce(local, F.lit(0))
        # least and greatest skip nulls
        return F.least(carry, local) if self.op == "min" else F.greatest(carry, local)


def running(
    df: DataFrame,
    order: RowOrder,
    values: Mapping[str, Running],
    keys: Sequence[str] = (),
    group_totals: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add one column per running value; exact for any bucket layout.

    `group_totals` maps a new column to a running value: its total over the whole key, which falls
    out of the bucket totals and so needs no join on a hot key.
    """
    group_totals = dict(group_totals or {})
    _require(df, keys)
    staged = order.add_bucket(df)
    for key in keys:
        staged = staged.withColumn(key, _present(F.col(key), key))
    group = [*keys, BUCKET]

    here = W.partitionBy(*group).orderBy(*order.sort)
    first = W.unboundedPreceding
    local = staged.withColumns(
        {
            name: r.aggregate(r.value).over(here.rowsBetween(first, 0 if r.inclusive else -1))
            for name, r in values.items()
        }
    )

    totals = staged.groupBy(*group).agg(
        *[r.total(order).alias(f"__total_{name}") for name, r in values.items()]
    )
    # Without keys this window has no partition: it runs over at most MAX_BUCKETS rows.
    along = W.partitionBy(*keys).orderBy(BUCKET) if keys else W.orderBy(BUCKET)
    earlier = along.rowsBetween(first, -1)
    everywhere = W.partitionBy(*keys) if keys else W.partitionBy()
    carries = totals.select(
        *group,
        *[
            r.aggregate(F.col(f"__total_{name}")).over(earlier).alias(f"__carry_{name}")
            for name, r in values.items()
        ],
        *[
            values[name].aggregate(F.col(f"__total_{name}")).over(everywhere).alias(f"__all_{column}")
            for column, name in group_totals.items()
        ],
    )
    if not keys and order.max_buckets is not None:
        carries = F.broadcast(carries)  # at most MAX_BUCKETS rows
    else:
        # The rows already lie by `group`. The planner does not see how many an explode has made, and
        # would broadcast them all where they look fewer than the totals.
        carries = carries.hint("merge")

    joined = local.join(carries, group)
    kept = [c for c in df.columns if c not in values]
    return joined.select(
        *[F.col(c) for c in kept],
        *[
            r.combine(F.col(f"__carry_{name}"), F.col(name)).alias(name)
            for name, r in values.items()
        ],
        *[F.col(f"__all_{column}").alias(column) for column in group_totals],
    )


def ordinal(
    df: DataFrame,
    order: RowOrder,
    name: str = "row_idx",
    keys: Sequence[str] = (),
    size: str | None = None,
) -> DataFrame:
    """Add the 0-based position of each row in the order, per key; `size` also adds the count."""
    return running(
        df,
        order,
        {name: Running("sum", F.lit(1).cast("bigint"))},
        keys,
        {size: name} if size else None,
    )


def hash_rank(
    df: DataFrame, keys: Sequence[str], hashed: Column, tie: str, size: Column, name: str
) -> DataFrame:
    """Add the 0-based rank of each row by hash inside its key.

    `size` is the (known) row count of the key: it sets how many hash slices the key is cut
    into, about BUCKET_WIDTH rows each, so that a small key stays whole and a huge one is split.
    """
    slices = int_div(size + F.lit(BUCKET_WIDTH - 1), BUCKET_WIDTH)
    staged = df.withColumns({"__hash": hashed, "__slices": slices})
    order = RowOrder(
        (F.col("__hash"), F.col(tie)),
        lambda frame: frame.withColumn(BUCKET, hash_bucket(F.col("__hash"), F.col("__slices"))),
    )
    return ordinal(staged, order, name, keys).drop("__hash", "__slices")


def trailing(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    rows: int,
    values: Mapping[str, Callable[[Column], Column]],
    width: int | None = None,
) -> DataFrame:
    """Aggregates over the last `rows` rows of a key, by a dense 0-based position.

    Each bucket of positions also gets copies of the `rows - 1` rows before it, so that a bucket
    can be computed alone; the copies are dropped afterwards.
    """
    if rows <= 0:
        raise ValueError("rows must be positive")
    width = max(width or BUCKET_WIDTH, rows)
    bucket = int_div(F.col(position), width)
    reaches_next = F.col(position) % F.lit(width) >= F.lit(width - (rows - 1))
    homes = F.when(reaches_next, F.array(bucket, bucket + 1)).otherwise(F.array(bucket))
    copies = df.withColumn(BUCKET, F.explode(homes))
    span = W.partitionBy(*keys, BUCKET).orderBy(position).rowsBetween(-(rows - 1), 0)
    computed = copies.withColumns({name: f(span) for name, f in values.items()})
    return computed.filter(F.col(BUCKET) == bucket).drop(BUCKET)


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join by equal keys where null equals null, so that no row of a null key is lost."""
    renamed = right.withColumnsRenamed({key: f"__right_{key}" for key in keys})
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"__right_{key}"))
    return left.join(renamed, same).drop(*[f"__right_{key}" for key in keys])


def _require(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(
            f"no column(s) {', '.join(missing)} among: {', '.join(sorted(df.columns))}"
        )


def _present(value: Column, name: str) -> Column:
    """Fail on a null key instead of losing its rows in a join."""
    return F.when(value.isNull(), F.raise_error(F.lit(f"{name} must not be null"))).otherwise(value)


def _as_double(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType.typeName()
    value = F.col(column)
    if kind in ("byte", "short", "integer", "long", "float", "double") or kind.startswith("decimal"):
        return value.cast("double")
    if kind == "date":
        return F.unix_date(value).cast("double")
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    raise TypeError(
        f"cannot order by {column} of type {kind}: use a number, a date, a timestamp, "
        "or a hash order of the key"
    )
