"""Bit fields of hashed keys: what a scan asks before it shuffles a row.

A key sets the bit of its hash. A field has at most 2**bits bits, whatever the number of keys, so it
is always broadcast. A row whose bit is not set has none of the keys; one whose bit is set may have
one, which a join decides. Beyond some 2**bits keys most bits are set and most rows are joined: more
is shuffled then, and nothing is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.session import written

#: Bits of a field: 2**24 bits are 2**18 rows at most.
FIELD_BITS = 24


def bits_of(hashes: DataFrame, bits: int = FIELD_BITS) -> DataFrame:
    """(word, field): the bits of the hashes (`key`), in words of 64."""
    place = F.shiftrightunsigned("key", 64 - bits)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place").bitwiseAND(63).cast("int"))
    return (
        hashes.select(place.alias("place"))
        .select(F.shiftright("place", 6).alias("word"), bit.alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("field"))
    )


def asked(rows: DataFrame, key: Column, field: DataFrame, bits: int = FIELD_BITS) -> DataFrame:
    """`rows` with `go`: whether the bit of their key, a hash, is set. A null key has none."""
    place = F.shiftrightunsigned("level_key", 64 - bits)
    at = F.col("place").bitwiseAND(63).cast("int")
    is_set = F.call_function("shiftrightunsigned", F.col("field"), at).bitwiseAND(1) == 1
    return (
        rows.withColumn("level_key", key)
        .withColumn("place", place)
        .withColumn("word", F.shiftright("place", 6))
        .join(F.broadcast(field), "word", "left")
        .withColumn("go", F.coalesce(is_set, F.lit(False)))
        .drop("word", "field", "place", "level_key")
    )


def joined(rows: DataFrame, key: str, found: DataFrame, bits: int = FIELD_BITS) -> DataFrame:
    """`rows` with the columns of `found`, whose `key` is unique; only rows whose bit is set are shuffled."""
    field = written(bits_of(found.select(F.xxhash64(key).alias("key")), bits), "joined-bits")
    return asked(rows, F.xxhash64(key), field, bits).where("go").drop("go").join(found, key)


def without(rows: DataFrame, key: str, dropped: DataFrame, bits: int = FIELD_BITS) -> DataFrame:
    """`rows` whose `key` is not in `dropped`, whatever their columns; only rows whose bit is set are shuffled.

    Both tables are read twice: write them first. A null key is never dropped.
    """
    field = written(bits_of(dropped.select(F.xxhash64(key).alias("key")), bits), "dropped-bits")
    whole = F.struct(*(F.col(f"`{name}`") for name in rows.columns)).alias("whole")
    told = asked(rows.select(whole), F.xxhash64(f"whole.{key}"), field, bits)
    names = dropped.select(F.col(key).alias("dropped"))
    sure, unsure = told.where("NOT go"), told.where("go")
    stay = unsure.join(names, unsure[f"whole.{key}"] == names["dropped"], "left_anti")
    return sure.unionByName(stay).select("whole.*")
