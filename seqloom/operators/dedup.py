"""Exact and MinHash deduplication, inside and across dumps."""

from __future__ import annotations

import hashlib
from functools import partial
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField

from seqloom.functions.batches import with_columns_of_texts
from seqloom.operators.components import components
from seqloom.session import written

#: Shingle words, and the prime that hashes are taken by.
SHINGLE, PRIME = 5, 2**31 - 1
BANDS, BAND_ROWS = 14, 8
_SPACE = r"[\x20\x09-\x0D]+"
#: Shingles that are hashed by all functions at a time: their values stay in a core's cache.
_STEP = 256


def coefficients(count: int) -> list[tuple[int, int]]:
    """The factors of the hash functions: powers of two primitive roots."""
    return [(pow(48271, n, PRIME), pow(16807, n, PRIME)) for n in range(1, count + 1)]


def normal_text(text: Column) -> Column:
    """White space runs become one space, none at the ends."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), _SPACE, " "))


def dedup_exact(docs: DataFrame, key: str = "doc_id", text: str = "text", within: tuple[str, ...] = ()) -> DataFrame:
    """One row per different normalised text (inside each `within`): the lowest key and the copies.

    One aggregation on a digest: copies are combined before the shuffle, however many there are.
    """
    return (
        docs.groupBy(*within, F.md5(normal_text(F.col(text)).cast("binary")).alias("digest"))
        .agg(F.min(key).alias(key), F.count("*").alias("copies"))
        .drop("digest")
    )


def signatures_of(texts: list[str], hashes: int) -> list[pa.Array]:
    """The minima of each text (null if it has no words): a hash per different shingle, then all functions at once."""
    factors = np.array(coefficients(hashes), np.int64)
    md5, found = hashlib.md5, []
    for text in texts:
        words = text.encode().split()  # bytes: ASCII white space only
        if not words:
            found.append(None)
            continue
        joined, ends = b" ".join(words), list(accumulate(map(len, words), lambda end, size: end + size + 1))
        starts = [0, *(end + 1 for end in ends[: max(0, len(ends) - SHINGLE)])]
        shingles = {joined[start:end] for start, end in zip(starts, ends[min(SHINGLE, len(ends)) - 1 :], strict=True)}
        digests = np.frombuffer(b"".join([md5(s).digest() for s in shingles]), ">u4")
        hashed = digests[::4].astype(np.int64) % PRIME
        least = np.full(hashes, PRIME, np.int64)
        for first in range(0, len(hashed), _STEP):
            values = factors[:, :1] * hashed[first : first + _STEP]
            values += factors[:, 1:]
            values %= PRIME
            np.minimum(least, values.min(axis=1), out=least)
        found.append(least)
    return [pa.array(found, pa.list_(pa.int64()))]


def minhash_signature(
    docs: DataFrame, key: str = "doc_id", text: str = "text", hashes: int = BANDS * BAND_ROWS, keep: tuple[str, ...] = ()
) -> DataFrame:
    """key, `keep` and `signature`: the least value of each hash function over the word shingles.

    Texts shorter than a shingle are one shingle; texts without words (null, empty, blank) have no
    signature and no row; repeated rows have a row each; null keys are kept. Shingles stay in the
    Arrow batch of their text: nothing is shuffled.
    """
    names = {name: f"c{n}" for n, name in enumerate((key, *keep))}
    slim = docs.select(*(F.col(name).alias(c) for name, c in names.items()), F.col(text).alias("t"))
    field = StructField("signature", ArrayType(LongType()))
    signed = with_columns_of_texts(slim, "t", partial(signatures_of, hashes=hashes), [field]).where("signature IS NOT NULL")
    return signed.select(*(F.col(c).alias(name) for name, c in names.items()), "signature")


def minhash_clusters(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    within: tuple[str, ...] = (),
    bands: int = BANDS,
    rows: int = BAND_ROWS,
) -> DataFrame:
    """key and `cluster_id`, the lowest key reachable over equal bands (inside each `within`).

    A bucket links its members to its lowest key, never to each other, and that key comes from an
    aggregation that combines before its shuffle: a bucket of any size costs one row per member.
    """
    signed = written(minhash_signature(docs, key, text, bands * rows, within), "signatures")
    cut = F.array(*(F.array_join(F.slice("signature", n * rows + 1, rows), ",") for n in range(bands)))
    banded = signed.select(key, *within, F.posexplode(cut).alias("band", "values")).select(
        key, *within, "band", F.md5(F.col("values").cast("binary")).alias("bucket")
    )
    names = [*within, "band", "bucket"]
    lowest = banded.groupBy(*names).agg(F.min(key).alias("__low"), F.count("*").alias("__n")).where("__n > 1")
    edges = banded.join(lowest, names).where(F.col(key) != F.col("__low"))
    roots = components(edges.select(F.col(key).alias("u"), F.col("__low").alias("v")))
    return docs.select(key).join(roots.withColumnRenamed("node", key), key, "left").select(
        key, F.coalesce("root", key).alias("cluster_id")
    )


def keep_newest(docs: DataFrame, clusters: DataFrame, dump: str, key: str = "doc_id") -> DataFrame:
    """key, cluster_id and `kept`: one document per cluster, from its last dump, the lowest key there."""
    placed = clusters.join(docs.select(key, dump), key)
    best = F.max_by(F.struct(key), F.struct(dump, -F.col(key))).alias("__best")
    chosen = placed.groupBy("cluster_id").agg(best)
    return placed.join(chosen, "cluster_id").select(
        key, "cluster_id", (F.col(f"__best.{key}") == F.col(key)).alias("kept")
    )


def dedup_report(kept: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents, labelled documents and mean labels of what was kept and what was dropped."""
    return (
        kept.join(labels, key, "left")
        .groupBy("kept")
        .agg(
            F.count("*").alias("documents"),
            F.count("quality").alias("labelled"),
            F.avg("quality").alias("mean_quality"),
            F.avg("toxic").alias("mean_toxic"),
        )
    )


def cluster_sizes(clusters: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """size, clusters, documents: how many clusters have how many documents.

    Counted twice, each time combined before the shuffle: a cluster of any size is one row of counts.
    Documents without a cluster (null) are one cluster; an empty table gives an empty table.
    """
    counted = clusters.groupBy(cluster).agg(F.count("*").alias("size"))
    return counted.groupBy("size").agg(F.count("*").alias("clusters"), F.sum("size").alias("documents"))
