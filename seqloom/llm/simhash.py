"""Operator 3, SimHash near-duplicates: exact comparison of tiles with numpy.

Fingerprints come from word shingles in one pass. Equal fingerprints become one; the different ones
are laid out in tiles by the bit counts of their four 16-bit parts. Two fingerprints at distance r
differ by at most r in the sum of those counts, so only tile pairs within the radius are compared
and all others are skipped. A tile of more than `block` fingerprints is cut into blocks, a tile pair
into block pairs, and each pair is one row of a job: exclusive-or and bit counts of both blocks, all
against all, of which only a spanning forest of the links leaves the task. Stars find components.

The number of comparisons grows with the square of the number of different fingerprints, about
1.3 % of all pairs for random ones with four parts. Copies cost nothing: they share a fingerprint.

Defined results: null and blank texts have the fingerprint zero, which links like any other; texts
shorter than a shingle are one shingle; repeated rows are equal fingerprints; a null key never names
a component.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.llm.common import long_field, narrow, per_document, table
from seqloom.operators.components import components
from seqloom.session import written

#: Bits of a fingerprint and the seed of the shingle hash.
BITS, SEED = 64, 42
SHINGLE, RADIUS = 3, 2
PARTS, BLOCK = 4, 1024


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bits set in over half the hashes of the shingles, repeats included."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: ASCII case and ASCII white space only
    if not words:
        return 0
    join, digest = b" ".join, xxhash.xxh64_intdigest
    hashes = [digest(join(words[i : i + shingle]), SEED) for i in range(max(1, len(words) - shingle + 1))]
    totals = np.zeros(BITS, dtype=np.int64)
    for first in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[first : first + (1 << 16)], dtype="<u8")
        totals += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(totals * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    return per_document(docs, lambda: lambda text: (fingerprint(text, shingle),), [long_field("fp")])


def _part_counts(fp: Column, parts: int) -> list[Column]:
    width = BITS // parts
    if parts == 1:
        return [F.bit_count(fp)]
    mask = (1 << width) - 1
    return [F.bit_count(F.shiftrightunsigned(fp, width * k).bitwiseAND(F.lit(mask))) for k in range(parts)]


def _tile(counts: list[Column], parts: int) -> Column:
    base = BITS // parts + 1
    return sum((c * base**k for k, c in enumerate(counts)), F.lit(0)).cast("long")


def _steps(parts: int, radius: int) -> list[tuple[int, ...]]:
    """Differences of bit counts within the radius, one of each opposite pair."""
    steps = itertools.product(range(-radius, radius + 1), repeat=parts)
    return [s for s in steps if sum(map(abs, s)) <= radius and s >= (0,) * parts]


def _linked(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Edges of a spanning forest of all links between two blocks."""
    near = np.bitwise_count(left[:, None] ^ right[None, :]) <= radius
    a, b = np.nonzero(near)
    if not len(a):
        return None
    nodes, place = np.unique(np.concatenate([left[a], right[b]]), return_inverse=True)
    a, b = place[: len(a)], place[len(a) :]
    root = np.arange(len(nodes))
    while True:
        least = root.copy()
        np.minimum.at(least, a, root[b])
        np.minimum.at(least, b, root[a])
        least = least[least]
        if (least == root).all():
            break
        root = least
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def links(distinct: DataFrame, radius: int = RADIUS, parts: int = PARTS, block: int = BLOCK) -> DataFrame:
    """(u, v): edges between different fingerprints, connecting all that links connect."""
    counts = _part_counts(F.col("fp"), parts)
    tiled = distinct.select("fp", _tile(counts, parts).alias("tile"), F.array(*counts).alias("counts"))
    # one row per tile: at most (64 / parts + 1) ** parts, 83,521 for four parts
    sizes = tiled.groupBy("tile", "counts").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    sizes = written(sizes, "tiles")
    cells = (
        tiled.join(sizes.select("tile", "blocks"), "tile")
        .groupBy("tile", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int").alias("block"))
        .agg(F.collect_list("fp").alias("fps"))
    )
    cells = written(cells, "cells")
    base = BITS // parts + 1
    neighbours = F.array(
        *(
            F.when(
                F.forall(F.array(*(F.col("counts")[k] + s for k, s in enumerate(step))), lambda n: (n >= 0) & (n < base)),
                F.col("tile") + sum(s * base**k for k, s in enumerate(step)),
            )
            for step in _steps(parts, radius)
        )
    )
    other = sizes.select(F.col("tile").alias("tile2"), F.col("blocks").alias("blocks2"))
    jobs = (
        sizes.select("tile", "blocks", F.explode(neighbours).alias("tile2"))
        .join(other, "tile2")
        .select("tile", "tile2", "blocks2", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        .select("tile", "tile2", "block", F.explode(F.sequence(F.lit(0), F.col("blocks2") - 1)).alias("block2"))
        .where("tile <> tile2 or block <= block2")
    )
    right = cells.select(F.col("tile").alias("tile2"), F.col("block").alias("block2"), F.col("fps").alias("fps2"))
    pairs = jobs.join(cells, ["tile", "block"]).join(right, ["tile2", "block2"]).select("fps", "fps2")

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for name in ("fps", "fps2"):
                column = batch.column(name)
                values = column.values.to_numpy(zero_copy_only=False).view(np.uint64)
                sides.append((values, column.offsets.to_numpy()))
            (a, at), (b, bt) = sides
            found = [_linked(a[at[n] : at[n + 1]], b[bt[n] : bt[n + 1]], radius) for n in range(batch.num_rows)]
            found = [f for f in found if f and len(f[0])]
            if found:
                columns = [np.concatenate(side).view(np.int64) for side in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["u", "v"])

    return pairs.mapInArrow(compare, "u long, v long")


def near_duplicates(
    docs: DataFrame,
    radius: int = RADIUS,
    shingle: int = SHINGLE,
    parts: int = PARTS,
    block: int = BLOCK,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, fp, and component_id: the smallest key whose fingerprint is reachable."""
    marked = written(fingerprints(narrow(docs, id_col, text_col), shingle), "fingerprints")
    distinct = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = written(components(links(distinct, radius, parts, block)), "fingerprint-roots")
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(named.join(least, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
