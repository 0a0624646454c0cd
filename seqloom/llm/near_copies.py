"""Near copies by the Jaccard similarity of word shingles: MinHash candidates, exact comparison.

Texts of one shingle set become one. Bands of MinHash values link the others to candidate groups: a
bucket links to its lowest key, which loses no candidate, since the groups are closed over all links.
Only their texts are shuffled.
A group is cut into blocks, block pairs are the jobs, and each compares the shingle sets themselves,
all pairs that are not connected yet; only a spanning forest of the links leaves the task.

A pair at similarity s is no candidate with a chance of (1 - s**BAND_ROWS)**BANDS: 1.3e-7 at 0.8. No
pair below the similarity is linked.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField

from seqloom.llm.bit_fields import joined, without
from seqloom.llm.common import narrow, per_document, string_field
from seqloom.operators.components import components
from seqloom.session import written

SHINGLE, SIMILAR, SEED = 5, 0.8, 42
BANDS, BAND_ROWS = 40, 5
#: Most texts of a block, and characters of it about.
BLOCK, CHARACTERS = 2048, 1 << 23


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Different hashes of the shingles in order; a shorter text is one shingle, a blank one has none."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: ASCII case and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    join, digest = b" ".join, xxhash.xxh64_intdigest
    hashes = [digest(join(words[i : i + shingle]), SEED) for i in range(max(1, len(words) - shingle + 1))]
    return np.unique(np.array(hashes, np.uint64))


def _marker():
    """A function that gives the digest of a text's shingle set and the buckets of its bands."""
    import xxhash

    draw = np.random.default_rng(SEED)
    salt = draw.integers(0, 1 << 63, BANDS * BAND_ROWS, dtype=np.uint64)[:, None]
    factor = draw.integers(0, 1 << 63, BANDS * BAND_ROWS, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)

    def mark(text: str | None) -> tuple[str, list[int]]:
        found = shingles(text)
        digest = xxhash.xxh3_128_hexdigest(found.tobytes())
        if not len(found):
            return digest, []
        parts = [((found[n : n + 4096] ^ salt) * factor).min(axis=1) for n in range(0, len(found), 4096)]
        bands = np.min(parts, axis=0).reshape(BANDS, BAND_ROWS)
        return digest, [xxhash.xxh64_intdigest(b.tobytes(), n) - (1 << 63) for n, b in enumerate(bands)]

    return mark


def _linked(sets: list[np.ndarray], half: int, least: float) -> np.ndarray:
    """The lowest place linked to each set: all pairs if `half` is 0, else the first `half` against the rest."""
    from fractions import Fraction

    share = Fraction(str(least))
    root = np.arange(len(sets))
    sizes = np.array([len(s) for s in sets])
    whole, start = np.concatenate(sets), np.concatenate([[0], np.cumsum(sizes)[:-1]])
    for n in range(half or len(sets)):
        first = half or n + 1
        if first == len(sets) or (root[first:] == root[n]).all():
            continue
        own = sets[n]
        place = np.minimum(np.searchsorted(own, whole[start[first] :]), len(own) - 1)
        common = np.add.reduceat((own[place] == whole[start[first] :]).astype(np.int64), start[first:] - start[first])
        near = common * share.denominator >= (sizes[first:] + len(own) - common) * share.numerator
        ends = np.unique(np.append(root[first:][near], root[n]))
        root[np.isin(root, ends)] = ends[0]
    return root


def _links(texts: DataFrame, least: float, block: int) -> DataFrame:
    """(u, v): edges between the `texts` (doc_id, text, root), connecting all pairs of a root at `least`."""
    blocks = texts.groupBy("root").agg(F.ceil(F.greatest(F.count("*") / block, F.sum(F.length("text")) / CHARACTERS)).cast("int").alias("n"))
    own = F.pmod(F.xxhash64("doc_id"), F.col("n")).cast("int")
    cut = texts.join(blocks, "root").withColumn("b", own)
    jobs = cut.select("doc_id", "text", "root", "b", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("o")).select(
        "doc_id", "text", "root", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), (F.col("b") > F.col("o")).alias("right")
    )

    def compare(job: pa.Table) -> pa.Table:
        job = job.sort_by("right")
        half = 0 if job.column("i")[0] == job.column("j")[0] else job.column("right").to_pylist().count(False)
        keys = job.column("doc_id").to_numpy()
        alone = half == job.num_rows or (not half and job.column("i")[0] != job.column("j")[0])
        root = np.arange(job.num_rows) if alone else _linked([shingles(str(t)) for t in job.column("text")], half, least)
        moved = root != np.arange(len(root))
        return pa.table({"u": keys[moved], "v": keys[root[moved]]})

    return jobs.groupBy("root", "i", "j").applyInArrow(compare, "u long, v long")


def near_copies(docs: DataFrame, least: float = SIMILAR, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and component_id, the smallest key reachable over texts at Jaccard similarity `least`.

    Keys are numbers, unique and not null.
    """
    slim = narrow(docs, id_col, text_col)
    marked = written(per_document(slim, _marker, [string_field("same"), StructField("bands", ArrayType(LongType()))]), "bands")
    # read back, so that the join is dealt anew and a large group of copies is split
    single = written(marked.groupBy("same").agg(F.min("doc_id").alias("least")), "sets")
    named = written(marked.select("doc_id", "same").join(single, "same").select("doc_id", "least"), "named")
    banded = without(marked, "doc_id", named.where("doc_id <> least")).select("doc_id", F.explode("bands").alias("bucket"))
    lowest = banded.groupBy("bucket").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")).where("n > 1")
    edges = banded.join(lowest, "bucket").where("doc_id <> low").select(F.col("doc_id").alias("u"), F.col("low").alias("v"))
    groups = components(edges).select(F.col("node").alias("doc_id"), "root")
    texts = written(joined(slim, "doc_id", groups), "candidates")
    roots = components(_links(texts, least, block)).select(F.col("node").alias("least"), "root")
    return named.join(roots, "least", "left").select("doc_id", F.coalesce("root", "least").alias("component_id"))
