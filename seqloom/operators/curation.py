"""Subsets, filter discovery, semantic duplicates, quality classifier and conversation pairs."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, StructField, StructType

from seqloom.functions.hashing import seeded_digest
from seqloom.functions.vectors import bind
from seqloom.llm.bit_fields import asked, bits_of
from seqloom.operators.components import components
from seqloom.operators.ordered import Running, by_value, running
from seqloom.session import written

_SALTS = 64
#: Numbers in a block of vectors, and rows of a block that are multiplied at a time.
_CELL, _STEP = 1 << 22, 256
#: Most centres of cells, and rows for each that they are fitted on.
_CENTRES, _FIT = 4096, 64
#: Cosines made at a time, sketches in the space of a vector, and guests of a block for each row at home there.
_PRODUCTS, _LEAN, _GUESTS = 1 << 20, 4, 2
#: Most tasks that fit centres: each sends all of them in every round.
_FITTING = 32
_SKETCH = [StructField(n, k) for n, k in (("__d", IntegerType()), ("__k", BinaryType()), ("__s", DoubleType()), ("__q", BinaryType()))]


def stratified_sample(docs: DataFrame, strata: list[str], per_stratum: int, seed: int = 42, key: str = "doc_id") -> DataFrame:
    """key, strata and `place`: the `per_stratum` rows of each stratum that come first by md5.

    Ranked per salt first: a stratum with most of the rows is ranked in parts.
    """
    drawn = docs.select(key, *strata, seeded_digest(seed, F.col(key)).alias("__d"))
    salted = drawn.withColumn("__s", F.pmod(F.xxhash64(key), F.lit(_SALTS)))
    local = F.row_number().over(W.partitionBy(*strata, "__s").orderBy("__d", key))
    few = salted.withColumn("place", local).where(F.col("place") <= per_stratum)
    final = F.row_number().over(W.partitionBy(*strata).orderBy("__d", key))
    return few.withColumn("place", final).where(F.col("place") <= per_stratum).select(
        key, *strata, F.col("place").cast("bigint").alias("place")
    )


def filter_discovery(first: DataFrame, second: DataFrame, features: dict[str, tuple[float, float, int]]) -> DataFrame:
    """(feature, bucket, first_share, second_share, ratio): histograms of two sets, side by side.

    `features` gives low, high and bucket count of each column; values outside fall into bucket 0 and
    the one behind the last. A large ratio marks a candidate threshold.
    """

    def histogram(df: DataFrame, name: str) -> DataFrame:
        boxes = F.array(
            *(
                F.struct(F.lit(c).alias("feature"), F.width_bucket(F.col(c).cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(n)).alias("bucket"))
                for c, (low, high, n) in features.items()
            )
        )
        counts = df.select(F.inline(boxes)).where("bucket is not null").groupBy("feature", "bucket").agg(F.count("*").alias("n"))
        total = counts.groupBy("feature").agg(F.sum("n").alias("all"))
        return counts.join(total, "feature").select("feature", "bucket", (F.col("n") / F.col("all")).alias(name))

    both = histogram(first, "first_share").join(histogram(second, "second_share"), ["feature", "bucket"], "full")
    shares = both.fillna(0.0, ["first_share", "second_share"])
    ratio = F.when(F.col("second_share") > 0, F.col("first_share") / F.col("second_share"))
    return shares.withColumn("ratio", ratio)


def _sketches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vectors (__u) as 16-bit numbers: their length, a digest of all their bytes, the step of a number, the numbers."""
    for batch in batches:
        batch = batch.filter(pc.is_valid(batch.column("__u")))
        sizes = pc.list_value_length(batch.column("__u")).to_numpy()
        for size in np.unique(sizes):
            part = batch.filter(pa.array(sizes == size))
            units = part.column("__u").flatten().to_numpy().reshape(-1, size) + 0.0  # -0.0 is 0.0
            steps = np.abs(units).max(axis=1) / 32767
            codes = np.rint(units / steps[:, None]).astype("<i2")
            new = {
                "__d": pa.array(np.full(len(units), size, np.int32)),
                "__k": pa.array([hashlib.blake2b(x, digest_size=16).digest() for x in units], pa.binary()),
                "__s": pa.array(steps),
                "__q": pa.array([x.tobytes() for x in codes], pa.binary()),
            }
            yield pa.RecordBatch.from_pydict({n: part.column(n) for n in part.schema.names} | new)


def _sketched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in _sketches(batches):
        yield part.select(["u", "__l", *(f.name for f in _SKETCH)])


def _of_sketches(batch: pa.RecordBatch | pa.Table, kind: str) -> np.ndarray:
    """The vectors of `_sketches`: each is within sqrt(elements) / 2 of its steps of the exact one."""
    codes = np.frombuffer(b"".join(batch.column("__q").to_pylist()), "<i2").reshape(batch.num_rows, -1)
    return codes.astype(kind) * batch.column("__s").to_numpy().astype(kind)[:, None]


def _unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Link the places `a` and `b` in `root`, the lowest place linked to each place."""
    a, b = root[a], root[b]
    while len(a):
        high, low = np.maximum(root[a], root[b]), np.minimum(root[a], root[b])
        apart = high != low
        a, b = a[apart], b[apart]
        np.minimum.at(root, high[apart], low[apart])
        while (root[root] != root).any():
            root[:] = root[root]


def _compared(job: pa.Table, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lowest place linked to each row of `job`, and pairs too close to `least` for sketches that it leaves apart.

    Rows at home (__h) are compared with those that visit their cell (__c in __w); guests are not compared with each other.
    """
    units = _of_sketches(job, "float32")
    size, home = units.shape[1], job.column("__h").to_numpy()
    off = math.sqrt(size) / 2 * job.column("__s").to_numpy().max()
    slack = 3 * off + (size + 4) * 2.0**-23  # of the sketches, and of sums of 32-bit products
    lists = job.column("__w").combine_chunks()
    visitor = np.repeat(np.arange(job.num_rows, dtype=np.int32), pc.list_value_length(lists).to_numpy())
    cells = lists.flatten().to_numpy()
    if job.column("__p")[0].as_py():  # the rows at home are compared with each other in the first part
        cells, visitor = cells[~home[visitor]], visitor[~home[visitor]]
    order = np.argsort(cells, kind="stable")
    cells, visitor = cells[order], visitor[order]
    own = np.flatnonzero(home)
    own = own[np.argsort(job.column("__c").to_numpy()[own], kind="stable")]
    found, starts = np.unique(job.column("__c").to_numpy()[own], return_index=True)
    root, doubts, links, held = np.arange(job.num_rows), [], [], 0

    def settle() -> None:
        if links:
            _unite(root, *np.concatenate(links, axis=1))
        doubts[:] = [x[:, root[x[0]] != root[x[1]]] for x in doubts]
        links.clear()

    for cell, first, last in zip(found, starts, [*starts[1:], len(own)], strict=True):
        at = own[first:last]
        guests = visitor[np.searchsorted(cells, cell) : np.searchsorted(cells, cell, side="right")]
        wide = max(_STEP, _PRODUCTS // len(at))
        for begin in range(0, len(guests), wide):
            part = guests[begin : begin + wide]
            near = units[part] @ units[at].T
            a, b = np.nonzero(near >= least - slack)
            sure, pair = near[a, b] >= least + slack, np.stack([part[a], at[b]])
            links.append(pair[:, sure])
            doubts.append(pair[:, ~sure & (pair[0] != pair[1])])
            held += len(a)
            if held > _PRODUCTS:
                settle()
                held = 0
    settle()
    return root, *(np.concatenate(doubts, axis=1) if doubts else np.empty((2, 0), int))


def _cell_centres(rows: DataFrame, count: int, of: int) -> np.ndarray:
    """k-means centres of the `of` sketches in `rows`, fitted on at most about `_FIT` rows for each centre."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    def exact(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                units = _of_sketches(batch, "float64")
                yield pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(units.ravel()), units.shape[1]).cast(pa.list_(pa.float64()))], ["__u"])

    share = min(1.0, _FIT * count / max(1, of))
    drawn = rows.where(F.pmod(F.xxhash64("u", F.lit(2)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    drawn = written(drawn.select("__s", "__q"), "drawn").coalesce(_FITTING).mapInArrow(exact, "__u array<double>")
    # By blocks: the other solver runs a task per centre in every round, for the distances between centres.
    model = KMeans(k=count, maxIter=8, seed=42, initMode="random", solver="block").fit(drawn.select(array_to_vector("__u").alias("features")))
    return _side_by_side(np.array(model.clusterCenters()))


def _side_by_side(centres: np.ndarray) -> np.ndarray:
    """`centres` in an order in which near ones mostly follow each other: halved along their widest direction, again and again."""
    if len(centres) < 3:
        return centres
    apart = centres - centres.mean(axis=0)
    along = apart @ np.linalg.eigh(apart.T @ apart)[1][:, -1]
    order, half = np.argsort(along, kind="stable"), len(centres) // 2
    return np.concatenate([_side_by_side(centres[order[:half]]), _side_by_side(centres[order[half:]])])


def _distances(centres: np.ndarray) -> np.ndarray:
    """Made in 64 bits, as small ones are differences of large numbers, a few rows at a time."""
    made, exact = np.empty((len(centres),) * 2, centres.dtype), centres.astype(float)
    lengths = (exact * exact).sum(axis=1)
    for first in range(0, len(centres), _STEP):
        part = slice(first, first + _STEP)
        made[part] = np.sqrt(np.maximum(lengths + lengths[part, None] - 2 * exact[part] @ exact.T, 0))
    return made


def _visited(units: np.ndarray, centres: np.ndarray, margin: float, apart: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places, cells, at home): the nearest cell of each vector, and those whose border is within `margin`.

    `apart` are the `_distances` of the centres. In 32 bits the margin is wider by what sums may be off.
    """
    lengths = (centres * centres).sum(axis=1)
    slack = 1e-9 if units.dtype == np.float64 else (centres.shape[1] + 4) * 2.0**-21
    apart = _distances(centres) if apart is None else apart
    for first in range(0, len(units), _STEP):
        part = units[first : first + _STEP]
        far = lengths - 2 * part @ centres.T
        home = far.argmin(axis=1)
        far -= far[np.arange(len(part)), home][:, None]
        place, cell = np.nonzero(far <= apart[home] * (2 * margin) + slack)
        yield place + first, cell, cell == home[place]


def _in_cells(rows: DataFrame, least: float, block: int, cell: int, border: float | None) -> DataFrame:
    """`rows` with their cell `__c`, the block `__o` of cells that it is in, and `__v`: each block visited (__b) and its cells visited (__w).

    A label of up to `cell` vectors is one cell. The centres of the others are as many as the largest
    of them needs, at most `_CENTRES`, and the same for all labels: their size is bounded, so tasks get them whole.
    Cells side by side are a block, of about `_LEAN` times `block` sketches at home if the label is spread evenly.
    """
    kind = "array<struct<__b:int,__w:array<smallint>>>"
    one = rows.withColumns({"__c": F.lit(0).cast("smallint"), "__o": F.lit(0), "__v": F.expr(f"cast(array(named_struct('__b', 0, '__w', array(0))) as {kind})")})
    sizes = rows.groupBy("__l", "__d").agg(F.count("*").alias("__n"))
    large = written(sizes.where(F.col("__n") > cell), "large-labels")
    most = {r["__d"]: (r["m"], r["n"]) for r in large.groupBy("__d").agg(F.max("__n").alias("m"), F.sum("__n").alias("n")).collect()}
    if not most:
        return one
    found = one.join(large.select("__l", "__d"), ["__l", "__d"], "left_anti").select(one.columns)
    for size, (count, all_of) in most.items():
        wide = _LEAN * max(1, min(block, _CELL // size))
        own = rows.where(F.col("__d") == size).join(large.select("__l", "__d", F.ceil(F.col("__n") / wide).alias("__m")), ["__l", "__d"])
        centres = _cell_centres(own, max(2, min(_CENTRES, -(-2 * count // cell))), all_of)
        share = min(0.5, 1.6 / math.sqrt(size)) if border is None else border
        margin = share * (math.sqrt(max(0.0, 2 - 2 * least)) + math.sqrt(size) / 32767)  # the sketches of a pair may be farther apart
        known, kept, names = rows.sparkSession.sparkContext.broadcast(centres.astype("float32")), rows.columns, one.columns

        def assign(batches: Iterable[pa.RecordBatch], known=known, margin=margin, kept=kept, names=names) -> Iterator[pa.RecordBatch]:
            apart = None
            for batch in batches:
                if not batch.num_rows:
                    continue
                apart = _distances(known.value) if apart is None else apart
                place, cells, home = (np.concatenate(x) for x in zip(*_visited(_of_sketches(batch, "float32"), known.value, margin, apart), strict=True))
                parts = np.minimum(batch.column("__m").to_numpy(), len(known.value))[place]
                blocks = (cells * parts // len(known.value)).astype(np.int32)
                starts = np.flatnonzero(np.diff(place, prepend=-1) | np.diff(blocks, prepend=-1))
                inner = pa.ListArray.from_arrays(pa.array([*starts, len(cells)], pa.int32()), pa.array(cells.astype(np.int16)))
                pairs = pa.StructArray.from_arrays([pa.array(blocks[starts]), inner], ["__b", "__w"])
                outer = pa.ListArray.from_arrays(pa.array(np.searchsorted(place[starts], np.arange(batch.num_rows + 1)), pa.int32()), pairs)
                new = [pa.array(cells[home].astype(np.int16)), pa.array(blocks[home]), outer]
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *new], names)

        found = found.union(own.select(*rows.columns, "__m").mapInArrow(assign, one.schema))
    return found


def _semantic_links(rows: DataFrame, least: float, block: int, cell: int, border: float | None) -> DataFrame:
    """(u, v, __l, __ku, __kv): edges between the sketches `rows`, connecting the pairs of a label at cosine `least`.

    Those with digests (__ku, __kv) are pairs that sketches cannot tell; the others are sure. A vector is written once,
    with the cells that it visits, and is sent once to each block of cells, to be compared with all that are at home
    in the cells that it visits or lives in. A block of too many vectors at home is cut, and so are too many guests:
    each of the parts at home meets each part of the guests and of the rest at home. Only a spanning forest leaves a job.
    """
    placed = written(_in_cells(rows, least, block, cell, border), "cells")
    wide = F.greatest(F.lit(1), F.least(F.lit(block), F.floor(F.lit(_CELL) / F.col("__d")))) * _LEAN
    sent = placed.select("*", F.inline("__v")).drop("__v").withColumn("__h", F.col("__b") == F.col("__o"))
    counts = sent.groupBy("__l", "__d", "__b").agg(F.count_if("__h").alias("home"), F.count_if(~F.col("__h")).alias("guests"))
    parts = counts.where("home > 0").withColumn("__n", F.ceil(F.col("home") / wide).cast("int"))
    guests = F.col("guests") + F.col("home") * (F.col("__n") - 1) / F.col("__n")
    parts = parts.withColumn("__g", F.greatest(F.lit(1), F.ceil(guests / (_GUESTS * wide))).cast("int")).where("__n > 1 or __g > 1")
    cut = sent.join(F.broadcast(parts.select("__l", "__d", "__b", "__n", "__g")), ["__l", "__d", "__b"], "left")
    hashed = lambda seed, n: F.pmod(F.xxhash64("__k", F.lit(seed)), F.coalesce(n, F.lit(1))).cast("int")
    own, turn = hashed(1, "__n"), hashed(3, "__g")
    every = lambda n: F.sequence(F.lit(0), F.coalesce(n, F.lit(1)) - 1)
    at_home = F.transform(F.filter(every("__g"), lambda p: F.col("__h")), lambda p: F.struct(F.col("__own").alias("__i"), p.alias("__p"), F.lit(True).alias("__h")))
    as_guest = F.transform(
        F.filter(every("__n"), lambda i: ~F.col("__h") | (i != F.col("__own"))), lambda i: F.struct(i.alias("__i"), F.col("__turn").alias("__p"), F.lit(False).alias("__h"))
    )
    jobs = cut.withColumns({"__own": own, "__turn": turn}).select("u", "__l", "__d", "__b", "__k", "__s", "__q", "__c", "__w", F.inline(F.concat(at_home, as_guest)))
    kinds = {"u": "u", "v": "u", "__l": "__l", "__ku": "__k", "__kv": "__k"}
    schema = StructType([StructField(n, rows.schema[k].dataType) for n, k in kinds.items()])

    def compare(job: pa.Table) -> pa.Table:
        job = job.combine_chunks()
        root, a, b = _compared(job, least)
        moved = np.flatnonzero(root != np.arange(len(root)))
        take = lambda name, at: job.column(name).take(pa.array(at))
        left, right = np.concatenate([moved, a]), np.concatenate([root[moved], b])
        doubt = pa.array(np.arange(len(left)) >= len(moved))
        keys = (pc.if_else(doubt, take("__k", x), pa.scalar(None, pa.binary())) for x in (left, right))
        return pa.table(dict(zip(kinds, [take("u", left), take("u", right), take("__l", left), *keys], strict=True)))

    return jobs.groupBy("__l", "__d", "__b", "__i", "__p").applyInArrow(compare, schema)


def _verified(doubts: DataFrame, rows: DataFrame, least: float) -> DataFrame:
    """(u, v): the `doubts` of `_semantic_links` whose exact vectors, made from `rows` (u, __l, __w) again, are at `least`."""
    asked_for = written(bits_of(doubts.select(F.explode(F.array("u", "v")).alias("u")).select(F.xxhash64("u").alias("key"))), "doubted")
    some = asked(rows, F.xxhash64("u"), asked_for).where("go")
    schema = StructType([*some.select("__l", _unit().alias("__u")).schema, StructField("__k", doubts.schema["__ku"].dataType)])

    def exact(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _sketches(batches):
            yield part.select(["__l", "__u", "__k"])

    known = some.select("__l", _unit().alias("__u")).mapInArrow(exact, schema)
    wanted = doubts.select("__l", F.explode(F.array("__ku", "__kv")).alias("__k")).distinct()
    known = written(known.join(wanted, ["__l", "__k"], "left_semi").groupBy("__l", "__k").agg(F.first("__u").alias("__u")), "doubted-vectors")
    left, right = (known.select("__l", F.col("__k").alias(f"__k{x}"), F.col("__u").alias(f"__{x}")) for x in "uv")
    dot = F.aggregate(F.zip_with("__u", "__v", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return doubts.join(left, ["__l", "__ku"]).join(right, ["__l", "__kv"]).where(dot >= least).select("u", "v")


def _unit() -> Column:
    """The vector __w at length one, null if it has no direction."""
    norm = F.sqrt(F.aggregate("__w", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    # Bound, as the norm would be made anew for every element.
    return bind(norm, lambda n: F.when((n > 0) & (n < float("inf")), F.transform("__w", lambda x: x.cast("double") / n)))


def dedup_semantic(
    vectors: DataFrame,
    key: str,
    vector: str,
    label: str,
    least: float,
    block: int = 1 << 14,
    cell: int = 1 << 13,
    border: float | None = None,
) -> DataFrame:
    """key and `cluster_id`, the lowest key reachable over pairs of a label at cosine `least` or more.

    A label of up to `cell` vectors is compared whole. A larger one is cut into cells around k-means
    centres: each vector lives in its nearest cell and visits those whose border it is close to, and is
    compared with all that live where it lives or visits. Two vectors at `least` are at most
    d = sqrt(2 - 2 least) apart, so that of two across a border one is within d / 2 of it: `border=0.5`
    finds every pair. By default it is 1.6 / sqrt(elements), at most 0.5, which misses a pair only if the
    border cuts it some three standard deviations off its usual slant. `border=0.5` or a `cell` beyond
    the largest label are the exact modes; no pair below `least` is ever linked.

    Vectors of one direction are one for that, so copies cost nothing. Vectors of no direction (zero,
    NaN, infinite or null elements), null keys or null labels, and different lengths link to none; repeated
    rows give repeated results; an empty table gives an empty table; other columns are never looked at.
    """
    rows = vectors.select(F.col(key).alias("u"), F.col(label).alias("__l"), F.col(vector).alias("__w")).where("u is not null and __l is not null")
    kept = StructType([rows.schema["u"], rows.schema["__l"], *_SKETCH])
    units = written(rows.select("u", "__l", _unit().alias("__u")).mapInArrow(_sketched, kept), "units")
    hashed = F.xxhash64("__l", "__k")
    twice = units.groupBy(hashed.alias("key")).agg(F.count("*").alias("n")).where("n > 1")
    told = asked(units, hashed, written(bits_of(twice), "repeated"))
    again = told.where("go").groupBy("__l", "__d", "__k").agg(F.min("u").alias("u"), F.first("__s").alias("__s"), F.first("__q").alias("__q"))
    again = written(again.select(units.columns), "directions")
    copies = told.where("go").select("u", "__l", "__k").join(again.select("__l", "__k", F.col("u").alias("v")), ["__l", "__k"]).where("u <> v")
    found = written(_semantic_links(told.where("not go").drop("go").select(units.columns).union(again), least, block, cell, border), "links")
    links = copies.select("u", "v").union(found.where("__ku is null").select("u", "v"))
    doubts = found.where("__ku is not null")
    if not doubts.isEmpty():
        links = links.union(_verified(doubts, rows, least))
    roots = components(links)
    return vectors.select(key).join(roots.withColumnRenamed("node", key), key, "left").select(
        key, F.coalesce("root", key).alias("cluster_id")
    )


def quality_classifier(
    docs: DataFrame,
    labels: DataFrame,
    target: str,
    features: int = 1 << 14,
    key: str = "doc_id",
    text: str = "text",
    folds: int = 4,
    held: int = 2,
) -> DataFrame:
    """key, `held_out` and `score` of all documents: logistic regression on hashed word counts.

    It learns from the labelled rows whose crc32(key as text) mod `folds` is not `held`; the others
    are held out, labelled or not. Rows without a label teach nothing; null texts have no words; a
    null key is scored and neither held out nor learned from. Other columns are never looked at.
    Without a labelled row to learn from there is no model and the fit fails.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF
    from pyspark.ml.functions import vector_to_array

    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    held_out = F.coalesce(F.crc32(F.col(key).cast("string")) % F.lit(folds) == F.lit(held), F.lit(False))
    rows = docs.select(key, held_out.alias("held_out"), words.alias("words"))
    counted = HashingTF(inputCol="words", outputCol="counts", numFeatures=features).transform(rows)
    known = counted.where(~F.col("held_out")).join(labels.select(key, F.col(target).cast("double").alias("label")), key)
    model = LogisticRegression(featuresCol="counts", maxIter=20, regParam=0.01).fit(known.where("label is not null").select("counts", "label"))
    return model.transform(counted).select(key, "held_out", vector_to_array("probability")[1].alias("score"))


def classifier_quality(scored: DataFrame, labels: DataFrame, target: str, key: str = "doc_id") -> DataFrame:
    """(held_out, documents, positives, auc) of the labelled rows of `quality_classifier`, by held_out.

    auc is the chance that a row of label 1 scores above one of label 0, equal scores counting half:
    exact, from counts per score and their running sums. It is null where a label is missing.
    Rows without a label or a score are left out; an empty table gives an empty table.
    """
    known = scored.join(labels.select(key, F.col(target).cast("int").alias("label")), key)
    known = known.where("label is not null and score is not null and held_out is not null")
    counts = written(
        known.groupBy("held_out", "score").agg(F.sum("label").alias("up"), F.sum(1 - F.col("label")).alias("down")), "score-counts"
    )
    placed = running(counts, by_value(counts, "score"), {"below": Running("sum", F.col("down"))}, ["held_out"])
    wins = F.sum(F.col("up") * (F.col("below") + F.col("down") / 2))
    found = placed.groupBy("held_out").agg(wins.alias("wins"), F.sum("up").alias("positives"), F.sum("down").alias("negatives"))
    return found.select(
        "held_out",
        (F.col("positives") + F.col("negatives")).alias("documents"),
        "positives",
        F.try_divide("wins", F.col("positives") * F.col("negatives")).alias("auc"),
    )


def sft_pairs(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", context: int = 4) -> DataFrame:
    """(conversation, turn, context, prompt, response): each user turn that an assistant turn follows.

    `context` is how many turns before the prompt are given along, oldest first.
    """
    along = W.partitionBy(conversation).orderBy(turn)
    before = F.collect_list(F.concat(F.col("role"), F.lit(": "), F.col("text"))).over(along.rowsBetween(-context, -1))
    named = turns.withColumns(
        {"__next": F.lead("role").over(along), "response": F.lead("text").over(along), "context": F.array_join(before, "\n")}
    )
    return named.where((F.col("role") == "user") & (F.col("__next") == "assistant")).select(
        conversation, turn, "context", F.col("text").alias("prompt"), "response"
    )


def preference_pairs(
    answers: DataFrame, margin: float, prompt: str = "prompt", answer: str = "answer", score: str = "score", reason: str | None = None
) -> DataFrame:
    """(prompt, chosen, rejected, margin): best and worst answer of a prompt at least `margin` apart.

    With `reason`, the column that says why an answer has its score, also chosen_reason and
    rejected_reason. Equal scores go to the lower answer text. Answers without a score (null or NaN)
    are no candidates; null prompts are one prompt; repeated rows change nothing; an empty table
    gives an empty table. One aggregation, combined before its shuffle.
    """
    why = F.col(reason) if reason else F.lit(None).cast("string")
    rated = answers.select(F.col(prompt).alias("p"), F.col(answer).alias("a"), F.col(score).alias("s"), why.alias("r"))
    rated = rated.where(F.col("s").isNotNull() & ~F.isnan(F.col("s").cast("double")))
    found = rated.groupBy("p").agg(
        F.min(F.struct((-F.col("s")).alias("s"), "a", "r")).alias("best"), F.min(F.struct("s", "a", "r")).alias("worst")
    )
    gap = -F.col("best.s") - F.col("worst.s")
    reasons = [F.col("best.r").alias("chosen_reason"), F.col("worst.r").alias("rejected_reason")] if reason else []
    return found.where((gap > 0) & (gap >= margin)).select(
        F.col("p").alias(prompt), F.col("best.a").alias("chosen"), F.col("worst.a").alias("rejected"), gap.alias("margin"), *reasons
    )


def save_pairs(pairs: DataFrame, path: str) -> None:
    """Preference pairs as JSON lines, one object for each pair; an earlier result at `path` is replaced."""
    pairs.write.mode("overwrite").json(path)
