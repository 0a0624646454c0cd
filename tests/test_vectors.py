import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqloom.functions.vectors import softmax, top_k
from seqloom.operators import vectors


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(1)
    rows = [(i, "hot" if i % 3 else f"g{i % 4}", [rng.gauss(0, 2) for _ in range(6)]) for i in range(60)]
    return spark.createDataFrame(rows, "id long, grp string, v array<double>"), rows


def norms(rows):
    out = {}
    for _, group, v in rows:
        out.setdefault(group, []).extend(v)
    return {group: float(np.linalg.norm(v)) for group, v in out.items()}


def test_norms(table):
    df, rows = table
    found = {r["grp"]: r["norm"] for r in vectors.l2_norm(df, "v", ["grp"]).collect()}
    assert found == pytest.approx(norms(rows))
    whole = vectors.l2_norm(df, "v").first()["norm"]
    assert whole == pytest.approx(math.sqrt(sum(n * n for n in norms(rows).values())))


@pytest.mark.parametrize("most", [0.5, 20.0, 1e6])
def test_clipping(table, most):
    df, rows = table
    clipped = vectors.clip_to_norm(df, "v", "grp", most).collect()
    before = norms(rows)
    after = norms([(r["id"], r["grp"], r["v"]) for r in clipped])
    for group, norm in before.items():
        assert after[group] == pytest.approx(norm * min(1.0, most / (norm + 1e-6)))
        assert after[group] <= most
    with pytest.raises(ValueError):
        vectors.clip_to_norm(df, "v", "grp", 0)


def test_histogram_counts_everything(table):
    df, rows = table
    found = vectors.value_histogram(df, "grp", "v", 5).collect()
    for group in {g for _, g, _ in rows}:
        values = [x for _, g, v in rows if g == group for x in v]
        counts, edges = np.histogram(values, 5)
        mine = {r["bin"]: r for r in found if r["grp"] == group}
        assert [mine[b]["count"] if b in mine else 0 for b in range(5)] == list(counts)
        for b, r in mine.items():
            assert (r["bin_low"], r["bin_high"]) == pytest.approx((edges[b], edges[b + 1]))


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([("a", [2.0, 2.0])], "n string, v array<double>")
    assert tuple(vectors.value_histogram(df, "n", "v", 4).first()) == ("a", 0, 2.0, 2.0, 2)


def test_softmax_and_top_k(spark):
    df = spark.createDataFrame([([1000.0, 1001.0, 999.0, 1001.0],)], "x array<double>")
    row = df.select(softmax(F.col("x")).alias("p"), top_k(F.col("x"), 3).alias("k")).first()
    e = np.exp(np.array([-1.0, 0, -2, 0]))
    assert row["p"] == pytest.approx(list(e / e.sum()))
    assert [(s["index"], s["score"]) for s in row["k"]] == [(1, 1001.0), (3, 1001.0), (0, 1000.0)]


@pytest.mark.parametrize("k", [1, 2, 6])
def test_routing_and_balance(table, k):
    df, rows = table
    routed = vectors.topk_routing(df, F.col("v"), k)
    p = np.array([np.exp(v) / np.exp(v).sum() for _, _, v in rows])
    chosen = np.argsort(-p, axis=1, kind="stable")[:, :k]
    for r in routed.collect():
        best = chosen[r["id"]]
        assert [x["expert"] for x in r["routes"]] == list(best)
        weights = p[r["id"]][best] / p[r["id"]][best].sum()
        assert [x["weight"] for x in r["routes"]] == pytest.approx(list(weights))
    load = np.array([(chosen == e).sum() for e in range(6)]) / chosen.size
    found = sorted(vectors.expert_load_balance(routed).collect(), key=lambda r: r["expert"])
    assert [r["load"] for r in found] == pytest.approx(list(load))
    assert found[0]["balance_score"] == pytest.approx(6 * (load * p.mean(axis=0)).sum())


def test_routing_bounds(table):
    df, _ = table
    with pytest.raises(ValueError):
        vectors.topk_routing(df, F.col("v"), 0)
    with pytest.raises(Exception, match="number of experts"):
        vectors.topk_routing(df, F.col("v"), 7).collect()


def candidates(spark, logits, groups=300):
    rows = [(g, c, float(x)) for g in range(groups) for c, x in enumerate(logits)]
    return spark.createDataFrame(rows, "g long, c long, x double")


def picks(df, *options, **named):
    return {r["g"]: r["c"] for r in vectors.weighted_pick(df, "g", "c", "x", *options, **named).collect()}


def test_greedy_takes_the_largest_and_the_lower_of_ties(spark):
    assert set(picks(candidates(spark, [1, 3, 3, 2], 5), 0.0).values()) == {1}


def test_draws_follow_the_softmax(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BUCKET_WIDTH", 2)  # many slices
    logits = np.array([0.0, 1.0, 2.0, -1.0])
    df = candidates(spark, logits, 2000)
    for temperature, top in ((1.0, 0), (0.5, 0), (2.0, 2)):
        found = picks(df, temperature, top, seed=7)
        assert len(found) == 2000
        p = np.exp(logits / temperature)
        if top:
            p[np.argsort(-logits)[top:]] = 0
        p /= p.sum()
        share = Counter(found.values())
        for c in range(4):
            assert share[c] / 2000 == pytest.approx(p[c], abs=0.035)
    assert picks(df, 1.0, seed=7) == picks(df.repartition(3), 1.0, seed=7) != picks(df, 1.0, seed=8)


def test_pick_bounds(spark):
    df = candidates(spark, [1, 2], 1)
    with pytest.raises(ValueError, match="temperature"):
        vectors.weighted_pick(df, "g", "c", "x", -1.0)
    assert picks(df, 1.0, 50) == picks(df, 1.0)


def test_cuts(spark):
    df = spark.createDataFrame([(1, [5, 6, 0, 7, 0]), (2, [8])], "k long, ids array<int>")

    def ids(cut, column="ids"):
        return [r[column] for r in cut.orderBy("k").collect()]

    assert ids(vectors.context_cut(df, "ids", 2)) == [[7, 0], [8]]
    assert ids(vectors.context_cut(df, "ids", 9)) == [[5, 6, 0, 7, 0], [8]]
    assert ids(vectors.end_cut(df, "ids", 0)) == [[5, 6, 0], [8]]
    assert ids(vectors.end_cut(df, "ids", 0, start=3)) == [[5, 6, 0, 7, 0], [8]]
    split = vectors.prompt_split(df, "ids", 2)
    assert ids(split, "prompt_ids") == [[5, 6], [8]]
    assert ids(split, "continuation_ids") == [[0, 7, 0], []]


def test_a_histogram_keeps_odd_values_apart(spark):
    values = [float("nan"), 1.0, 3.0, None, float("inf"), float("-inf"), 2.0, float("nan")]
    df = spark.createDataFrame([("a", values), ("b", [float("nan")]), (None, [5.0])], "name string, v array<double>")
    got = {(r.name, r.bin, str(r.bin_low)): (str(r.bin_high), r["count"]) for r in vectors.value_histogram(df, "name", "v", 2).collect()}
    assert got == {
        ("a", 0, "1.0"): ("2.0", 1),
        ("a", 1, "2.0"): ("3.0", 2),
        ("a", None, "nan"): ("nan", 2),
        ("a", None, "inf"): ("inf", 1),
        ("a", None, "-inf"): ("-inf", 1),
        ("b", None, "nan"): ("nan", 1),
        (None, 0, "5.0"): ("5.0", 1),
    }


@pytest.mark.parametrize("temperature,top", [(0.0, 0), (0.7, 0), (0.7, 2)])
def test_a_null_group_is_picked_from(spark, temperature, top):
    rows = [(g, c, float(c % 3)) for g in ("a", None) for c in range(6)]
    df = spark.createDataFrame(rows, "g string, c long, x double")
    got = vectors.weighted_pick(df, "g", "c", "x", temperature, top).collect()
    assert {r.g for r in got} == {"a", None}


def test_context_cut_joins_only_repeated_keys(spark, tmp_path):
    from seqloom.plans import vector_queries

    rows = [(1, "ab" * 200), (3, "cd"), (2, " ")]
    for name, more in (("once", []), ("twice", [(3, "efg"), (None, "x")])):
        docs = spark.createDataFrame(rows + more, "doc_id long, text string")
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        cut = vector_queries.context_cut(spark, f"{tmp_path}/{name}")
        assert ("Join" in cut._jdf.queryExecution().executedPlan().toString()) == bool(more)
        found = sorted((r.doc_id, len(r.recent_ids.split()), len(r.prompt_ids.split())) for r in cut.collect())
        assert found == [(1, 128, 16), *([(3, 3, 3), (3, 3, 4), (3, 4, 3), (3, 4, 4)] if more else [(3, 3, 3)])]
