"""Ranks by sampled ranges: percentiles with outliers, ranking metrics with crowded scores."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flightops.ml import explain
from flightops.operators import metrics, profile, ranks


def frame(spark, rows):
    return spark.createDataFrame(rows, "g string, x double, w long")


@pytest.fixture(scope="module")
def some(spark):
    rnd = random.Random(1)
    return [(rnd.choice(["a", "b", None]), float(rnd.randrange(50)), rnd.randrange(4)) for _ in range(400)]


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2]))


def test_positions_and_prefixes_equal_a_loop(spark, some):
    order = ranks.ranked(frame(spark, some), ["g"], [F.col("x").asc(), F.col("w").asc()], partitions=7)
    got = sorted((tuple(r) for r in order.with_position().collect()), key=lambda r: (r[0] is not None, r[0] or "", r[3]))
    count, want = {}, []
    for r in in_order(some):
        want.append((*r, count.get(r[0], 0)))
        count[r[0]] = count.get(r[0], 0) + 1
    assert got == want
    rows = order.exclusive_prefix(["w"], totals="all_").collect()
    for g in ("a", "b", None):
        mine = [r for r in in_order(some) if r[0] == g]
        before = [sum(r[2] for r in mine[:k]) for k in range(len(mine))]
        assert sorted((r["x"], r["w"], r["prior_w"]) for r in rows if r["g"] == g) == sorted((x, w, b) for (_, x, w), b in zip(mine, before))
        assert {r["all_w"] for r in rows if r["g"] == g} == {sum(r[2] for r in mine)}


def test_weighted_picks_equal_the_expanded_rows(spark):
    rows = [("a", float(k), k % 5 + 1) for k in range(60)] + [("b", 1.0, 1000)]
    order = ranks.ranked(frame(spark, rows), ["g"], [F.col("x").asc()], "w", partitions=9)
    flat = {g: [x for h, x, w in rows if h == g for _ in range(w)] for g in "ab"}
    wanted = [(g, k) for g in "ab" for k in (-1, 0, 3, len(flat[g]) // 2, len(flat[g]) - 1, len(flat[g]))]
    got = {(r["g"], r["_want"]): r["x"] for r in order.at(spark.createDataFrame(wanted, "g string, _want long")).collect()}
    assert got == {(g, k): flat[g][k] for g, k in wanted if 0 <= k < len(flat[g])}
    assert {r["g"]: r["_total"] for r in order.totals().collect()} == {g: len(v) for g, v in flat.items()}


def test_empty_and_all_equal(spark):
    order = ranks.ranked(frame(spark, []), ["g"], [F.col("x").asc()])
    assert order.with_position().count() == 0 and order.totals().count() == 0
    equal = ranks.ranked(frame(spark, [("a", 1.0, 1)] * 50), ["g"], [F.col("x").asc()], partitions=4)
    assert sorted(r["_pos"] for r in equal.with_position().collect()) == list(range(50))


def range_sizes(monkeypatch, run):
    """Rows of every range of the ranks that `run` makes."""
    seen = []
    made = ranks.ranked
    monkeypatch.setattr(ranks, "ranked", lambda *a, **k: seen.append(made(*a, **(k | {"partitions": 16}))) or seen[-1])
    out = run()
    return out, [r["count"] for r in seen[0].rows.groupBy("_range").count().collect()]


def test_percentiles_with_an_outlier(spark, monkeypatch):
    n = 50_000
    df = spark.range(n).select(F.lit("c").alias("k"), F.when(F.col("id") == 7, 1e12).otherwise(F.col("id") * 0.5).alias("v"))
    x = np.where(np.arange(n) == 7, 1e12, np.arange(n) * 0.5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.999, 1.0]
    q, sizes = range_sizes(monkeypatch, lambda: profile.quantiles(df, ["k"], probs).first()["q"])
    assert np.allclose(q, np.percentile(x, [100 * p for p in probs]))
    assert len(sizes) > 8 and max(sizes) < n / 4  # one value far away leaves the others spread


def test_percentiles_of_small_groups_and_ties(spark):
    groups = {"a": [1.0], "b": [2.0, 4.0], "c": [5.0] * 7 + [9.0], None: [1.0, 2.0, 3.0]}
    df = spark.createDataFrame([(g, x) for g, v in groups.items() for x in [*v, None]], "k string, v double")
    got = {r["k"]: r["q"] for r in profile.quantiles(df, ["k"], [0.25, 0.5, 0.9]).collect()}
    assert got.keys() == groups.keys()
    for g, v in groups.items():
        assert np.allclose(got[g], np.percentile(v, [25, 50, 90]))


def test_ranking_metrics_of_crowded_scores(spark, monkeypatch):
    n = 40_000
    df = spark.range(n).select(((F.col("id") % 7) < 2).cast("int").alias("y"), (0.301 + F.col("id") * 0.001 / n + (F.col("id") % 7 < 2).cast("int") * 2.000125e-4).alias("p"))
    got, sizes = range_sizes(monkeypatch, lambda: metrics.ranking_metrics(df, rounded=False).first())
    assert len(sizes) > 8 and max(sizes) < n / 4
    rows = df.toPandas().sort_values("p", ascending=False)
    y = rows["y"].to_numpy()
    tp = np.cumsum(y)
    assert got["pr_auc"] == pytest.approx((tp / np.arange(1, n + 1))[y == 1].mean(), abs=1e-9)
    below = np.cumsum((1 - y)[::-1])[::-1]
    assert got["roc_auc"] == pytest.approx(below[y == 1].mean() / (1 - y).sum(), abs=1e-9)


def test_ranking_metrics_by_group_and_single_classes(spark):
    df = spark.createDataFrame([("m", 1, 0.9), ("m", 0, 0.9), ("m", 1, 0.2), ("one", 1, 0.5), (None, 0, 0.1)], "g string, y int, p double")
    got = {r["g"]: (r["roc_auc"], r["pr_auc"]) for r in metrics.ranking_metrics(df, groups=["g"]).collect()}
    assert got == {"m": (0.25, 0.5833), "one": (0.5, 1.0), None: (0.5, 0.0)}


def test_hash_ranks_are_a_permutation(spark):
    got = explain.hash_rank(spark.range(3000).withColumnRenamed("id", "k"), ["k"], 3).collect()
    assert sorted(r["rank"] for r in got) == list(range(3000))
    assert [r["k"] for r in sorted(got, key=lambda r: r["rank"])] != list(range(3000))
