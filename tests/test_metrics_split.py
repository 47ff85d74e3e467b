"""Metrics against brute force, chronological split invariants."""

import random

import pytest
from pyspark.sql import functions as F

from flightops.operators import metrics, split


def _brute_auc(y, p):
    pos = [s for s, t in zip(p, y) if t == 1]
    neg = [s for s, t in zip(p, y) if t == 0]
    if not pos or not neg:
        return 0.5
    tot = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return tot / (len(pos) * len(neg))


def _brute_ap(y, p):
    P = sum(y)
    if P == 0 or P == len(y):
        return P / len(y)
    ap, prev_r = 0.0, 0.0
    for s in sorted(set(p), reverse=True):
        tp = sum(1 for a, t in zip(p, y) if a >= s and t == 1)
        n = sum(1 for a in p if a >= s)
        r = tp / P
        ap += (r - prev_r) * tp / n
        prev_r = r
    return ap


def test_perfect_ranking(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.6), (1, 0.8)], "y int, p double")
    e = metrics.evaluate(df).first()
    assert (e["accuracy"], e["precision"], e["recall"], e["f1"], e["roc_auc"], e["pr_auc"]) == (1.0,) * 6


def test_confusion_case(spark):
    y = [1, 1, 1, 0, 0, 0, 0, 0]
    p = [0.9, 0.8, 0.7, 0.6, 0.4, 0.3, 0.2, 0.1]
    df = spark.createDataFrame(list(zip(y, p)), "y int, p double")
    c = metrics.class_metrics(df, threshold=0.5).first()
    assert (c["tp"], c["tn"], c["fp"], c["fn"]) == (3, 4, 1, 0)
    assert c["precision"] == 0.75 and c["recall"] == 1.0 and c["f1"] == round(2 * .75 / 1.75, 4)
    assert c["balanced_accuracy"] == 0.9


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ranking_metrics_vs_brute_force_with_ties(spark, seed):
    rnd = random.Random(seed)
    y = [rnd.randint(0, 1) for _ in range(300)]
    p = [rnd.choice([0.1, 0.2, 0.25, 0.5, 0.5001, 0.75, 0.9]) for _ in range(300)]
    df = spark.createDataFrame(list(zip(y, p)), "y int, p double")
    for blocks in (1, 3, 4096):
        auc = metrics.roc_auc(df, blocks=blocks).first()["roc_auc"]
        ap = metrics.average_precision(df, blocks=blocks).first()["pr_auc"]
        assert auc == pytest.approx(round(_brute_auc(y, p), 4), abs=1e-4)
        assert ap == pytest.approx(round(_brute_ap(y, p), 4), abs=1e-4)


def test_single_class_guards(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.6)], "y int, p double")
    e = metrics.evaluate(df).first()
    assert e["roc_auc"] == 0.5 and e["pr_auc"] == 1.0


def test_threshold_sweep_and_best(spark):
    df = spark.createDataFrame([(0, 0.35), (1, 0.45), (1, 0.65), (0, 0.2)], "y int, p double")
    sw = {r["threshold"]: r["f1"] for r in metrics.threshold_sweep(df).collect()}
    assert sw[0.3] == 0.8 and sw[0.4] == 1.0 and sw[0.7] == 0.0
    best = metrics.best_threshold(metrics.threshold_sweep(df)).first()
    assert best["best_threshold"] == 0.4


def test_calibration_edges(spark):
    df = spark.createDataFrame([(0, 0.2), (1, 0.2000001), (1, 0.6), (0, 1.0)], "y int, p double")
    bins = {r["bin"]: r["n"] for r in metrics.calibration(df).collect()}
    assert bins == {0: 1, 1: 1, 2: 1, 4: 1}


def _split_fixture(spark, n=1000, slots=7):
    rows = [(i, f"2024-01-{1 + (i * 7919) % slots:02d}", 800 + (i % 3) * 100, i % 2) for i in range(n)]
    return spark.createDataFrame(rows, "flight_id long, flight_date string, scheduled_dep_time int, delay_target int")


@pytest.mark.parametrize("buckets", [1, 8, 64])
def test_split_matches_sorted_positions(spark, buckets):
    df = _split_fixture(spark)
    out = split.chronological_split(df, slot_keys=buckets).collect()
    order = sorted(out, key=lambda r: (r["flight_date"], r["scheduled_dep_time"], r["flight_id"]))
    n_train, n_val = int(1000 * 0.7), int(1000 * 0.15)
    expect = ["train"] * n_train + ["val"] * n_val + ["test"] * (1000 - n_train - n_val)
    assert [r["split"] for r in order] == expect


def test_split_rejects_bad_input(spark):
    df = _split_fixture(spark, n=2)
    with pytest.raises(ValueError):
        split.chronological_split(df)
    with pytest.raises(ValueError):
        split.chronological_split(_split_fixture(spark), train_pct=0.9, val_pct=0.2)


def test_split_summary(spark):
    s = {r["split"]: r for r in split.split_summary(split.chronological_split(_split_fixture(spark))).collect()}
    assert s["train"]["records"] == 700 and s["test"]["records"] == 150 and s["val"]["pct"] == 15.0


def test_metric_deltas(spark):
    m = spark.createDataFrame([("a", "s", 0.5, 0.0), ("b", "s", 0.6, 0.1)], "exp string, k string, f1 double, acc double")
    d = {r["metric"]: r for r in metrics.metric_deltas(m, ["k"], "exp", "a", "b", ["f1", "acc"]).collect()}
    assert d["f1"]["abs_delta"] == 0.1 and d["f1"]["pct_delta"] == 20.0 and d["acc"]["pct_delta"] == 100.0


def test_column_summary_counts_a_twin_once_and_only_a_true_one(spark):
    from flightops.operators import profile
    df = spark.createDataFrame([(1, 1, 1, 0.0, -0.0, "a", None), (2, 2, 2, 1.5, 1.5, None, None), (None, None, 2, 1.5, 1.5, "a", None), (2, 2, 2, None, None, "b", None)],
                               "a int, same int, near int, f double, minus double, s string, empty string")
    plain = sorted(map(tuple, profile.column_summary(df).collect()))
    out = profile.column_summary(df, twins={"same": "a", "near": "a", "minus": "f", "empty": "s", "s": "gone"})
    assert sorted(map(tuple, out.collect())) == plain
    assert {r["column_name"]: r["unique_values"] for r in out.collect()} == {"a": 2, "same": 2, "near": 2, "f": 2, "minus": 2, "s": 2, "empty": 0}
    assert profile._confirmed(df, {"same": "a", "near": "a", "minus": "f", "empty": "s"}) == {"same": "a"}
