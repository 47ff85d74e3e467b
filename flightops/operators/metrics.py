"""Exact binary-classification metrics as distributed aggregations.

Inputs are (label, score) rows plus optional group columns (model, split,
...), so every (model, split) pair is evaluated in one job. Ranking metrics
pre-aggregate to one row per distinct score and take the prefix over one order
of (groups, score) in ranges of sampled bounds (``ranks.ranked``), for all
models and splits at once: scores that crowd into a narrow stretch make more
ranges there, and no single task sorts a whole evaluation set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S

from .. import config
from ..functions.scalar import col
from . import prefix as P
from . import ranks as R


def _r4(c: Column) -> Column:
    return S.round_half_even(c, 4)


def _safe_div(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion(df: DataFrame, label: str = "y", score: str = "p", threshold: float = 0.5,
              groups: list[str] | None = None) -> DataFrame:
    groups = groups or []
    y, pred = col(label).cast("int"), (col(score) >= threshold).cast("int")
    return df.groupBy(*groups).agg(
        F.count_if((y == 0) & (pred == 0)).cast("long").alias("tn"),
        F.count_if((y == 0) & (pred == 1)).cast("long").alias("fp"),
        F.count_if((y == 1) & (pred == 0)).cast("long").alias("fn"),
        F.count_if((y == 1) & (pred == 1)).cast("long").alias("tp"))


def rates_from_counts(df: DataFrame) -> DataFrame:
    """accuracy, precision, recall, f1 and balanced accuracy from tn/fp/fn/tp."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    prec, rec = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn)
    spec = _safe_div(tn, tn + fp)
    f1 = _safe_div(2 * tp, 2 * tp + fp + fn)
    return df.withColumns({"accuracy": _r4(_safe_div(tp + tn, n)), "precision": _r4(prec),
                           "recall": _r4(rec), "f1": _r4(f1),
                           "balanced_accuracy": _r4((rec + spec) / 2)})


def class_metrics(df: DataFrame, label: str = "y", score: str = "p", threshold: float | str = 0.5,
                  groups: list[str] | None = None) -> DataFrame:
    """Counts, rates and Brier score per group; ``threshold`` is a number or the name of a group column."""
    groups = groups or []
    y, p = col(label).cast("double"), col(score).cast("double")
    pred = (p >= (F.col(threshold) if isinstance(threshold, str) else threshold)).cast("int")
    yi = col(label).cast("int")
    agg = df.groupBy(*groups).agg(
        F.count(F.lit(1)).cast("long").alias("n_samples"),
        F.sum(yi).cast("long").alias("n_positive"),
        F.count_if((yi == 0) & (pred == 0)).cast("long").alias("tn"),
        F.count_if((yi == 0) & (pred == 1)).cast("long").alias("fp"),
        F.count_if((yi == 1) & (pred == 0)).cast("long").alias("fn"),
        F.count_if((yi == 1) & (pred == 1)).cast("long").alias("tp"),
        F.avg((p - y) * (p - y)).alias("_brier"))
    out = rates_from_counts(agg).withColumn("brier_score", _r4(F.col("_brier"))).drop("_brier")
    return out if isinstance(threshold, str) else out.withColumn("threshold", F.lit(float(threshold)))


def score_table(df: DataFrame, label: str, score: str, groups: list[str]) -> DataFrame:
    """One row per (groups, distinct score) with positive/negative counts."""
    yi = col(label).cast("int")
    return df.groupBy(*groups, col(score).cast("double").alias("s")).agg(
        F.count_if(yi == 1).cast("long").alias("pos"), F.count_if(yi != 1).cast("long").alias("neg"))


def _with_prefix(st: DataFrame, groups: list[str], blocks: int | None) -> DataFrame:
    """Adds lt_pos / lt_neg = counts with a strictly smaller score, and the group totals P and N."""
    keys = groups or ["_whole"]
    st = st if groups else st.withColumn("_whole", F.lit(0))
    order = R.ranked(st, keys, [F.col("s").asc_nulls_first()], name="scores", partitions=blocks)
    out = order.exclusive_prefix(["pos", "neg"], prefix="lt_", totals="_all_")
    out = out.withColumnsRenamed({"_all_pos": "P", "_all_neg": "N"})
    return out if groups else out.drop("_whole")


def _roc(pre: DataFrame):
    """Aggregates and value of the Mann-Whitney AUC over rows of ``_with_prefix``."""
    u = F.sum(F.col("pos") * (F.col("lt_neg") + 0.5 * F.col("neg"))).alias("_u")
    value = F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("_u") / (F.col("P") * F.col("N"))).otherwise(0.5)
    return u, value


def _ap(pre: DataFrame):
    """Aggregates and value of the step-wise average precision over rows of ``_with_prefix``."""
    tp_ge = F.col("P") - F.col("lt_pos")
    n_ge = F.col("P") + F.col("N") - F.col("lt_pos") - F.col("lt_neg")
    steps = F.sum(F.when(F.col("pos") > 0, F.col("pos") / F.col("P") * tp_ge / n_ge).otherwise(0.0)).alias("_ap")
    value = F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("_ap")).otherwise(
        F.col("P") / F.greatest(F.col("P") + F.col("N"), F.lit(1)))
    return steps, value


def ranking_metrics(df: DataFrame, label: str = "y", score: str = "p", groups: list[str] | None = None,
                    blocks: int | None = None, rounded: bool = True) -> DataFrame:
    """``roc_auc`` and ``pr_auc`` of each group from one prefix over its scores."""
    groups = groups or []
    pre = _with_prefix(score_table(df, label, score, groups), groups, blocks)
    (u, auc), (steps, ap) = _roc(pre), _ap(pre)
    agg = pre.groupBy(*groups).agg(u, steps, F.first("P").alias("P"), F.first("N").alias("N"))
    return agg.select(*groups, (_r4(auc) if rounded else auc).alias("roc_auc"), (_r4(ap) if rounded else ap).alias("pr_auc"))


def roc_auc(df: DataFrame, label: str = "y", score: str = "p", groups: list[str] | None = None,
            blocks: int | None = None) -> DataFrame:
    """Mann-Whitney AUC with tied scores counted one half; one class -> 0.5."""
    return ranking_metrics(df, label, score, groups, blocks).drop("pr_auc")


def average_precision(df: DataFrame, label: str = "y", score: str = "p", groups: list[str] | None = None,
                      blocks: int | None = None, rounded: bool = True) -> DataFrame:
    """Step-wise AP: sum over distinct scores of (recall step) x precision at
    that score; one class -> positive share."""
    return ranking_metrics(df, label, score, groups, blocks, rounded).drop("roc_auc")


def curve_points(df: DataFrame, label: str = "y", score: str = "p", groups: list[str] | None = None,
                 blocks: int | None = None) -> DataFrame:
    """ROC and PR points at every distinct score used as threshold (p >= s)."""
    groups = groups or []
    pre = _with_prefix(score_table(df, label, score, groups), groups, blocks)
    tp = F.col("P") - F.col("lt_pos")
    fp = F.col("N") - F.col("lt_neg")
    return pre.select(*groups, F.col("s").alias("threshold"),
                      _r4(_safe_div(fp, F.col("N"))).alias("fpr"), _r4(_safe_div(tp, F.col("P"))).alias("tpr"),
                      _r4(F.coalesce(F.try_divide(tp.cast("double"), tp + fp), F.lit(1.0))).alias("precision"),
                      _r4(_safe_div(tp, F.col("P"))).alias("recall"))


def evaluate(df: DataFrame, label: str = "y", score: str = "p", threshold: float = 0.5,
             groups: list[str] | None = None, blocks: int | None = None) -> DataFrame:
    """Full metric record per group."""
    groups = groups or []
    cm = class_metrics(df, label, score, threshold, groups)
    return P.null_safe_join(cm, ranking_metrics(df, label, score, groups, blocks), groups)


def threshold_sweep(df: DataFrame, label: str = "y", score: str = "p",
                    thresholds: list[float] | None = None, groups: list[str] | None = None) -> DataFrame:
    """Metrics at each threshold in one pass (one count_if per cell), long form."""
    thresholds = list(thresholds or config.CANDIDATE_THRESHOLDS)
    groups = groups or []
    yi, p = col(label).cast("int"), col(score).cast("double")
    aggs = []
    for i, t in enumerate(thresholds):
        pred = p >= t
        aggs += [F.count_if((yi == 0) & ~pred).cast("long").alias(f"tn_{i}"),
                 F.count_if((yi == 0) & pred).cast("long").alias(f"fp_{i}"),
                 F.count_if((yi == 1) & ~pred).cast("long").alias(f"fn_{i}"),
                 F.count_if((yi == 1) & pred).cast("long").alias(f"tp_{i}")]
    wide = df.groupBy(*groups).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(float(t)).alias("threshold"), *[F.col(f"{m}_{i}").alias(m)
                                                               for m in ("tn", "fp", "fn", "tp")])
                     for i, t in enumerate(thresholds)])
    long = wide.select(*groups, F.explode(rows).alias("r")).select(*groups, "r.*")
    return rates_from_counts(long)


def best_threshold(sweep: DataFrame, groups: list[str] | None = None, metric: str = "f1",
                   rounded: bool = True) -> DataFrame:
    """Highest ``metric``; the first (lowest) threshold wins ties. With
    ``rounded=False`` F1 is compared unrounded (recomputed from the counts)."""
    groups = groups or []
    m = F.col(metric)
    if not rounded and metric == "f1":
        m = _safe_div(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    best = sweep.groupBy(*groups).agg(F.max_by(F.col("threshold"), F.struct(m, -F.col("threshold")))
                                      .alias("best_threshold"),
                                      F.max(metric).alias(f"best_{metric}"))
    return best


def calibration(df: DataFrame, label: str = "y", score: str = "p", groups: list[str] | None = None) -> DataFrame:
    """Five uniform bins; a score equal to an edge falls in the lower bin;
    empty bins are absent."""
    groups = groups or []
    p = col(score).cast("double")
    e = config.CALIBRATION_EDGES
    b = (F.when(p <= e[0], 0).when(p <= e[1], 1).when(p <= e[2], 2).when(p <= e[3], 3).otherwise(4))
    return (df.groupBy(*groups, b.alias("bin")).agg(
        F.count(F.lit(1)).cast("long").alias("n"),
        _r4(F.avg(col(label).cast("double"))).alias("fraction_of_positives"),
        _r4(F.avg(p)).alias("mean_predicted_value")))


def metric_deltas(metrics: DataFrame, key: list[str], experiment_col: str, base: str, other: str,
                  metric_cols: list[str]) -> DataFrame:
    """Absolute (4 dp) and relative (% , 2 dp) change from ``base`` to
    ``other``; zero base -> 0 when unchanged else 100."""
    long = metrics.unpivot([*key, experiment_col], metric_cols, "metric", "value")
    a = long.filter(F.col(experiment_col) == base).drop(experiment_col).withColumnRenamed("value", "base_value")
    b = long.filter(F.col(experiment_col) == other).drop(experiment_col).withColumnRenamed("value", "new_value")
    j = a.join(b, on=[*key, "metric"], how="inner")
    d = F.col("new_value") - F.col("base_value")
    pct = F.when(F.col("base_value") != 0, d / F.abs(F.col("base_value")) * 100).otherwise(
        F.when(d == 0, 0.0).otherwise(100.0))
    return j.withColumns({"abs_delta": _r4(d), "pct_delta": S.round_half_even(pct, 2) + F.lit(0.0)})


def baseline_deltas(metrics: DataFrame, model_col: str, baseline: str, metric_cols: list[str]) -> DataFrame:
    """Every model against the baseline row; % uses max(|base|, 1e-6)."""
    long = metrics.unpivot([model_col], metric_cols, "metric", "value")
    base = long.filter(F.col(model_col) == baseline).select("metric", F.col("value").alias("base_value"))
    j = long.filter(F.col(model_col) != baseline).join(F.broadcast(base), "metric")
    d = F.col("value") - F.col("base_value")
    return j.withColumns({"abs_delta": _r4(d),
                          "pct_delta": S.round_half_even(d / F.greatest(F.abs(F.col("base_value")), F.lit(1e-6)) * 100, 2)
                          + F.lit(0.0)})


def comparison_table(evaluation: DataFrame, model_col: str = "model", split_col: str = "split",
                     metric_cols: list[str] | None = None) -> DataFrame:
    """One row per model, one column per (split, metric)."""
    metric_cols = metric_cols or ["accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc", "brier_score"]
    long = evaluation.unpivot([model_col, split_col], metric_cols, "metric", "value")
    return (long.withColumn("k", F.concat_ws("_", F.col(split_col), F.col("metric")))
            .groupBy(model_col).pivot("k").agg(F.first("value")))
