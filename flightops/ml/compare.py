"""Operating points frozen on validation, the evaluation matrix, and experiments over two feature sets.

Scores come as one long table (model, split, y, p): every model and split is judged by the same few grouped jobs,
whatever their number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import metrics

#: What experiments compare.
METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc", "brier_score"]


def frozen_thresholds(long: DataFrame, thresholds: list[float] | None = None, split: str = "val") -> DataFrame:
    """(model, best_threshold, best_f1): each model's candidate of the highest F1 on `split`, the lowest of equals."""
    sweep = metrics.threshold_sweep(long.filter(F.col("split") == split), thresholds=thresholds, groups=["model"])
    return metrics.best_threshold(sweep, groups=["model"])


def evaluation_matrix(long: DataFrame, frozen: DataFrame | None = None) -> DataFrame:
    """One row per model, split and operating point (`0.50` and `tuned`, the frozen threshold)."""
    frozen = frozen_thresholds(long) if frozen is None else frozen
    points = frozen.select("model", F.explode(F.array(
        F.struct(F.lit("0.50").alias("operating_point"), F.lit(0.5).alias("threshold")),
        F.struct(F.lit("tuned").alias("operating_point"), F.col("best_threshold").cast("double").alias("threshold")))).alias("at"))
    points = points.select("model", "at.*")  # two rows a model
    each = metrics.class_metrics(long.join(F.broadcast(points), "model"), threshold="threshold",
                                 groups=["model", "split", "operating_point", "threshold"])
    return each.join(metrics.ranking_metrics(long, groups=["model", "split"]), ["model", "split"])


def transfer_split(labelled: DataFrame, other: DataFrame, key: list[str]) -> DataFrame:
    """Rows of `other` whose key is in `labelled`, with that table's `split`: both sets hold the same rows in the same parts."""
    return other.drop("split").join(labelled.select(*key, "split"), key)


def experiment(base: DataFrame, new: DataFrame, split: str = "test") -> DataFrame:
    """Every model of two evaluation matrices at its own frozen threshold on `split`, metric by metric.

    abs_delta is rounded to 4 digits, pct_delta to 2; a zero base gives 0 if the new value is zero too, else 100.
    """
    def long(matrix: DataFrame, value: str, threshold: str) -> DataFrame:
        rows = matrix.filter((F.col("split") == split) & (F.col("operating_point") == "tuned"))
        return rows.unpivot(["model", "threshold"], METRICS, "metric", value).withColumnRenamed("threshold", threshold)

    j = long(base, "base_value", "base_threshold").join(long(new, "new_value", "new_threshold"), ["model", "metric"])
    d, zero = F.col("new_value") - F.col("base_value"), F.lit(1e-6)
    pct = F.when(F.abs("base_value") > zero, d / F.col("base_value") * 100).otherwise(F.when(F.abs("new_value") < zero, 0.0).otherwise(100.0))
    return j.withColumns({"abs_delta": metrics._r4(d), "pct_delta": metrics.S.round_half_even(pct, 2) + F.lit(0.0)})
