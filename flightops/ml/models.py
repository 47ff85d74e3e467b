"""Delay classifiers on Spark ML with class-balanced sample weights.

* logistic regression: L2 with sklearn's C mapped to
  ``regParam = 1 / (C * sum(weights))`` (same objective up to a constant),
  no internal standardisation (the preprocessor scales);
* random forest: ``numTrees``, ``maxDepth``, sqrt feature subsets, seed;
* gradient-boosted trees: same family as the boosting library used before,
  not the same algorithm -- no numeric parity is claimed.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce
from heapq import heapreplace
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import SparkContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType

from .. import config
from ..config import DEFAULT, Settings
from ..functions import scalar as S
from ..functions.scalar import col
from ..session import checkpoint_dir, forget_at_exit, stage_table
from .prep import Preprocessor

PROB = "delay_probability"
#: Training rows of a written file at most; of a core at least, before rows are dealt. Estimators keep about 1 kB a row.
FILE_ROWS, TASK_ROWS = 300_000, 20_000
#: Training rows that fits running side by side hold together.
SIDE_ROWS = 4_000_000


def class_weights(train: DataFrame, target: str = "delay_target") -> tuple[float, float, int, int]:
    """Balanced weights n / (2 n_class) for classes 0 and 1, plus the counts."""
    r = train.agg(F.count_if(col(target) == 0).alias("n0"), F.count_if(col(target) == 1).alias("n1")).first()
    n0, n1 = int(r["n0"]), int(r["n1"])
    n = n0 + n1
    return (n / (2.0 * n0) if n0 else 0.0), (n / (2.0 * n1) if n1 else 0.0), n0, n1


def with_weight(df: DataFrame, w0: float, w1: float, target: str = "delay_target") -> DataFrame:
    return df.withColumn("_w", F.when(col(target) == 1, F.lit(w1)).otherwise(F.lit(w0)))


@dataclass
class Fitted:
    name: str
    prep: Preprocessor
    model: object | None          # Spark ML model, None for the majority baseline
    constant: float | None = None

    def predict(self, df: DataFrame) -> DataFrame:
        """Adds ``delay_probability`` (unrounded)."""
        if self.model is None:
            return df.withColumn(PROB, F.lit(float(self.constant)))
        out = self.predict_encoded(self.prep.transform(df))
        return out.select(*[col(c) for c in df.columns], PROB)

    def predict_encoded(self, x: DataFrame) -> DataFrame:
        """Adds ``delay_probability`` to rows that ``prep`` has transformed."""
        out = self.model.transform(x)
        return out.select(*[col(c) for c in x.columns], vector_to_array("probability")[1].alias(PROB))


def uneven(sizes: list[int], cores: int) -> bool:
    """Whether tasks of so many rows keep cores waiting, or one holds too many."""
    if sum(sizes) < cores * TASK_ROWS:
        return False
    load = [0] * cores
    for n in sorted(sizes, reverse=True):
        heapreplace(load, load[0] + n)
    return max(sizes) > FILE_ROWS or max(load) > 1.2 * sum(sizes) / cores


def dealt(train: DataFrame, prep: Preprocessor, target: str = "delay_target") -> DataFrame | None:
    """(target, features) of all training rows, encoded and written once for all fits; None if the table's own files
    are even and small enough to be read as they are.

    An iteration of a fit ends with its slowest task, and what a task holds must not grow with the table. So rows are
    dealt evenly by a hash of all their columns into files of at most about FILE_ROWS, as many a round as cores, and
    each round of files is a scan of its own, which gives a task one file. The hash also orders the rows, so that a
    fit's draws do not depend on how the table was cut."""
    spark = train.sparkSession
    cores = spark.sparkContext.defaultParallelism
    sizes = [r["n"] for r in train.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]  # one a task
    if not uneven(sizes, cores):
        return None
    rounds = -(-sum(sizes) // (cores * FILE_ROWS))
    rows = train.withColumn("_deal", F.xxhash64(*[col(c) for c in train.columns])).repartition(rounds * cores, "_deal")
    rows = rows.withColumn("_round", F.spark_partition_id() % rounds).sortWithinPartitions("_round", "_deal")
    path = f"{checkpoint_dir(spark).rstrip('/')}/stage/encoded-{uuid.uuid4().hex}"
    prep.transform(rows).select(col(target), "features", "_round").write.partitionBy("_round").parquet(path)
    forget_at_exit(spark, path)
    written = spark.read.schema(rows.select(col(target)).schema.add("features", VectorUDT()).add("_round", IntegerType())).parquet(path)
    return reduce(DataFrame.union, [written.where(F.col("_round") == r).drop("_round") for r in range(rounds)])


def encode(train: DataFrame, prep: Preprocessor, target: str = "delay_target") -> DataFrame:
    """The encoded training rows, dealt where the table's files are uneven."""
    table = dealt(train, prep, target)
    return prep.transform(train) if table is None else table


def fit_baseline(train: DataFrame, prep: Preprocessor, target: str = "delay_target") -> Fitted:
    """M9: always the majority class, probability 0 or 1."""
    _, _, n0, n1 = class_weights(train, target)
    return Fitted("majority_baseline", prep, None, constant=1.0 if n1 > n0 else 0.0)


def fit_logreg(train: DataFrame, prep: Preprocessor, s: Settings = DEFAULT, target: str = "delay_target",
               c: float | None = None, max_iter: int = 1000, tol: float = 1e-4, encoded: DataFrame | None = None) -> Fitted:
    encoded = encoded if encoded is not None else encode(train, prep, target)
    w0, w1, n0, n1 = class_weights(encoded, target)
    total_w = w0 * n0 + w1 * n1
    c = s.lr_c if c is None else c
    x = with_weight(encoded, w0, w1, target)
    lr = LogisticRegression(featuresCol="features", labelCol=target, weightCol="_w", maxIter=max_iter,
                            regParam=1.0 / (c * total_w), elasticNetParam=0.0, standardization=False,
                            fitIntercept=True, tol=tol)
    return Fitted("logistic_regression", prep, lr.fit(x))


def fit_forest(train: DataFrame, prep: Preprocessor, s: Settings = DEFAULT, target: str = "delay_target",
               trees: int | None = None, depth: int | None = None, min_leaf: int = 1, subset: str = "sqrt",
               encoded: DataFrame | None = None) -> Fitted:
    encoded = encoded if encoded is not None else encode(train, prep, target)
    w0, w1, _, _ = class_weights(encoded, target)
    x = with_weight(encoded, w0, w1, target)
    rf = RandomForestClassifier(featuresCol="features", labelCol=target, weightCol="_w",
                                numTrees=trees or s.rf_trees, maxDepth=depth or s.rf_depth, seed=s.seed,
                                featureSubsetStrategy=subset, minInstancesPerNode=min_leaf)
    return Fitted("random_forest", prep, rf.fit(x))


def fit_boosting(train: DataFrame, prep: Preprocessor, s: Settings = DEFAULT, target: str = "delay_target",
                 iters: int | None = None, depth: int | None = None, step: float | None = None, subsample: float = 1.0,
                 subset: str = "all", encoded: DataFrame | None = None) -> Fitted:
    encoded = encoded if encoded is not None else encode(train, prep, target)
    _, _, n0, n1 = class_weights(encoded, target)
    pos_w = (n0 / n1) if n1 else 1.0
    x = with_weight(encoded, 1.0, pos_w, target)
    gbt = GBTClassifier(featuresCol="features", labelCol=target, weightCol="_w", maxIter=iters or s.gbt_iter,
                        maxDepth=depth or s.gbt_depth, stepSize=step or s.gbt_step, seed=s.seed,
                        subsamplingRate=subsample, featureSubsetStrategy=subset)
    return Fitted("gradient_boosting", prep, gbt.fit(x))


FITTERS = {"logistic_regression": fit_logreg, "random_forest": fit_forest, "gradient_boosting": fit_boosting}


def grid_points(estimator: str) -> list[dict]:
    """Every combination of an estimator's tuning lists, the last list varying fastest."""
    lists = config.TUNING_GRIDS[estimator]
    return [dict(zip(lists, values)) for values in product(*lists.values())]


def shared_fits(points: list[tuple]) -> list[tuple[dict, list[int]]]:
    """(parameters, numbers of the points that it serves) of each fit, long ones first.

    Boosting's first iterations do not depend on how many follow, so points (family, index, preprocessor, parameters) that
    differ in ``iters`` only take theirs from the fit of the longest."""
    groups: dict[tuple, list[int]] = {}
    for k, (name, _, prep, params) in enumerate(points):
        rest = sorted((n, v) for n, v in params.items() if n != "iters")
        groups.setdefault((id(prep), repr(rest)) if name == "gradient_boosting" else (k,), []).append(k)
    found = [(max((points[k][3] for k in ks), key=_iters), ks) for ks in groups.values()]
    order = ["gradient_boosting", "random_forest", "logistic_regression"]
    return sorted(found, key=lambda f: (order.index(points[f[1][0]][0]), -(f[0].get("depth") or 0)))


def _iters(params: dict, s: Settings = DEFAULT) -> int:
    return params.get("iters") or s.gbt_iter


def shortened(fitted: Fitted, iters: int) -> Fitted:
    """Boosting as a fit of so many iterations gives it: tree k is grown from the trees before it and ``seed + k``."""
    model = fitted.model
    if model.getNumTrees <= iters:
        return fitted
    sc = SparkContext.getOrCreate()  # threads of a pool have no active session
    trees = sc._gateway.new_array(sc._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, iters)
    weights = sc._gateway.new_array(sc._jvm.double, iters)
    for k in range(iters):
        trees[k], weights[k] = model.trees[k]._java_obj, float(model.treeWeights[k])
    own = sc._jvm.org.apache.spark.ml.classification.GBTClassificationModel(model.uid, trees, weights, model.numFeatures, model.numClasses)
    own = own.copy(model._java_obj.extractParamMap())
    own.set(own.getParam("maxIter"), iters)
    cut = GBTClassificationModel(own)
    cut._transfer_params_from_java()
    return Fitted(fitted.name, fitted.prep, cut)


def tune_families(train: DataFrame, val: DataFrame, families: dict[str, tuple[Preprocessor, list[dict]]],
                  target: str = "delay_target", parallel: int = 4,
                  encoded: dict[int, DataFrame] | None = None) -> tuple[DataFrame, dict[str, Fitted]]:
    """Fit the grid points of each family on train and judge all by their exact AP on the fixed chronological
    validation split. Encoded tables are written once (``encoded``: what ``encode`` gave for train, by id of the preprocessor)
    and points are fitted side by side, fewer of them where many rows would crowd each other out of memory; each writes its
    scores, and those of all points form one long table with one AP job. Points are compared unrounded and a family's first maximum wins.
    Returns (family, grid_index, params, val_pr_auc, best) and the best model of each family."""
    from ..operators import metrics
    preps = {id(prep): prep for prep, _ in families.values()}
    if encoded is None:
        encoded = {k: encode(train, prep, target) for k, prep in preps.items()}
    tables = {k: stage_table(t, "encoded") if len(t.columns) > 2 else t for k, t in encoded.items()}  # dealt ones are written
    judged = {k: stage_table(prep.transform(val).select(col(target).alias("y"), "features"), "judged") for k, prep in preps.items()}
    points = [(name, i, prep, params) for name, (prep, grid) in families.items() for i, params in enumerate(grid)]
    rows = next(iter(tables.values())).count() if tables else 0

    path = f"{checkpoint_dir(train.sparkSession).rstrip('/')}/stage/grid_scores-{uuid.uuid4().hex}"
    forget_at_exit(train.sparkSession, path)

    def one(fit) -> list[tuple[int, Fitted]]:
        params, served = fit
        name, _, prep, _ = points[served[0]]
        f = FITTERS[name](train, prep, target=target, encoded=tables[id(prep)], **params)
        own = [(k, shortened(f, _iters(points[k][3])) if name == "gradient_boosting" else f) for k in served]
        for k, g in own:
            g.predict_encoded(judged[id(prep)]).select("y", F.col(PROB).alias("p")).write.parquet(f"{path}/point={k}")
        return own

    with ThreadPool(max(1, min(parallel, SIDE_ROWS // max(1, rows)))) as pool:
        found = {k: g for own in pool.map(one, shared_fits(points), chunksize=1) for k, g in own}
    y = next(iter(judged.values())).select("y").schema
    long = train.sparkSession.read.schema(y.add("p", DoubleType()).add("point", IntegerType())).parquet(path)
    ap = {r["point"]: float(r["pr_auc"]) for r in metrics.average_precision(long, groups=["point"], rounded=False).collect()}
    best = {}
    for k, (name, *_rest) in enumerate(points):
        if name not in best or ap[k] > ap[best[name]]:
            best[name] = k
    rows = [(name, i, str(params), ap[k], k == best[name]) for k, (name, i, _, params) in enumerate(points)]
    table = train.sparkSession.createDataFrame(rows, "family string, grid_index int, params string, val_pr_auc double, best boolean")
    return table, {name: found[k] for name, k in best.items()}


def tune(train: DataFrame, val: DataFrame, prep: Preprocessor, estimator: str = "logistic_regression",
         grid: list[dict] | None = None, target: str = "delay_target", parallel: int = 4) -> tuple[DataFrame, Fitted]:
    """One family of ``tune_families`` over its whole grid or the given points: (grid_index, params, val_pr_auc, best)
    and the best model."""
    table, best = tune_families(train, val, {estimator: (prep, grid or grid_points(estimator))}, target, parallel)
    return table.drop("family"), best[estimator]


def score(fitted: Fitted, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Strip outcome/target columns, probability (4 dp), class from the
    unrounded probability, risk tier."""
    drop = [c for c in df.columns if c in config.OUTCOME_COLUMNS or c == "delay_target"]
    x = fitted.predict(df.drop(*drop)) if drop else fitted.predict(df)
    p = F.col(PROB)
    return x.withColumns({"predicted_class": (p >= threshold).cast("int"),
                          "risk_level": S.risk_tier(p)}).withColumn(PROB, S.round_half_even(p, 4))


def importance(fitted: Fitted) -> DataFrame:
    """Tree importances or |coefficient|, ranked."""
    names = fitted.prep.feature_names()
    m = fitted.model
    if m is None:
        vals = [0.0] * len(names)
    elif hasattr(m, "featureImportances"):
        vals = m.featureImportances.toArray().tolist()
    else:
        vals = [abs(v) for v in m.coefficients.toArray().tolist()]
    # one row per model feature: a driver-side list bounded by the feature count
    ranked = sorted(zip(names, vals), key=lambda t: (-t[1], t[0]))
    rows = [(n, float(v), i + 1) for i, (n, v) in enumerate(ranked)]
    return SparkSession.getActiveSession().createDataFrame(rows, "feature string, importance double, rank int")


def linear_contributions(fitted: Fitted, train: DataFrame) -> DataFrame:
    """Mean |coef_j * (x_j - mean_j)| per transformed feature (exact for
    a linear model); vectors are exploded once into (position, value)."""
    from pyspark.ml.stat import Summarizer
    x = fitted.prep.transform(train).select("features")
    means = x.select(Summarizer.mean(F.col("features")).alias("m")).first()["m"].toArray().tolist()
    table = list(zip(fitted.prep.feature_names(), fitted.model.coefficients.toArray().tolist(), means))
    info = F.array(*[F.struct(F.lit(n).alias("feature"), F.lit(float(c)).alias("coef"), F.lit(float(m)).alias("mean")) for n, c, m in table])
    each = x.select(F.posexplode(vector_to_array("features")).alias("j", "v")).groupBy("j")
    at = F.get(info, F.col("j"))
    shift = F.get(F.array(*[F.lit(float(m)) for m in means]), F.col("j"))
    out = each.agg(F.avg(F.abs(F.col("v") - shift)).alias("away"))
    return out.select(at["feature"].alias("feature"), S.round_half_even(F.abs(at["coef"]) * F.col("away"), 6).alias("mean_abs"))


def save(fitted: Fitted, path: str) -> str:
    """Encoder and estimator through Spark ML writers, constants as JSON."""
    import json
    spark = SparkSession.getActiveSession()
    meta = {"name": fitted.name, "numeric": fitted.prep.numeric, "categorical": fitted.prep.categorical,
            "scale": fitted.prep.scale, "medians": fitted.prep.medians, "means": fitted.prep.means,
            "stds": fitted.prep.stds, "constant": fitted.constant,
            "model_class": type(fitted.model).__name__ if fitted.model is not None else None}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")
    fitted.prep.encoder.write().overwrite().save(f"{path}/encoder")
    if fitted.model is not None:
        fitted.model.write().overwrite().save(f"{path}/model")
    return path


def load(path: str) -> Fitted:
    import json
    from pyspark.ml import PipelineModel
    from pyspark.ml import classification as C
    spark = SparkSession.getActiveSession()
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    prep = Preprocessor(meta["numeric"], meta["categorical"], meta["scale"], meta["medians"], meta["means"],
                        meta["stds"], PipelineModel.load(f"{path}/encoder"))
    model = getattr(C, meta["model_class"]).load(f"{path}/model") if meta["model_class"] else None
    return Fitted(meta["name"], prep, model, meta["constant"])
