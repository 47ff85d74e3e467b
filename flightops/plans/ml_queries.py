"""Model-layer queries. Fitted models are not hash-comparable with SQL, so
most of these get the driver's rows-only check; the SQL-expressible pieces
(training medians, route support, majority baseline, metric deltas) carry
DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..ml import compare, explain, models, prep, select, shapley
from ..operators import metrics, prefix, split
from . import pipeline as PL
from . import features
from .catalog import _AP, _AUC, _CM, KEY, _a2_sql, _rates_sql, p3_features, register
from .oracle import CTES, r2, r4, sql

_CTX: dict = {}

# numeric inputs whose training medians form the imputation table
MEDIAN_COLS = ["distance", "scheduled_dep_time", "scheduled_arr_time", "is_month_start", "is_month_end", "quarter",
               "dep_minute_sin", "dep_minute_cos", "arr_hour_sin", "arr_hour_cos", "route_distance",
               "prior_route_frequency", "prior_origin_flight_volume", "prior_dest_flight_volume",
               "prior_airline_delay_rate", "prior_origin_delay_rate", "prior_dest_delay_rate",
               "prior_route_delay_rate", "prior_airline_dep_hour_delay_rate", "prior_origin_dep_hour_delay_rate"]


def split_features(spark: SparkSession, sf: str) -> DataFrame:
    def plan():
        return split.chronological_split(p3_features(spark, sf), key="flight_id")
    return PL.materialize(spark, "p3_split", plan, sf)


def split_features_2a(spark: SparkSession, sf: str) -> DataFrame:
    """The 2A table with the parts of the P3 split, row by row."""
    def plan():
        table = features.feature_table_2a(PL.pre_departure(spark, sf), KEY)
        return compare.transfer_split(split_features(spark, sf), table, KEY)
    return PL.materialize(spark, "a2_split", plan, sf)


def context(spark: SparkSession, sf: str, table: str = "p3") -> dict:
    """Splits, v6 feature registry and fitted preprocessors of a feature table, p3 or 2a (once per session)."""
    k = (spark.sparkContext.applicationId, sf, table)
    if k in _CTX:
        return _CTX[k]
    sp = split_features(spark, sf) if table == "p3" else split_features_2a(spark, sf)
    train, val, test = (sp.filter(F.col("split") == s).drop("split") for s in ("train", "val", "test"))
    num, cat, consts = prep.registry_v6(p3_features(spark, sf) if table == "p3" else sp.drop("split"), key=KEY)
    scaled = prep.Preprocessor(num, cat, scale=True).fit(train)
    ctx = {"train": train, "val": val, "test": test, "numeric": num, "categorical": cat, "constants": consts,
           "prep_scaled": scaled, "prep_plain": scaled.unscaled(), "models": {}, "encoded": {}}
    _CTX[k] = ctx
    return ctx


def _encoded(ctx: dict, prep_name: str) -> DataFrame:
    """The training rows encoded by a preprocessor of the context, for all its fits."""
    if prep_name not in ctx["encoded"]:
        ctx["encoded"][prep_name] = models.encode(ctx["train"], ctx[prep_name])
    return ctx["encoded"][prep_name]


def fitted(spark: SparkSession, sf: str, name: str, table: str = "p3") -> models.Fitted:
    ctx = context(spark, sf, table)
    if name not in ctx["models"]:
        if name == "logistic_regression":
            f = models.fit_logreg(ctx["train"], ctx["prep_scaled"], encoded=_encoded(ctx, "prep_scaled"))
        elif name == "random_forest":
            f = models.fit_forest(ctx["train"], ctx["prep_plain"], encoded=_encoded(ctx, "prep_plain"))
        elif name == "gradient_boosting":
            f = models.fit_boosting(ctx["train"], ctx["prep_plain"], encoded=_encoded(ctx, "prep_plain"))
        else:
            f = models.fit_baseline(ctx["train"], ctx["prep_plain"])
        ctx["models"][name] = f
    return ctx["models"][name]


def _test_predictions(spark, sf, name) -> DataFrame:
    ctx = context(spark, sf)
    return models.score(fitted(spark, sf, name), ctx["test"]).select(
        "flight_id", models.PROB, "predicted_class", "risk_level")


CTES["train"] = ("train AS (SELECT p.* FROM p3 p JOIN splitp s USING (flight_id) WHERE s.split = 'train')",
                 ["p3", "splitp"])


def _with_train(body: str) -> str:
    return sql(body, "train", "p3", "splitp")


@register("impute_medians", _with_train(
    "SELECT feature, CAST(median AS DOUBLE) AS median FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median FROM train" for c in MEDIAN_COLS)
    + ") m"))
def q_impute_medians(spark, sf):
    return prep.median_table(context(spark, sf)["train"], MEDIAN_COLS)


@register("route_support", sql(
    "SELECT CAST(count(*) AS BIGINT) AS total_records, CAST(count(DISTINCT route) AS BIGINT) AS unique_routes, "
    "CAST(round_even(count(*) / greatest(count(DISTINCT route), 1) * 100, 0) AS DOUBLE) / 100 AS avg_records_per_route "
    "FROM p3", "p3"))
def q_route_support(spark, sf):
    return prep.route_support(p3_features(spark, sf))


@register("feature_registry_v6")
def q_feature_registry(spark, sf):
    ctx = context(spark, sf)
    rows = [(c, "numeric") for c in ctx["numeric"]] + [(c, "categorical") for c in ctx["categorical"]]
    rows += [(c, "dropped_constant") for c in ctx["constants"]]
    return spark.createDataFrame(rows, "feature string, role string")


@register("baseline_majority", _with_train(
    f"""SELECT CAST(count(*) AS BIGINT) AS n_samples, CAST(sum(delay_target) AS BIGINT) AS n_positive,
  CAST(count_if(delay_target = 0 AND m = 0) AS BIGINT) AS tn, CAST(count_if(delay_target = 0 AND m = 1) AS BIGINT) AS fp,
  CAST(count_if(delay_target = 1 AND m = 0) AS BIGINT) AS fn, CAST(count_if(delay_target = 1 AND m = 1) AS BIGINT) AS tp,
  {r4('count_if(delay_target = m) / count(*)')} AS accuracy, {r4('avg((m - delay_target) * (m - delay_target))')} AS brier_score
  FROM (SELECT t.delay_target, mj.m FROM (SELECT p.delay_target FROM p3 p JOIN splitp s USING (flight_id)
    WHERE s.split = 'test') t, (SELECT CASE WHEN count_if(delay_target = 1) > count_if(delay_target = 0) THEN 1 ELSE 0 END
    AS m FROM train) mj) x"""))
def q_baseline_majority(spark, sf):
    ctx = context(spark, sf)
    f = fitted(spark, sf, "majority_baseline")
    p = f.predict(ctx["test"]).select(F.col("delay_target").alias("y"), F.col(models.PROB).alias("p"))
    m = metrics.class_metrics(p, threshold=0.5)
    return m.select("n_samples", "n_positive", "tn", "fp", "fn", "tp", "accuracy", "brier_score")


@register("ml_logreg")
def q_ml_logreg(spark, sf):
    return _test_predictions(spark, sf, "logistic_regression")


@register("ml_rf")
def q_ml_rf(spark, sf):
    return _test_predictions(spark, sf, "random_forest")


@register("ml_gbt")
def q_ml_gbt(spark, sf):
    return _test_predictions(spark, sf, "gradient_boosting")


@register("ml_score")
def q_ml_score(spark, sf):
    """Scoring of the test split with risk tiers (M16 + F17)."""
    return _test_predictions(spark, sf, "logistic_regression")


#: The tuned families and their preprocessors; every point of their grids is fitted (8 + 18 + 72).
TUNED = {"logistic_regression": "prep_scaled", "random_forest": "prep_plain", "gradient_boosting": "prep_plain"}


def tuned(spark, sf) -> tuple[DataFrame, dict[str, models.Fitted]]:
    """The table of all families' grid points, and the best model of each (once per session)."""
    ctx = context(spark, sf)
    if "tuned" not in ctx:
        ctx["tuned"] = models.tune_families(ctx["train"], ctx["val"], {f: (ctx[p], models.grid_points(f)) for f, p in TUNED.items()},
            encoded={id(ctx[p]): _encoded(ctx, p) for p in ("prep_scaled", "prep_plain")})
    return ctx["tuned"]


@register("ml_tuning")
def q_ml_tuning(spark, sf):
    """Grid points of the three families, judged by one grouped AP job on the validation part."""
    return tuned(spark, sf)[0]


def _long_eval(spark, sf, names, table: str = "p3", found: dict[str, models.Fitted] | None = None) -> DataFrame:
    ctx = context(spark, sf, table)
    out = None
    for n in names:
        f = (found or {}).get(n) or fitted(spark, sf, n, table)
        for part in ("val", "test"):
            p = f.predict(ctx[part]).select(F.lit(n).alias("model"), F.lit(part).alias("split"),
                                            F.col("delay_target").alias("y"), F.col(models.PROB).alias("p"))
            out = p if out is None else out.unionByName(p)
    return out


_MODELS = ["majority_baseline", "logistic_regression", "random_forest", "gradient_boosting"]


def _scores(spark, sf, table: str = "p3", tune: bool = False) -> DataFrame:
    """(model, split, y, p) of the four models on validation and test, written once."""
    def plan():
        return _long_eval(spark, sf, _MODELS, table, tuned(spark, sf)[1] if tune else None)
    return PL.materialize(spark, f"scores_{table}{'_tuned' if tune else ''}", plan, sf)


@register("eval_matrix")
def q_eval_matrix(spark, sf):
    """The tuned models at .50 and at the threshold frozen on validation, on both parts."""
    return compare.evaluation_matrix(_scores(spark, sf, tune=True))


def _val_table(spark, sf) -> DataFrame:
    """The tuned models on validation at their frozen threshold, with that threshold's F1 (a few rows, written once)."""
    def plan():
        long = _scores(spark, sf, tune=True)
        frozen = compare.frozen_thresholds(long)
        ev = compare.evaluation_matrix(long, frozen).filter((F.col("split") == "val") & (F.col("operating_point") == "tuned"))
        return ev.drop("split", "operating_point").join(frozen, "model")
    return PL.materialize(spark, "val_metrics", plan, sf)


@register("select_model")
def q_select_model(spark, sf):
    return select.select_model(_val_table(spark, sf))


@register("composite_score")
def q_composite(spark, sf):
    return select.composite_score(_val_table(spark, sf)).select("model", "composite_score", "winner")


@register("select_tree_model")
def q_select_tree(spark, sf):
    return select.select_tree_model(_val_table(spark, sf))


@register("ml_importance")
def q_ml_importance(spark, sf):
    return models.importance(fitted(spark, sf, "random_forest"))


@register("linear_shap")
def q_linear_shap(spark, sf):
    ctx = context(spark, sf)
    return models.linear_contributions(fitted(spark, sf, "logistic_regression"), ctx["train"])


@register("tree_shap")
def q_tree_shap(spark, sf):
    """Mean |Shapley value| of every model feature of the forest and of boosting, over the validation part."""
    ctx = context(spark, sf)
    each = [shapley.mean_contributions(fitted(spark, sf, n), ctx["val"]).select(F.lit(n).alias("model"), "feature", "mean_abs")
            for n in ("random_forest", "gradient_boosting")]
    return each[0].unionByName(each[1])


@register("permutation_importance")
def q_permutation_importance(spark, sf):
    ctx = context(spark, sf)
    cols = ctx["numeric"] + ctx["categorical"]
    return explain.permutation_importance(fitted(spark, sf, "logistic_regression"), ctx["val"], cols, KEY)


@register("ml_persist")
def q_ml_persist(spark, sf):
    """Save, load, re-score the test split; count differing rows."""
    import uuid
    from ..session import checkpoint_dir, forget_at_exit
    ctx = context(spark, sf)
    f = fitted(spark, sf, "logistic_regression")
    path = f"{checkpoint_dir(spark).rstrip('/')}/models/lr-{uuid.uuid4().hex}"
    g = models.load(models.save(f, path))
    forget_at_exit(spark, path)
    a = f.predict(ctx["test"]).select("flight_id", F.col(models.PROB).alias("a"))
    b = g.predict(ctx["test"]).select("flight_id", F.col(models.PROB).alias("b"))
    return a.join(b, "flight_id").agg(F.count(F.lit(1)).cast("long").alias("rows"),
                                      F.count_if(F.abs(F.col("a") - F.col("b")) > 1e-12).cast("long").alias("differing"))


# ---- metric deltas on deterministic scores (SQL-checkable) ------------------

def _two_scores(spark, sf) -> DataFrame:
    sp = split_features(spark, sf)
    a = sp.select(F.lit("origin_rate").alias("experiment"), "split", F.col("delay_target").alias("y"),
                  F.col("prior_origin_delay_rate").alias("p"))
    b = sp.select(F.lit("airline_rate").alias("experiment"), "split", F.col("delay_target").alias("y"),
                  F.col("prior_airline_delay_rate").alias("p"))
    return a.unionByName(b)


_DELTA_METRICS = ["accuracy", "precision", "recall", "f1"]


@register("experiment_deltas", sql(
    f"""SELECT a.split, a.metric, a.v AS base_value, b.v AS new_value, {r4('b.v - a.v')} AS abs_delta,
  {r2("CASE WHEN a.v <> 0 THEN (b.v - a.v) / abs(a.v) * 100 WHEN b.v = a.v THEN 0.0 ELSE 100.0 END")} AS pct_delta
  FROM (UNPIVOT (SELECT split, {', '.join(_DELTA_METRICS)} FROM ({{A}})) ON {', '.join(_DELTA_METRICS)} INTO NAME metric VALUE v) a
  JOIN (UNPIVOT (SELECT split, {', '.join(_DELTA_METRICS)} FROM ({{B}})) ON {', '.join(_DELTA_METRICS)} INTO NAME metric VALUE v) b
  USING (split, metric)""", "p3", "splitp"))
def q_experiment_deltas(spark, sf):
    m = metrics.class_metrics(_two_scores(spark, sf), groups=["experiment", "split"])
    return metrics.metric_deltas(m, ["split"], "experiment", "origin_rate", "airline_rate", _DELTA_METRICS).select(
        "split", "metric", "base_value", "new_value", "abs_delta", "pct_delta")


def _rates_src(score_col: str) -> str:
    def d(a, b):
        return f"coalesce(CAST({a} AS DOUBLE) / nullif({b}, 0), 0.0)"
    return (f"SELECT split, {r4(d('tp + tn', 'tn + fp + fn + tp'))} AS accuracy, {r4(d('tp', 'tp + fp'))} AS precision, "
            f"{r4(d('tp', 'tp + fn'))} AS recall, {r4(d('2 * tp', '2 * tp + fp + fn'))} AS f1 FROM ("
            f"SELECT s.split, count_if(p3.delay_target = 0 AND {score_col} < 0.5) AS tn, "
            f"count_if(p3.delay_target = 0 AND {score_col} >= 0.5) AS fp, "
            f"count_if(p3.delay_target = 1 AND {score_col} < 0.5) AS fn, "
            f"count_if(p3.delay_target = 1 AND {score_col} >= 0.5) AS tp "
            f"FROM p3 JOIN splitp s USING (flight_id) GROUP BY s.split) c")


from . import catalog as _catalog  # noqa: E402

_catalog.ORACLES["experiment_deltas"] = _catalog.ORACLES["experiment_deltas"].replace(
    "{A}", _rates_src("p3.prior_origin_delay_rate")).replace("{B}", _rates_src("p3.prior_airline_delay_rate"))


@register("importance_highlights")
def q_importance_highlights(spark, sf):
    return explain.importance_highlights(models.importance(fitted(spark, sf, "random_forest")))


@register("importance_groups")
def q_importance_groups(spark, sf):
    return explain.importance_groups(p3_features(spark, sf), models.importance(fitted(spark, sf, "random_forest")))


@register("feature_registry_v4")
def q_feature_registry_v4(spark, sf):
    num, cat, const = prep.registry_v4(p3_features(spark, sf), key=KEY)
    rows = [(c, "numeric") for c in num] + [(c, "categorical") for c in cat] + [(c, "dropped_constant") for c in const]
    return spark.createDataFrame(rows, "feature string, role string")


@register("comparison_table")
def q_comparison_table(spark, sf):
    return metrics.comparison_table(metrics.evaluate(_scores(spark, sf, tune=True), groups=["model", "split"]))


_BASE_METRICS = compare.METRICS


def _rate_vs_majority(spark, sf) -> DataFrame:
    """Deterministic scores on the test split: the strictly prior origin rate
    and the majority-class constant learned on train."""
    sp = split_features(spark, sf)
    train = sp.filter(F.col("split") == "train")
    maj = train.agg((F.count_if(F.col("delay_target") == 1) > F.count_if(F.col("delay_target") == 0))
                    .cast("double").alias("m"))
    test = sp.filter(F.col("split") == "test").select(F.col("delay_target").alias("y"),
                                                      F.col("prior_origin_delay_rate").alias("p"))
    a = test.select(F.lit("origin_rate").alias("model"), "y", "p")
    b = prefix.null_safe_join(test, maj, []).select(F.lit("majority_baseline").alias("model"), "y",
                                                    F.col("m").alias("p"))
    return a.unionByName(b)


@register("baseline_deltas", sql(
    f"""SELECT r.metric, r.value, b.value AS base_value, {r4('r.value - b.value')} AS abs_delta,
  {r2('(r.value - b.value) / greatest(abs(b.value), 1e-6) * 100')} AS pct_delta
  FROM (UNPIVOT ({{R}}) ON {', '.join(_BASE_METRICS)} INTO NAME metric VALUE value) r
  JOIN (UNPIVOT ({{B}}) ON {', '.join(_BASE_METRICS)} INTO NAME metric VALUE value) b USING (metric)""",
    "p3", "splitp", "train"))
def q_baseline_deltas(spark, sf):
    m = metrics.evaluate(_rate_vs_majority(spark, sf), groups=["model"])
    d = metrics.baseline_deltas(m, "model", "majority_baseline", _BASE_METRICS)
    return d.select("metric", "value", "base_value", "abs_delta", "pct_delta")


def _metrics_sql(rows: str, groups: str, threshold: str = "0.5") -> str:
    """The seven metrics over rows (groups, y, p[, threshold]) by SQL; ranking metrics of the same groups."""
    def ranked(template: str, **how) -> str:
        return template.format(**how).replace("split", groups).replace("FROM scored", f"FROM ({rows}) scored")
    auc = ranked(_AUC, r=r4("sum(pos * (lt_neg + 0.5 * neg)) / (CAST(sum(pos) AS DOUBLE) * sum(neg))"))
    ap = ranked(_AP, r=r4("sum(CASE WHEN pos > 0 THEN CAST(pos AS DOUBLE) / P * tp_ge / n_ge ELSE 0 END)"),
                r_base=r4("CAST(sum(pos) AS DOUBLE) / greatest(sum(pos + neg), 1)"))
    cm = _rates_sql(f"SELECT {groups}, {_CM.format(t=threshold)}, {r4('avg((p - y) * (p - y))')} AS brier_score FROM ({rows}) scored GROUP BY {groups}")
    return (f"SELECT {groups}, accuracy, precision, recall, f1, roc_auc, pr_auc, brier_score FROM ({cm}) cm "
            f"JOIN ({auc}) auc USING ({groups}) JOIN ({ap}) ap USING ({groups})")


def _test_metrics_sql(score: str) -> str:
    rows = (f"SELECT 'test' AS part, p3.delay_target AS y, {score} AS p FROM p3 JOIN splitp s USING (flight_id) WHERE s.split = 'test'")
    return f"SELECT {', '.join(_BASE_METRICS)} FROM ({_metrics_sql(rows, 'part')}) m"


_catalog.ORACLES["baseline_deltas"] = _catalog.ORACLES["baseline_deltas"].replace(
    "{R}", _test_metrics_sql("p3.prior_origin_delay_rate")).replace(
    "{B}", _test_metrics_sql("(SELECT CAST(count_if(delay_target = 1) > count_if(delay_target = 0) AS DOUBLE) FROM train)"))


# ---- evaluation matrix and 2A against P3 on deterministic scores ------------

_RATES = {"p3": {d: f"prior_{d}_delay_rate" for d in ("origin", "dest", "airline", "route")},
          "2a": {"origin": "historical_origin_delay_rate", "dest": "historical_destination_delay_rate",
                 "airline": "historical_airline_delay_rate", "route": "historical_route_delay_rate"}}


def _rate_scores(spark, sf, table: str) -> DataFrame:
    """(model, split, y, p): four prior rates of a feature table as scores; a missing rate scores 0."""
    sp = split_features(spark, sf) if table == "p3" else split_features_2a(spark, sf)
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.coalesce(F.col(c), F.lit(0.0)).alias("p")) for m, c in _RATES[table].items()]))
    return sp.select("split", F.col("delay_target").alias("y"), each.alias("e")).select("e.model", "split", "y", "e.p")


def _rate_scores_sql(table: str) -> str:
    source = "p3" if table == "p3" else f"({_a2_sql().replace('SELECT flight_id,', 'SELECT flight_id, delay_target,', 1)})"
    return " UNION ALL ".join(f"SELECT '{m}' AS model, s.split, f.delay_target AS y, coalesce(f.{c}, 0.0) AS p "
                              f"FROM {source} f JOIN splitp s USING (flight_id)" for m, c in _RATES[table].items())


def _matrix_ctes(table: str) -> str:
    """ev_ (scores), thr_ (thresholds frozen on validation) and m_ (the evaluation matrix) of a feature table."""
    ev, thr = f"ev_{table}", f"thr_{table}"
    sweep = _rates_sql(f"SELECT model, CAST(t.threshold AS DOUBLE) AS threshold, {_CM.format(t='t.threshold')} FROM {ev} "
                       "JOIN (VALUES (0.3), (0.4), (0.5), (0.6), (0.7)) t(threshold) ON true WHERE split = 'val' GROUP BY model, t.threshold")
    points = f"(SELECT model, '0.50' AS operating_point, CAST(0.5 AS DOUBLE) AS threshold FROM {thr} UNION ALL SELECT model, 'tuned', t FROM {thr})"
    rows = f"SELECT e.*, operating_point, threshold FROM {ev} e JOIN {points} x USING (model)"
    return (f"{ev} AS MATERIALIZED ({_rate_scores_sql(table)}),\n"
            f"{thr} AS (SELECT model, first(threshold ORDER BY f1 DESC, threshold) AS t FROM ({sweep}) w GROUP BY model),\n"
            f"m_{table} AS MATERIALIZED ({_metrics_sql(rows, 'model, split, operating_point, threshold', 'threshold')})")


for _t in ("p3", "2a"):
    CTES[f"m_{_t}"] = (_matrix_ctes(_t), ["p3", "splitp"] if _t == "p3" else ["timed", "gprior", "splitp"])


@register("eval_matrix_rates", sql(
    f"SELECT model, split, operating_point, threshold, {', '.join(compare.METRICS)} FROM m_p3", "m_p3"))
def q_eval_matrix_rates(spark, sf):
    """E11 on four deterministic scores: both thresholds, all parts."""
    return compare.evaluation_matrix(_rate_scores(spark, sf, "p3")).select("model", "split", "operating_point", "threshold", *compare.METRICS)


def _unpivoted(table: str) -> str:
    return (f"(UNPIVOT (SELECT model, threshold, {', '.join(compare.METRICS)} FROM m_{table} WHERE split = 'test' AND operating_point = 'tuned') "
            f"ON {', '.join(compare.METRICS)} INTO NAME metric VALUE v)")


@register("experiment_rates_2a_p3", sql(
    f"""SELECT a.model, a.metric, a.threshold AS base_threshold, b.threshold AS new_threshold, a.v AS base_value, b.v AS new_value,
  {r4('b.v - a.v')} AS abs_delta,
  {r2("CASE WHEN abs(a.v) > 1e-6 THEN (b.v - a.v) / a.v * 100 WHEN abs(b.v) < 1e-6 THEN 0.0 ELSE 100.0 END")} AS pct_delta
  FROM {_unpivoted('2a')} a JOIN {_unpivoted('p3')} b USING (model, metric)""", "m_2a", "m_p3"))
def q_experiment_rates(spark, sf):
    """E13 on deterministic scores: the rates of the 2A table against those of the P3 table, same rows and parts."""
    base, new = (compare.evaluation_matrix(_rate_scores(spark, sf, t)) for t in ("2a", "p3"))
    return compare.experiment(base, new).select("model", "metric", "base_threshold", "new_threshold", "base_value", "new_value",
                                                "abs_delta", "pct_delta")


@register("experiment_2a_p3")
def q_experiment_2a_p3(spark, sf):
    """The four models fitted on the 2A table against those fitted on the P3 table."""
    base, new = (compare.evaluation_matrix(_scores(spark, sf, t)) for t in ("2a", "p3"))
    return compare.experiment(base, new)


@register("ml_preprocess")
def q_ml_preprocess(spark, sf):
    """M7: the fitted preprocessing applied to the test split (dense arrays)."""
    from pyspark.ml.functions import vector_to_array
    ctx = context(spark, sf)
    x = ctx["prep_scaled"].transform(ctx["test"])
    return x.select("flight_id", vector_to_array("features").alias("features"))


@register("ml_rescore")
def q_ml_rescore(spark, sf):
    """Models saved by the 2A and the P3 experiment, loaded again and scored on their own set's test part."""
    import uuid
    from ..session import checkpoint_dir, forget_at_exit
    out = None
    for table in ("2a", "p3"):
        path = f"{checkpoint_dir(spark).rstrip('/')}/models/rf-{table}-{uuid.uuid4().hex}"
        g = models.load(models.save(fitted(spark, sf, "random_forest", table), path))
        forget_at_exit(spark, path)
        p = g.predict(context(spark, sf, table)["test"]).select(
            F.lit(f"random_forest_{table}").alias("model"), F.lit("test").alias("split"), F.col("delay_target").alias("y"), F.col(models.PROB).alias("p"))
        out = p if out is None else out.unionByName(p)
    return metrics.evaluate(out, groups=["model", "split"])
