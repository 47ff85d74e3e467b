"""Rules that must hold exactly: registries, orders, bins, whole-table correlations, checks that raise, input forms."""

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from flightops import config, schema
from flightops.functions import scalar as S
from flightops.ml import models, prep, select
from flightops.operators import asof, profile, quality
from flightops.plans import catalog, features
from flightops.plans import pipeline as PL
from flightops.sources import files

KEY = ["flight_id"]


def test_registry_v6_fixed_list_has_35_features(spark):
    num, cat, consts = prep.registry_v6(catalog.p3_features(spark, SF_SMALL), key=KEY, fixed_list=True)
    assert (len(num), len(cat)) == (27, 8)
    assert not set(num) & set(config.V6_EXTRA_ALIASES) and "route_distance_category" not in cat
    assert consts == sorted(config.V6_FIXED_CONSTANTS)


def test_registry_v4_keeps_aliases_and_refuses_outcomes(spark):
    p3 = catalog.p3_features(spark, SF_SMALL)
    num, cat, _ = prep.registry_v4(p3, key=KEY)
    assert {"carrier_prior_delay_rate", "prior_origin_flight_volume"} <= set(num)
    assert len(num) + len(cat) in (63, 64)
    for registry in (prep.registry_v4, prep.registry_v6):
        with pytest.raises(ValueError, match="post-flight"):
            registry(p3.withColumn("arrival_delay", F.lit(1.0)), key=KEY)


def test_top_routes_go_by_volume_and_airports_by_rate(spark):
    rows = [("A_B", 1)] * 6 + [("C_D", 0)] * 7 + [("C_D", 1)] + [("E_F", 0)] * 4 + [("G_H", 1)] * 2 + [("G_H", 0)] * 6
    df = spark.createDataFrame(rows, "route string, delay_target int")
    got = [r["route"] for r in profile.top_groups(df, "route", 5, 12, by="volume").collect()]
    assert got == ["G_H", "C_D", "A_B"]          # 8 and 8 flights: the higher rate first; 4 flights are too few
    assert [r["route"] for r in profile.top_groups(df, "route", 5, 2).collect()] == ["A_B", "G_H"]


def test_rate_histogram_spans_the_data(spark):
    df = spark.createDataFrame([(0.2, 0.5), (0.3, 0.5), (0.4, 0.5), (0.6, 0.5)], "a double, b double")
    got = {(r["column_name"], r["bin"]): r["n"] for r in profile.rate_histogram(df, ["a", "b"], bins=4).collect()}
    assert got == {("a", 0): 1, ("a", 1): 1, ("a", 2): 1, ("a", 3): 1, ("b", 2): 4} or got[("a", 3)] == 1 and got[("b", 2)] == 4


def test_correlations_use_present_pairs_and_skip_constants(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5, 0), (2.0, None, 5, 1), (3.0, 6.0, 5, 1), (4.0, 7.0, 5, 0)], "a double, b double, c int, y int")
    pairs = {(r["feature_1"], r["feature_2"]): r["correlation"] for r in profile.correlation_pairs(df, ["a", "b", "c"]).collect()}
    import numpy as np
    assert pairs == {("a", "b"): round(float(np.corrcoef([1, 3, 4], [2, 6, 7])[0, 1]), 4)}
    assert {r["feature"] for r in profile.target_correlations(df, ["a", "b", "c"], "y").collect()} == {"a", "b"}


def test_overview_ignores_the_key(spark):
    df = spark.createDataFrame([(1, "x", 2.0), (2, "x", 2.0), (3, "y", 1.0)], "id long, s string, d double")
    r = profile.overview(df, key=["id"]).first()
    assert (r["duplicate_rows"], r["total_features"], r["dtypes"]) == (1, 2, "double: 1, string: 1")


def test_alignment_and_temporal_checks_raise(spark):
    a = spark.createDataFrame([(1, 0), (2, 1)], "flight_id long, y int")
    assert quality.assert_population_alignment(a, a, KEY, ["y"])["rows_a"] == 2
    for b in (a.where("flight_id = 1"), a.withColumn("y", F.lit(0))):
        with pytest.raises(ValueError, match="do not align"):
            quality.assert_population_alignment(a, b, KEY, ["y"])
    with pytest.raises(ValueError, match="temporal leakage"):
        quality.assert_temporal_validity(spark.createDataFrame([(5, 5)], "h long, p long"), "h", "p")


def test_dates_that_all_fail_raise(spark):
    pre = PL.pre_departure(spark, SF_SMALL).withColumn("flight_date", F.lit("never"))
    with pytest.raises(ValueError, match="is a date"):
        features.base_features_2a(pre, KEY)


def test_folder_and_glob_input(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, y string")
    for k in (0, 1):
        df.write.parquet(str(tmp_path / f"in/part{k}.parquet"))
        df.write.option("header", True).csv(str(tmp_path / f"csvs/part{k}.csv"))
    assert files.read_table(spark, str(tmp_path / "in")).count() == 4
    assert files.read_table(spark, str(tmp_path / "in/*")).count() == 4
    assert sorted(files.read_table(spark, str(tmp_path / "csvs")).columns) == ["x", "y"]
    status, path = files.find_dataset(spark, str(tmp_path / "in"))
    assert status == "found" and path.endswith("part0.parquet")
    (tmp_path / "none").mkdir()
    assert files.find_dataset(spark, str(tmp_path / "none")) == ("not provided", None)
    with pytest.raises(ValueError, match="no csv or parquet"):
        files.read_table(spark, str(tmp_path / "none"))


def test_weather_measures_can_be_named(spark):
    w = spark.createDataFrame([(40.0, 0.5)], "gust_max double, vis_km double")
    assert w.select(S.weather_flags(w.columns)["storm"].alias("f")).first()["f"] == 0
    named = S.weather_flags(w.columns, {"wind": "gust_max", "visibility": "vis_km"})
    assert tuple(w.select(named["storm"], named["low_visibility"]).first()) == (1, 1)


def test_joined_weather_has_no_destination_flags(spark):
    t = features.feature_table_p3(PL.pre_departure(spark, SF_SMALL), KEY, weather=PL.weather(spark, SF_SMALL))
    assert "origin_is_rain" in t.columns and not any(c.startswith(("dest_is_", "weather_dest_")) for c in t.columns)


def test_lag_hides_fresh_observations(spark):
    pre, w = PL.pre_departure(spark, SF_SMALL), PL.weather(spark, SF_SMALL)
    matched = [asof.match_rate(asof.asof_weather(pre, w, key=KEY, availability_lag_minutes=lag)).first()["matched"] for lag in (0, 60, 121)]
    assert matched[0] >= matched[1] >= matched[2] == 0


def test_model_choice_compares_unrounded_scores(spark):
    rows = [("random_forest", .40004, .5, .5, .2, .3), ("gradient_boosting", .40000, .5, .5, .2, .3), ("majority_baseline", .9, .9, .9, .0, .5)]
    v = spark.createDataFrame(rows, "model string, pr_auc double, roc_auc double, best_f1 double, brier_score double, best_threshold double")
    assert select.select_tree_model(v).first()[0] == "random_forest"
    assert tuple(select.select_model(v).first())[::2] == ("random_forest", .3)
    won = {r["model"]: r["winner"] for r in select.composite_score(v).collect()}
    assert won == {"random_forest": True, "gradient_boosting": False}


def test_tuning_returns_the_first_best_point(spark):
    sp = catalog.p3_features(spark, SF_SMALL).withColumn("part", F.col("flight_id") % 3)
    train, val = sp.where("part > 0").drop("part"), sp.where("part = 0").drop("part")
    pre = prep.Preprocessor(["distance", "prior_origin_delay_rate"], [], scale=True).fit(train)
    table, best = models.tune(train, val, pre, "random_forest", [{"trees": 2, "depth": 1, "min_leaf": m} for m in (1, 1, 50)])
    rows = sorted(table.collect())
    assert sum(r["best"] for r in rows) == 1 and not rows[1]["best"] and best.name == "random_forest"
    assert len(models.grid_points("gradient_boosting")) == 72


def test_feature_set_changes():
    got = schema.feature_set_changes(["a", "b", "c"], ["b", "c", "d"], enhanced=["c"])
    assert got == {"retained": ["b"], "enhanced": ["c"], "new": ["d"], "dropped": ["a"]}
