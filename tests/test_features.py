"""Hand-computed feature cases (schedule parsing, strictly prior history, as-of)."""

import math

import pytest
from pyspark.sql import functions as F

from flightops.functions import scalar as S
from flightops.operators import asof, prior
from flightops.plans import features


def test_hhmm_parsing(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([800, 1515, 5, 2359, 2400, 1485])], "i int, t int")
    h, m, s = S.hhmm_parts(F.col("t"))
    got = [tuple(r) for r in df.orderBy("i").select(h, m, s).collect()]
    assert got == [(8, 0, 480), (15, 15, 915), (0, 5, 5), (23, 59, 1439), (0, 0, 0), (15, 25, 925)]


def test_time_blocks(spark):
    df = spark.createDataFrame([(h,) for h in range(24)], "h int")
    got = {r[0]: (r[1], r[2]) for r in df.select("h", S.time_of_day(F.col("h")),
                                                   S.time_bucket_4h(F.col("h"))).collect()}
    assert got[22] == ("overnight", "20-24") and got[5] == ("overnight", "04-08")
    assert got[6] == ("morning", "04-08") and got[12] == ("afternoon", "12-16") and got[18] == ("evening", "16-20")


def test_haul_boundaries(spark):
    df = spark.createDataFrame([(d,) for d in [499.0, 500.0, 1500.0, 1500.5, None]], "d double")
    r = [tuple(x) for x in df.select(S.haul_2a(F.col("d")), S.haul_p3(S.route_distance_int(F.col("d")))).collect()]
    assert r == [("short_haul", "short_haul"), ("medium_haul", "medium_haul"), ("medium_haul", "long_haul"),
                 ("long_haul", "long_haul"), ("medium_haul", "short_haul")]


CONCURRENT = [("2024-01-01", 800, "AA", "JFK", "LAX", 1, 1), ("2024-01-01", 800, "AA", "JFK", "LAX", 0, 2),
              ("2024-01-02", 900, "AA", "JFK", "LAX", 1, 3), ("2024-01-03", 1000, "AA", "JFK", "LAX", 0, 4)]
SCHEMA = ("flight_date string, scheduled_dep_time int, airline string, origin_airport string, dest_airport string, "
          "delay_target int, flight_id int")


@pytest.mark.parametrize("method", ["prefix", "window"])
def test_concurrent_flights_excluded(spark, method):
    df = spark.createDataFrame(CONCURRENT, SCHEMA)
    h = prior.history_2a(df, min_history=1, fallback="nan", key=["flight_id"], method=method)
    got = [(r["historical_airline_flight_count"], r["historical_airline_delay_rate"])
           for r in h.orderBy("flight_id").collect()]
    assert got == [(0, None), (0, None), (2, 0.5), (3, 0.6667)]


def test_min_history_global_fallback(spark):
    df = spark.createDataFrame([("2024-01-01", 800, "AA", "JFK", "LAX", 1, 1), ("2024-01-02", 900, "AA", "JFK", "LAX", 1, 2),
                                ("2024-01-03", 1000, "DL", "ATL", "MIA", 0, 3)], SCHEMA)
    r = prior.history_2a(df, min_history=3, key=["flight_id"]).filter("flight_id = 3").first()
    assert r["historical_airline_flight_count"] == 0 and r["historical_airline_delay_rate"] == 1.0


def test_p3_history_short_names(spark):
    df = spark.createDataFrame([("2024-01-01", "AA", "JFK", "LAX", "0800", 1, 1), ("2024-01-01", "AA", "JFK", "LAX", "1200", 1, 2),
                                ("2024-01-02", "AA", "JFK", "LAX", "0800", 0, 3), ("2024-01-02", "AA", "JFK", "LAX", "1400", 1, 4),
                                ("2024-01-03", "AA", "JFK", "LAX", "0900", 0, 5)],
                               "flight_date string, carrier string, origin string, dest string, crs_dep_time string, "
                               "delay_target int, flight_id int")
    h = prior.history_p3(df, min_history=3, key=["flight_id"]).orderBy("flight_id").collect()
    assert [r["carrier_prior_flight_count"] for r in h] == [0, 1, 2, 3, 4]
    assert [r["carrier_prior_delay_count"] for r in h] == [0, 1, 2, 2, 3]
    assert [r["carrier_prior_delay_rate"] for r in h] == [0.0, 1.0, 1.0, 0.6667, 0.75]
    cov = {r["dimension"]: r for r in prior.coverage(prior.history_p3(df, key=["flight_id"])).collect()}
    assert cov["prior_airline"]["total_records"] == 5 and cov["prior_airline"]["sufficient_history_count"] == 2


def test_prior_route_frequency_and_airport_rates(spark):
    df = spark.createDataFrame([("2024-01-01", "JFK", "LAX", "0600", 1, 1), ("2024-01-01", "JFK", "LAX", "1200", 0, 2),
                                ("2024-01-01", "ORD", "ATL", "1300", 1, 3), ("2024-01-01", "JFK", "LAX", "1800", 1, 4)],
                               "flight_date string, origin string, dest string, crs_dep_time string, delay_target int, "
                               "flight_id int")
    v = prior.prior_volumes(df, key=["flight_id"]).orderBy("flight_id").collect()
    assert [r["prior_route_frequency"] for r in v] == [0, 1, 0, 2]
    assert [r["prior_origin_flight_volume"] for r in v] == [0, 1, 0, 2]
    assert [r["prior_origin_delay_rate"] for r in v] == [0.0, 1.0, 0.0, 0.5]


def test_rolling_window_left_closed(spark):
    rows = [("2024-01-01", 800, "AA", "JFK", "LAX", 1, 1), ("2024-01-08", 800, "AA", "JFK", "LAX", 0, 2),
            ("2024-01-08", 801, "AA", "JFK", "LAX", 1, 3), ("2024-01-20", 800, "AA", "JFK", "LAX", 1, 4)]
    df = spark.createDataFrame(rows, SCHEMA)
    for method in ("prefix", "window"):
        out = prior.prior_group_stats(df, ["airline"], days=7, method=method).orderBy("flight_id").collect()
        # flight 2 is exactly 7 days after flight 1 -> inside [T-7d, T); flight 3 one minute later -> outside
        assert [r["prior_n"] for r in out] == [0, 1, 1, 0], method


def test_latest_prior_minute_is_strictly_earlier(spark):
    df = spark.createDataFrame(CONCURRENT, SCHEMA)
    out = prior.latest_prior_minute(df, ["airline"]).orderBy("flight_id").collect()
    assert [r["latest"] is None for r in out] == [True, True, False, False]
    assert all(r["latest"] is None or r["latest"] < r["dep_minute"] for r in out)


def test_asof_join_inclusive_tolerance_and_ties(spark):
    flights = spark.createDataFrame([(1, "2024-01-01", 1000, "jfk"), (2, "2024-01-01", 1200, "JFK"),
                                     (3, "2024-01-01", 1500, "LAX"), (4, "2024-01-01", 1400, "JFK")],
                                    "flight_id int, flight_date string, scheduled_dep_time int, origin_airport string")
    weather = spark.createDataFrame(
        [(10, "JFK", "2024-01-01 08:00:00", 5.0, "rain"), (11, "JFK", "2024-01-01 10:00:00", 6.0, "clear"),
         (12, "JFK", "2024-01-01 10:00:00", 7.0, "fog"), (13, "JFK", "2024-01-01 10:01:00", 8.0, "snow"),
         (14, "LAX", "2024-01-01 12:59:00", 9.0, "clear")],
        "obs_id int, airport string, ts string, temperature double, weather_condition string"
    ).withColumn("timestamp", F.col("ts").cast("timestamp_ntz")).drop("ts")
    out = {r["flight_id"]: r for r in asof.asof_weather(flights, weather, key=["flight_id"]).collect()}
    assert out[1]["weather_origin_obs_id"] == 12      # tie at 10:00 -> larger tie key; 10:01 is after T
    assert out[2]["weather_origin_obs_id"] == 13      # 10:01 <= 12:00, exactly within 120 min
    assert out[3]["weather_origin_missing_flag"] == 1  # 12:59 is 121 minutes before 15:00
    assert out[4]["weather_origin_missing_flag"] == 1  # last JFK obs 10:01 is 239 min before
    assert out[1]["weather_origin_is_fog"] == 1 and out[1]["origin_obs_id"] == 12


def test_weather_flags_defaults_and_prefixes(spark):
    w = spark.createDataFrame([(0.0, None, 0.5, 40.0, "Clear"), (0.2, -1.0, 5.0, 5.0, "light DRIZZLE")],
                              "origin_precipitation_inches double, origin_temperature_c double, "
                              "origin_visibility_miles double, origin_wind_speed_knots double, "
                              "origin_weather_condition string")
    flags = S.weather_flag_columns(w.columns, prefixes=("", "origin_"))
    r = w.select(*[v.alias(k) for k, v in flags.items()]).collect()
    assert r[0]["is_fog"] == 1 and r[0]["is_storm"] == 1 and r[0]["is_severe_weather"] == 1
    assert r[1]["is_rain"] == 1 and r[1]["is_snow"] == 1 and r[1]["origin_is_snow"] == 1


def test_risk_tiers(spark):
    df = spark.createDataFrame([(p,) for p in [0.0, 0.29, 0.3, 0.59, 0.6, 0.79, 0.8, 1.0]], "p double")
    got = [r[0] for r in df.select(S.risk_tier(F.col("p"))).collect()]
    assert got == ["LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "VERY HIGH", "VERY HIGH"]
    with pytest.raises(Exception):
        spark.createDataFrame([(1.5,)], "p double").select(S.risk_tier(F.col("p"))).collect()


def test_feature_table_column_counts(spark):
    from conftest import SF_SMALL
    from flightops.plans import pipeline as PL
    pre = PL.pre_departure(spark, SF_SMALL)
    p3 = features.feature_table_p3(pre, ["flight_id"])
    assert len(p3.columns) == 68 + 1                    # + flight key
    a2 = features.feature_table_2a(pre, ["flight_id"])
    assert len(a2.columns) - 1 - ("same_airport_flag" in a2.columns) == 38
    assert not math.isnan(p3.agg(F.avg("prior_origin_delay_rate")).first()[0])


def test_feature_tables_with_weather(spark):
    from conftest import SF_SMALL
    from flightops.plans import pipeline as PL
    pre = PL.pre_departure(spark, SF_SMALL)
    w = PL.weather(spark, SF_SMALL)
    p3 = features.feature_table_p3(pre, ["flight_id"], weather=w)
    assert p3.count() == pre.count()
    for c in ("is_rain", "severe_weather_flag", "origin_is_fog", "weather_origin_storm_flag"):
        assert c in p3.columns
    assert p3.columns[-1] == "delay_target"
    a2 = features.feature_table_2a(pre, ["flight_id"], weather=w)
    assert a2.count() == pre.count() and "weather_origin_missing_flag" in a2.columns
    matched = a2.filter("weather_origin_missing_flag = 0").count()
    assert matched == asof.match_rate(asof.asof_weather(pre, w, key=["flight_id"])).first()["matched"]
