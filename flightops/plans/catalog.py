"""Registered queries (Spark) and their DuckDB oracles.

Each query reads the driver's tables through the derived ``flights`` /
``weather`` views, so its work grows with the data. Computed doubles are
rounded half-even (4 dp for rates and metrics, 6 dp for trigonometry) in
both engines so value hashes compare exactly.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as S
from .. import config
from ..operators import asof, clean, metrics, prior, quality, sketches, split
from ..sources import files, fixtures, ingest
from . import features, oracle
from . import pipeline as PL
from .oracle import hhmm, r2, r4, r6, sql, strip

KEY = PL.KEY
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle_sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle_sql is not None:
            ORACLES[name] = oracle_sql
        return fn
    return deco


def _r4(c):
    return S.round_half_even(c, 4)


def _r6(c):
    return S.round_half_even(c, 6)


def p3_history(spark: SparkSession, sf: str) -> DataFrame:
    return prior.history_p3(PL.pre_departure(spark, sf), key=KEY, with_aliases=False)


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """(flight_id, split, y, p) with p = strictly prior origin delay rate;
    written once per session like a model's prediction table."""
    def plan():
        pre = PL.pre_departure(spark, sf)
        sp = split.chronological_split(pre, key="flight_id").select("flight_id", "split", "delay_target")
        h = prior.history_p3(pre, key=KEY, dims=["prior_origin"]).select("flight_id", "prior_origin_delay_rate")
        return sp.join(h, "flight_id").select("flight_id", "split", F.col("delay_target").alias("y"),
                                              F.col("prior_origin_delay_rate").alias("p"))
    return PL.materialize(spark, "scored", plan, sf)


# ---------------------------------------------------------------------------
# ingestion and validation
# ---------------------------------------------------------------------------

@register("ingest_canonical", sql("SELECT * FROM canon", "canon"))
def q_ingest_canonical(spark, sf):
    return PL.canonical_flights(spark, sf)


_YMD_SPARK = """SELECT flight_id,
  CAST(year(d) AS INT) AS YEAR, CAST(month(d) AS INT) AS MONTH,
  CAST(CASE WHEN flight_id % 311 = 7 THEN 31 WHEN flight_id % 313 = 9 THEN 45 ELSE day(d) END AS INT) AS DAY,
  OP_UNIQUE_CARRIER AS AIRLINE FROM (SELECT *, try_cast(FL_DATE AS DATE) AS d FROM {v})"""
_YMD_DUCK = """SELECT flight_id, CAST(year(d) AS INTEGER) AS "YEAR", CAST(month(d) AS INTEGER) AS "MONTH",
  CAST(CASE WHEN flight_id % 311 = 7 THEN 31 WHEN flight_id % 313 = 9 THEN 45 ELSE day(d) END AS INTEGER) AS "DAY",
  "OP_UNIQUE_CARRIER" AS "AIRLINE" FROM (SELECT *, TRY_CAST("FL_DATE" AS DATE) AS d FROM raw) x"""


@register("ingest_ymd_date", sql(
    f"""SELECT flight_id, "YEAR", "MONTH", "DAY", "AIRLINE",
  strftime(TRY_CAST(CAST("YEAR" AS VARCHAR) || '-' || lpad(CAST("MONTH" AS VARCHAR), 2, '0') || '-'
    || lpad(CAST("DAY" AS VARCHAR), 2, '0') AS DATE), '%Y-%m-%d') AS flight_date
  FROM ({_YMD_DUCK}) k""", "raw"))
def q_ingest_ymd_date(spark, sf):
    raw = fixtures.raw_flights(spark, sf)
    raw.createOrReplaceTempView("_raw_ymd")
    kaggle = spark.sql(_YMD_SPARK.format(v="_raw_ymd"))
    return ingest.synthesize_date(kaggle)


@register("validate_flags", sql(
    """SELECT flight_id, flight_date, airline, origin_airport, dest_airport, scheduled_dep_time,
  scheduled_arr_time, arrival_delay, departure_delay, distance, cancelled, diverted,
  _is_duplicate, _is_cancelled, _is_diverted,
  (_is_duplicate OR _bad_date OR _bad_airport OR _bad_distance OR _bad_delay) AS _is_invalid,
  NOT (_is_duplicate OR _bad_date OR _bad_airport OR _bad_distance OR _bad_delay)
    AND NOT _is_cancelled AND NOT _is_diverted AS _is_valid_completed
  FROM flags""", "flags"))
def q_validate_flags(spark, sf):
    return quality.annotate(PL.canonical_flights(spark, sf))


@register("missing_by_column", sql(
    "SELECT column_name, CAST(missing_count AS BIGINT) AS missing_count FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count FROM canon"
                         for c in oracle.CANON_COLS) + ") m", "canon"))
def q_missing_by_column(spark, sf):
    return quality.missing_by_column(PL.canonical_flights(spark, sf))


@register("quality_summary", sql(
    """SELECT CAST(count(*) AS BIGINT) AS total_records,
  CAST(count_if(_is_duplicate) AS BIGINT) AS duplicate_records,
  CAST(count_if(_is_cancelled) AS BIGINT) AS cancelled_flights,
  CAST(count_if(_is_diverted) AS BIGINT) AS diverted_flights,
  CAST(count_if(_bad_date) AS BIGINT) AS invalid_date_records,
  CAST(count_if(_bad_airport) AS BIGINT) AS invalid_airport_records,
  CAST(count_if(_bad_distance) AS BIGINT) AS invalid_distance_records,
  CAST(count_if(_bad_delay) AS BIGINT) AS invalid_delay_records,
  CAST(count_if(_is_duplicate OR _bad_date OR _bad_airport OR _bad_distance OR _bad_delay) AS BIGINT)
    AS total_invalid_records,
  CAST(count_if(NOT (_is_duplicate OR _bad_date OR _bad_airport OR _bad_distance OR _bad_delay)
    AND NOT _is_cancelled AND NOT _is_diverted) AS BIGINT) AS total_valid_records,
  CAST(count_if(NOT (_is_duplicate OR _bad_date OR _bad_airport OR _bad_distance OR _bad_delay)
    AND NOT _is_cancelled AND NOT _is_diverted AND arrival_delay >= 15) AS BIGINT) AS delayed_flights,
  CAST(count_if(flight_date IS NULL OR airline IS NULL OR origin_airport IS NULL OR dest_airport IS NULL
    OR scheduled_dep_time IS NULL OR arrival_delay IS NULL) AS BIGINT) AS missing_required_records,
  CAST(count_if(NOT (_is_duplicate OR _bad_date OR _bad_airport OR _bad_distance OR _bad_delay)
    AND NOT _is_cancelled AND NOT _is_diverted AND NOT coalesce(arrival_delay >= 15, false)) AS BIGINT)
    AS ontime_flights,
  """ + r2("""CAST(count_if(NOT (_is_duplicate OR _bad_date OR _bad_airport OR _bad_distance OR _bad_delay)
    AND NOT _is_cancelled AND NOT _is_diverted AND arrival_delay >= 15) AS DOUBLE) * 100
    / greatest(count_if(NOT (_is_duplicate OR _bad_date OR _bad_airport OR _bad_distance OR _bad_delay)
    AND NOT _is_cancelled AND NOT _is_diverted), 1)""") + """ AS delay_rate_percent
  FROM flags""", "flags"))
def q_quality_summary(spark, sf):
    return quality.quality_summary(PL.canonical_flights(spark, sf))


@register("cohort_counts", sql(
    """SELECT CASE WHEN _is_duplicate OR _bad_date OR _bad_airport OR _bad_distance OR _bad_delay THEN 'invalid'
  WHEN _is_cancelled THEN 'cancelled' WHEN _is_diverted THEN 'diverted' ELSE 'valid' END AS cohort,
  CAST(count(*) AS BIGINT) AS records FROM flags GROUP BY 1""", "flags"))
def q_cohort_counts(spark, sf):
    return quality.cohort_counts(PL.canonical_flights(spark, sf))


@register("weather_validate", sql(
    """SELECT CAST(count(*) AS BIGINT) AS total_records,
  CAST(count_if(NOT (coalesce(regexp_full_match(trim(airport), '[A-Za-z]{3}'), false)
    AND "timestamp" IS NOT NULL AND (humidity IS NULL OR humidity BETWEEN 0 AND 100)
    AND (wind_direction IS NULL OR wind_direction BETWEEN 0 AND 360)
    AND (wind_speed IS NULL OR wind_speed >= 0))) AS BIGINT) AS invalid_rows,
  CAST(count(DISTINCT CASE WHEN regexp_full_match(trim(airport), '[A-Za-z]{3}') THEN airport END) AS BIGINT)
    AS airports_covered,
  coalesce(string_agg(DISTINCT CASE WHEN regexp_full_match(trim(airport), '[A-Za-z]{3}') THEN airport END, ','
    ORDER BY CASE WHEN regexp_full_match(trim(airport), '[A-Za-z]{3}') THEN airport END), '') AS airports,
  min("timestamp") AS min_timestamp, max("timestamp") AS max_timestamp,
  count_if(NOT (coalesce(regexp_full_match(trim(airport), '[A-Za-z]{3}'), false)
    AND "timestamp" IS NOT NULL AND (humidity IS NULL OR humidity BETWEEN 0 AND 100)
    AND (wind_direction IS NULL OR wind_direction BETWEEN 0 AND 360)
    AND (wind_speed IS NULL OR wind_speed >= 0))) = 0 AS is_valid
  FROM weather""", "weather"))
def q_weather_validate(spark, sf):
    return quality.weather_validate(PL.weather(spark, sf))


@register("temporal_violations", sql(
    f"""SELECT CAST(count_if(latest >= dep_minute) AS BIGINT) AS violations,
  CAST(count_if(latest IS NOT NULL) AS BIGINT) AS checked,
  CAST(max(CASE WHEN latest >= dep_minute THEN latest END) AS BIGINT) AS max_offending
  FROM (SELECT dep_minute, CASE WHEN flight_id % 397 = 2 THEN dep_minute + 5 ELSE
    {oracle.window_prior('max(dep_minute)', ['origin_airport'])} END AS latest FROM timed) x""",
    "timed"))
def q_temporal_violations(spark, sf):
    """V13 on history minutes of which some are planted after their prediction."""
    pre = prior.with_departure_minute(PL.pre_departure(spark, sf))
    latest = prior.latest_prior_minute(pre, ["origin_airport"]).withColumn(
        "latest", F.when(F.col("flight_id") % 397 == 2, F.col(prior.T) + 5).otherwise(F.col("latest")))
    bad = quality.temporal_violations(latest, "latest", prior.T)
    n = latest.agg(F.count_if(F.col("latest").isNotNull()).cast("long").alias("checked"))
    return (bad.crossJoin(F.broadcast(n))  # one row each
            .select("violations", "checked", F.col("max_offending_ts").cast("long").alias("max_offending")))


@register("population_alignment", sql(
    """SELECT CAST(0 AS BIGINT) AS only_in_b, CAST(count_if(flight_id % 401 = 3) AS BIGINT) AS only_in_a,
  CAST(count(*) AS BIGINT) AS rows_a, CAST(count_if(flight_id % 401 <> 3) AS BIGINT) AS rows_b,
  CAST(count_if(flight_id % 401 <> 3 AND flight_id % 389 = 1) AS BIGINT) AS diff_delay_target, CAST(0 AS BIGINT) AS diff_flight_date,
  CAST(count_if(flight_id % 401 <> 3 AND flight_id % 383 = 7) AS BIGINT) AS diff_scheduled_dep_time FROM pre""", "pre"))
def q_population_alignment(spark, sf):
    """V14 on the 2A table and a P3 table with planted gaps and changes."""
    pre = PL.pre_departure(spark, sf)
    a = features.base_features_2a(pre, KEY, same_airport=False)
    b = features.base_features_p3(pre).where("flight_id % 401 <> 3").withColumns({
        "delay_target": F.when(F.col("flight_id") % 389 == 1, 1 - F.col("delay_target")).otherwise(F.col("delay_target")),
        "scheduled_dep_time": F.when(F.col("flight_id") % 383 == 7, F.col("scheduled_dep_time") + 1).otherwise(F.col("scheduled_dep_time"))})
    return quality.population_alignment(a, b, KEY, ["delay_target", "flight_date", "scheduled_dep_time"])


# ---------------------------------------------------------------------------
# cleaning
# ---------------------------------------------------------------------------

@register("clean_operational", sql("SELECT * FROM clean", "clean"))
def q_clean_operational(spark, sf):
    return PL.cleaned_flights(spark, sf)


@register("delay_target", sql(
    "SELECT flight_id, arrival_delay, CAST(coalesce(CAST(arrival_delay >= 15 AS INTEGER), 0) AS INTEGER)"
    " AS delay_target FROM canon", "canon"))
def q_delay_target(spark, sf):
    c = PL.canonical_flights(spark, sf)
    return c.select("flight_id", "arrival_delay", clean.delay_target(F.col("arrival_delay")).alias("delay_target"))


@register("pre_departure_view", sql("SELECT * FROM pre", "pre"))
def q_pre_departure(spark, sf):
    return PL.pre_departure(spark, sf, written=False)


# ---------------------------------------------------------------------------
# scalar features
# ---------------------------------------------------------------------------

_H, _M = hhmm("scheduled_dep_time")


@register("hhmm_parse", sql(
    f"SELECT flight_id, scheduled_dep_time, {_H} AS hour, {_M} AS minute, {_H} * 60 + {_M} AS minutes_since_midnight"
    " FROM canon", "canon"))
def q_hhmm_parse(spark, sf):
    c = PL.canonical_flights(spark, sf)
    h, m, s = S.hhmm_parts(F.col("scheduled_dep_time"))
    return c.select("flight_id", "scheduled_dep_time", h.alias("hour"), m.alias("minute"),
                    s.alias("minutes_since_midnight"))


def _tod_sql(h: str, labels=("overnight", "morning", "afternoon", "evening")) -> str:
    n, mo, af, ev = labels
    return (f"CASE WHEN {h} >= 22 OR {h} < 6 THEN '{n}' WHEN {h} < 12 THEN '{mo}' "
            f"WHEN {h} < 18 THEN '{af}' ELSE '{ev}' END")


def _bucket_sql(h: str) -> str:
    return ("CASE " + " ".join(f"WHEN {h} >= {4 * i} AND {h} < {4 * i + 4} THEN '{4 * i:02d}-{4 * i + 4:02d}'"
                               for i in range(6)) + " ELSE '08-12' END")


@register("time_features_2a", sql(
    f"""SELECT flight_id, dep_hour AS departure_hour, dep_min AS departure_minute,
  dep_hour * 60 + dep_min AS departure_minutes_since_midnight, {_tod_sql('dep_hour')} AS time_of_day,
  arr_hour AS arrival_hour, arr_min AS arrival_minute, arr_hour * 60 + arr_min AS arrival_minutes_since_midnight
  FROM timed""", "timed"))
def q_time_features_2a(spark, sf):
    pre = PL.pre_departure(spark, sf)
    x = pre.withColumns(S.departure_columns()).withColumns(S.arrival_columns())
    return x.select("flight_id", "departure_hour", "departure_minute", "departure_minutes_since_midnight",
                    "time_of_day", "arrival_hour", "arrival_minute", "arrival_minutes_since_midnight")


@register("calendar_features", sql(
    """SELECT flight_id, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
  CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) - 1 AS INTEGER) AS day_of_week,
  CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(dayofyear(d) AS INTEGER) AS day_of_year,
  CAST(isodow(d) >= 6 AS INTEGER) AS is_weekend
  FROM (SELECT flight_id, CAST(flight_date AS DATE) AS d FROM pre) x""", "pre"))
def q_calendar(spark, sf):
    return PL.pre_departure(spark, sf).select("flight_id", *[v.alias(k) for k, v in S.calendar_columns().items()])


@register("cyclical_features", sql(
    f"""SELECT flight_id,
  {r6('sin(2 * pi() * dep_hour / 24.0)')} AS departure_hour_sin, {r6('cos(2 * pi() * dep_hour / 24.0)')} AS departure_hour_cos,
  {r6('sin(2 * pi() * (isodow(d) - 1) / 7.0)')} AS day_of_week_sin, {r6('cos(2 * pi() * (isodow(d) - 1) / 7.0)')} AS day_of_week_cos,
  {r6('sin(2 * pi() * (month(d) - 1) / 12.0)')} AS month_sin, {r6('cos(2 * pi() * (month(d) - 1) / 12.0)')} AS month_cos
  FROM (SELECT *, CAST(flight_date AS DATE) AS d FROM timed) x""", "timed"))
def q_cyclical(spark, sf):
    x = PL.pre_departure(spark, sf).withColumns(S.calendar_columns()).withColumns(S.departure_columns())
    cyc = S.cyclical_columns()
    return x.select("flight_id", *[_r6(v).alias(k) for k, v in cyc.items()])


_HAUL2A = ("CASE WHEN distance < 500 THEN 'short_haul' WHEN distance <= 1500 THEN 'medium_haul' "
           "WHEN distance > 1500 THEN 'long_haul' ELSE 'medium_haul' END")


@register("route_features_2a", sql(
    f"SELECT flight_id, route, distance, {_HAUL2A} AS haul_category FROM timed", "timed"))
def q_route_2a(spark, sf):
    pre = PL.pre_departure(spark, sf)
    return pre.select("flight_id", S.route().alias("route"), S.to_double(F.col("distance")).alias("distance"),
                      S.haul_2a(F.col("distance")).alias("haul_category"))


@register("same_airport_audit", sql(
    """SELECT CAST(min(s) AS INTEGER) AS min_same, CAST(max(s) AS INTEGER) AS max_same,
  coalesce(min(s) <> max(s), false) AS emitted
  FROM (SELECT CAST(origin_airport = dest_airport AS INTEGER) AS s FROM pre) x""", "pre"))
def q_same_airport(spark, sf):
    pre = PL.pre_departure(spark, sf)
    same = (S.std_code(F.col("origin_airport")) == S.std_code(F.col("dest_airport"))).cast("int")
    return pre.agg(F.min(same).alias("min_same"), F.max(same).alias("max_same")).withColumn(
        "emitted", F.coalesce(F.col("min_same") != F.col("max_same"), F.lit(False)))


@register("date_features_p3", sql(
    """SELECT flight_id, CAST(day(d) = 1 AS INTEGER) AS is_month_start,
  CAST(d = last_day(d) AS INTEGER) AS is_month_end, CAST(quarter(d) AS INTEGER) AS quarter,
  CASE WHEN month(d) IN (12, 1, 2) THEN 'winter' WHEN month(d) IN (3, 4, 5) THEN 'spring'
       WHEN month(d) IN (6, 7, 8) THEN 'summer' ELSE 'fall' END AS season
  FROM (SELECT flight_id, CAST(flight_date AS DATE) AS d FROM pre) x""", "pre"))
def q_date_p3(spark, sf):
    return PL.pre_departure(spark, sf).select("flight_id", *[v.alias(k) for k, v in S.date_p3_columns().items()])


@register("time_features_p3", sql(
    f"""SELECT flight_id, {_tod_sql('dep_hour', ('night', 'morning', 'afternoon', 'evening'))} AS dep_time_of_day,
  {_bucket_sql('dep_hour')} AS dep_time_bucket,
  {r6('sin(2 * pi() * dep_min / 60.0)')} AS dep_minute_sin, {r6('cos(2 * pi() * dep_min / 60.0)')} AS dep_minute_cos,
  {_tod_sql('arr_hour', ('night', 'morning', 'afternoon', 'evening'))} AS arr_time_of_day,
  {_bucket_sql('arr_hour')} AS arr_time_bucket,
  {r6('sin(2 * pi() * arr_hour / 24.0)')} AS arr_hour_sin, {r6('cos(2 * pi() * arr_hour / 24.0)')} AS arr_hour_cos
  FROM timed""", "timed"))
def q_time_p3(spark, sf):
    pre = PL.pre_departure(spark, sf)
    return pre.select("flight_id", *[v.alias(k) for k, v in S.time_p3_columns(pre.columns).items()])


_DIST_INT = "coalesce(TRY_CAST(trunc(TRY_CAST(distance AS DOUBLE)) AS INTEGER), 0)"
_HAUL_P3 = (f"CASE WHEN {_DIST_INT} < 500 THEN 'short_haul' WHEN {_DIST_INT} < 1500 THEN 'medium_haul' "
            "ELSE 'long_haul' END")


@register("route_features_p3", sql(
    f"SELECT flight_id, route, {_DIST_INT} AS route_distance, {_HAUL_P3} AS route_distance_category, "
    f"{_HAUL_P3} AS distance_category FROM timed", "timed"))
def q_route_p3(spark, sf):
    return features.base_features_p3(PL.pre_departure(spark, sf)).select(
        "flight_id", "route", "route_distance", "route_distance_category", "distance_category")


@register("distance_summary", sql(
    f"""SELECT min(rd) AS min_distance, max(rd) AS max_distance,
  CAST(quantile_cont(rd, 0.5) AS DOUBLE) AS median_distance,
  CAST(count_if(distance IS NULL) AS BIGINT) AS missing_distance
  FROM (SELECT distance, {_DIST_INT} AS rd FROM pre) x""", "pre"))
def q_distance_summary(spark, sf):
    pre = PL.pre_departure(spark, sf)
    rd = S.route_distance_int(F.col("distance"))
    return pre.agg(F.min(rd).alias("min_distance"), F.max(rd).alias("max_distance"),
                   F.percentile(rd, 0.5).alias("median_distance"),
                   F.count_if(F.col("distance").isNull()).cast("long").alias("missing_distance"))


@register("departure_minute", sql("SELECT flight_id, dep_minute FROM timed", "timed"))
def q_departure_minute(spark, sf):
    return PL.pre_departure(spark, sf).select("flight_id", S.departure_minute())


_WFLAGS = {
    "rain": "(precipitation > 0 OR regexp_matches(lower(weather_condition), 'rain|drizzle|shwr'))",
    "snow": "(regexp_matches(lower(weather_condition), 'snow|blizzard|sleet|wintry') "
            "OR (temperature <= 0 AND precipitation > 0))",
    "fog": "(visibility < 1 OR regexp_matches(lower(weather_condition), 'fog|mist|haze'))",
    "storm": "(regexp_matches(lower(weather_condition), 'storm|thunder|tstm|squall') OR wind_speed > 35)",
    "low_visibility": "(visibility < 3)",
}
_WFLAGS["severe_weather"] = (f"({_WFLAGS['storm']} OR {_WFLAGS['snow']} OR {_WFLAGS['low_visibility']} "
                             "OR wind_speed > 30)")


@register("weather_flags", sql(
    "SELECT obs_id, " + ", ".join(f"CAST({e} AS INTEGER) AS is_{k}, CAST({e} AS INTEGER) AS {k}_flag"
                                  for k, e in _WFLAGS.items()) + " FROM weather", "weather"))
def q_weather_flags(spark, sf):
    w = PL.weather(spark, sf)
    flags = S.weather_flag_columns(w.columns)
    return w.select("obs_id", *[v.alias(k) for k, v in flags.items()])


@register("risk_tiers", sql(
    """SELECT flight_id, p, CASE WHEN p < 0.3 THEN 'LOW' WHEN p < 0.6 THEN 'MEDIUM' WHEN p < 0.8 THEN 'HIGH'
  ELSE 'VERY HIGH' END AS risk_level FROM scored""", "scored"))
def q_risk_tiers(spark, sf):
    s = scored(spark, sf)
    return s.select("flight_id", "p", S.risk_tier(F.col("p")).alias("risk_level"))


# ---------------------------------------------------------------------------
# point-in-time history
# ---------------------------------------------------------------------------

@register("prior_group_stats", sql(
    f"""SELECT flight_id, CAST({oracle.window_prior('count(*)', ['origin_airport'])} AS BIGINT) AS prior_n,
  CAST(coalesce({oracle.window_prior('sum(delay_target)', ['origin_airport'])}, 0) AS DOUBLE) AS prior_s
  FROM timed""", "timed"))
def q_prior_group_stats(spark, sf):
    out = prior.prior_group_stats(PL.pre_departure(spark, sf), ["origin_airport"])
    return out.select("flight_id", "prior_n", "prior_s")


@register("prior_rolling_7d", sql(
    f"""SELECT flight_id,
  CAST({oracle.window_prior('count(*)', ['origin_airport'], '10080 PRECEDING')} AS BIGINT) AS prior_n,
  CAST(coalesce({oracle.window_prior('sum(delay_target)', ['origin_airport'], '10080 PRECEDING')}, 0) AS DOUBLE)
    AS prior_s FROM timed""", "timed"))
def q_prior_rolling_7d(spark, sf):
    out = prior.prior_group_stats(PL.pre_departure(spark, sf), ["origin_airport"], days=7)
    return out.select("flight_id", "prior_n", "prior_s")


#: Minutes from departure until a flight's delay is known, in the queries of published history.
LAG = 180


@register("prior_published_7d", sql(
    f"""SELECT flight_id,
  CAST({oracle.window_prior('count(*)', ['origin_airport'], '10080 PRECEDING', LAG)} AS BIGINT) AS prior_n,
  CAST(coalesce({oracle.window_prior('sum(delay_target)', ['origin_airport'], '10080 PRECEDING', LAG)}, 0) AS DOUBLE)
    AS prior_s FROM timed""", "timed"))
def q_prior_published_7d(spark, sf):
    """History of the last seven days as far as it was known: outcomes are published LAG minutes after departure."""
    out = prior.prior_group_stats(PL.pre_departure(spark, sf), ["origin_airport"], days=7, availability_lag_minutes=LAG)
    return out.select("flight_id", "prior_n", "prior_s")


@register("history_published_p3", sql(oracle.lagged_history(oracle.P3_DIMS, LAG), "timed"))
def q_history_published_p3(spark, sf):
    """All P3 dimensions and the fallback rate over published outcomes only."""
    h = prior.history_p3(PL.pre_departure(spark, sf), key=KEY, with_aliases=False, availability_lag_minutes=LAG)
    return h.select("flight_id", *[f"{d}_{m}" for d, _ in prior.P3_DIMENSIONS for m in ("flight_count", "delay_rate")])


@register("history_published_2a", sql(oracle.lagged_history(oracle.A2_DIMS, LAG, fallback="g"), "timed"))
def q_history_published_2a(spark, sf):
    """H5 over published outcomes only."""
    h = prior.history_2a(PL.pre_departure(spark, sf), key=KEY, availability_lag_minutes=LAG)
    return h.select("flight_id", *[c for c in h.columns if c.startswith("historical_")])


@register("prior_global_rate", sql(
    f"SELECT dep_minute, {r4('g')} AS global_prior_rate FROM gprior", "gprior"))
def q_prior_global_rate(spark, sf):
    g = prior.global_prior_rate(PL.pre_departure(spark, sf))
    return g.select(prior.T, _r4(F.col("global_prior_rate")).alias("global_prior_rate"))


def _a2_sql(min_history: int = 3, fallback: str = "g") -> str:
    parts = []
    for name, keys in oracle.A2_DIMS:
        n = oracle.window_prior("count(*)", keys)
        s = f"coalesce({oracle.window_prior('sum(delay_target)', keys)}, 0)"
        parts.append(f"{r4(f'CASE WHEN {n} >= {min_history} THEN CAST({s} AS DOUBLE) / {n} ELSE {fallback} END')}"
                     f" AS {name}_delay_rate")
        parts.append(f"CAST({n} AS INTEGER) AS {name}_flight_count")
    return "SELECT flight_id, " + ", ".join(parts) + " FROM timed t JOIN gprior USING (dep_minute)"


@register("history_features_2a", sql(_a2_sql(), "timed", "gprior"))
def q_history_2a(spark, sf):
    h = prior.history_2a(PL.pre_departure(spark, sf), key=KEY)
    return h.select("flight_id", *[c for c in h.columns if c.startswith("historical_")])


@register("history_fallback_modes", sql(
    "SELECT a.*, b.* EXCLUDE (flight_id) FROM ("
    + _a2_sql(1, "NULL").replace("AS historical_", "AS nan_historical_") + ") a JOIN ("
    + _a2_sql(5, "0.25").replace("AS historical_", "AS const_historical_") + ") b USING (flight_id)",
    "timed", "gprior"))
def q_history_fallback_modes(spark, sf):
    pre = PL.pre_departure(spark, sf)
    a = prior.history_2a(pre, key=KEY, min_history=1, fallback="nan")
    b = prior.history_2a(pre, key=KEY, min_history=5, fallback="0.25")
    ca = [F.col(c).alias(f"nan_{c}") for c in a.columns if c.startswith("historical_")]
    cb = [F.col(c).alias(f"const_{c}") for c in b.columns if c.startswith("historical_")]
    return a.select("flight_id", *ca).join(b.select("flight_id", *cb), "flight_id")


_P3_COLS = [f"{n}_{m}" for n, _ in oracle.P3_DIMS for m in ("flight_count", "delay_count", "delay_rate")]


@register("history_features_p3", sql("SELECT flight_id, " + ", ".join(_P3_COLS) + " FROM hist3", "hist3"))
def q_history_p3(spark, sf):
    return p3_history(spark, sf).select("flight_id", *_P3_COLS)


@register("history_aliases_p3", sql(
    "SELECT flight_id, " + ", ".join(f"{src} AS {a}" for a, src in prior.P3_ALIASES) + " FROM hist3", "hist3"))
def q_history_aliases(spark, sf):
    h = prior.history_p3(PL.pre_departure(spark, sf), key=KEY, with_aliases=True)
    return h.select("flight_id", *[a for a, _ in prior.P3_ALIASES])


@register("history_coverage", sql(
    "SELECT dimension, CAST(count(*) AS BIGINT) AS total_records, "
    "CAST(count_if(n = 0) AS BIGINT) AS no_history_count, "
    "CAST(count_if(n > 0 AND n < 3) AS BIGINT) AS insufficient_history_count, "
    "CAST(count_if(n >= 3) AS BIGINT) AS sufficient_history_count, "
    + ", ".join(r2(f"CAST(count_if({c}) AS DOUBLE) * 100 / greatest(count(*), 1)") + f" AS {k}_pct"
                for k, c in [("no_history", "n = 0"), ("insufficient_history", "n > 0 AND n < 3"),
                             ("sufficient_history", "n >= 3")])
    + " FROM (" + " UNION ALL ".join(f"SELECT '{d}' AS dimension, {d}_flight_count AS n FROM hist3"
                                    for d, _ in oracle.P3_DIMS) + ") u GROUP BY dimension", "hist3"))
def q_history_coverage(spark, sf):
    return prior.coverage(p3_history(spark, sf))


def _vol_sql() -> str:
    def n(k):
        return oracle.window_prior("count(*)", [k])

    def s(k):
        return f"coalesce({oracle.window_prior('sum(delay_target)', [k])}, 0)"
    rate = {k: r4(f"CASE WHEN {n(k)} > 0 THEN CAST({s(k)} AS DOUBLE) / {n(k)} ELSE 0.0 END")
            for k in ("origin_airport", "dest_airport")}
    return (f"SELECT flight_id, {n('route')} AS prior_route_frequency, {n('origin_airport')} AS "
            f"prior_origin_flight_volume, {n('dest_airport')} AS prior_dest_flight_volume, "
            f"{rate['origin_airport']} AS prior_origin_delay_rate, {rate['dest_airport']} AS prior_dest_delay_rate "
            "FROM timed")


@register("prior_volumes", sql(
    "SELECT flight_id, prior_route_frequency, prior_origin_flight_volume, prior_dest_flight_volume FROM ("
    + _vol_sql() + ") v", "timed"))
def q_prior_volumes(spark, sf):
    v = prior.prior_volumes(PL.pre_departure(spark, sf), key=KEY)
    return v.select("flight_id", "prior_route_frequency", "prior_origin_flight_volume", "prior_dest_flight_volume")


@register("prior_airport_rate_raw", sql(
    "SELECT flight_id, prior_origin_delay_rate, prior_dest_delay_rate FROM (" + _vol_sql() + ") v", "timed"))
def q_prior_airport_rate_raw(spark, sf):
    v = prior.prior_volumes(PL.pre_departure(spark, sf), key=KEY)
    return v.select("flight_id", "prior_origin_delay_rate", "prior_dest_delay_rate")


# ---------------------------------------------------------------------------
# as-of weather join
# ---------------------------------------------------------------------------

_MEASURES = ["temperature", "humidity", "wind_speed", "wind_direction", "precipitation", "visibility", "pressure", "cloud_cover"]


def _asof_sql(airport: str, prefix: str, lag: int = 0) -> str:
    """Every column that the join carries, and the indicators of the observation."""
    carried = ", ".join(f"{r4(f'w.{c}')} AS {prefix}{c}" for c in _MEASURES)
    flags = ", ".join(f"CASE WHEN w.obs_id IS NOT NULL THEN CAST({e} AS INTEGER) END AS {prefix}{form.format(k)}"
                      for k, e in _WFLAGS.items() for form in ("is_{}", "{}_flag"))
    return f"""SELECT f.flight_id, w.obs_id AS {prefix}obs_id, {carried}, w.weather_condition AS {prefix}weather_condition, {flags},
  CASE WHEN w.obs_id IS NULL THEN 1 ELSE 0 END AS {prefix}missing_flag
  FROM timed f LEFT JOIN (
    SELECT flight_id AS fid, * EXCLUDE (flight_id, rn) FROM (
      SELECT f2.flight_id, w2.*, row_number() OVER (PARTITION BY f2.flight_id
             ORDER BY epoch_us(w2."timestamp") DESC, w2.obs_id DESC) AS rn
      FROM timed f2 JOIN weather w2 ON w2.airport = f2.{airport}
       AND epoch_us(w2."timestamp") + {lag} * 60000000 <= f2.dep_minute * 60000000
       AND f2.dep_minute * 60000000 - epoch_us(w2."timestamp") <= CAST(7200000000 AS BIGINT)) c WHERE rn = 1
  ) w ON w.fid = f.flight_id"""


def _carried(j: DataFrame, p: str) -> DataFrame:
    flags = [f"{p}{form.format(k)}" for k in _WFLAGS for form in ("is_{}", "{}_flag")]
    return j.select("flight_id", f"{p}obs_id", *[_r4(F.col(f"{p}{c}")).alias(f"{p}{c}") for c in _MEASURES],
                    f"{p}weather_condition", *flags, f"{p}missing_flag")


@register("weather_asof_join", sql(_asof_sql("origin_airport", "weather_origin_"), "timed", "weather"))
def q_weather_asof(spark, sf):
    return _carried(asof.asof_weather(PL.pre_departure(spark, sf), PL.weather(spark, sf), key=KEY), "weather_origin_")


@register("weather_asof_dest", sql(_asof_sql("dest_airport", "weather_dest_"), "timed", "weather"))
def q_weather_asof_dest(spark, sf):
    return _carried(asof.asof_weather(PL.pre_departure(spark, sf), PL.weather(spark, sf), key=KEY,
                                      airport_col="dest_airport", prefix="weather_dest_"), "weather_dest_")


@register("weather_asof_lag", sql(_asof_sql("origin_airport", "weather_origin_", lag=30), "timed", "weather"))
def q_weather_asof_lag(spark, sf):
    """Observations that are published half an hour after they are made."""
    return _carried(asof.asof_weather(PL.pre_departure(spark, sf), PL.weather(spark, sf), key=KEY,
                                      availability_lag_minutes=30), "weather_origin_")


@register("weather_match_rate", sql(
    "SELECT CAST(count(*) AS BIGINT) AS flights, CAST(count_if(weather_origin_missing_flag = 0) AS BIGINT) AS matched, "
    + r4("avg(1 - weather_origin_missing_flag)") + " AS match_rate FROM ("
    + _asof_sql("origin_airport", "weather_origin_") + ") j", "timed", "weather"))
def q_weather_match_rate(spark, sf):
    j = asof.asof_weather(PL.pre_departure(spark, sf), PL.weather(spark, sf), key=KEY)
    return asof.match_rate(j)


# ---------------------------------------------------------------------------
# chronological split
# ---------------------------------------------------------------------------

@register("chrono_split", sql("SELECT flight_id, split FROM splitp", "splitp"))
def q_chrono_split(spark, sf):
    return split.chronological_split(PL.pre_departure(spark, sf), key="flight_id").select("flight_id", "split")


@register("split_summary", sql(
    """SELECT split, CAST(count(*) AS BIGINT) AS records, min(flight_date) AS min_date, max(flight_date) AS max_date,
  """ + r2("avg(CAST(delay_target AS DOUBLE)) * 100") + """ AS delay_rate_pct,
  """ + r2("CAST(count(*) AS DOUBLE) * 100 / sum(count(*)) OVER ()") + """ AS pct
  FROM splitp GROUP BY split""", "splitp"))
def q_split_summary(spark, sf):
    return split.split_summary(split.chronological_split(PL.pre_departure(spark, sf), key="flight_id"))


# ---------------------------------------------------------------------------
# evaluation metrics on the deterministic score
# ---------------------------------------------------------------------------

_CM = """CAST(count_if(y = 0 AND p < {t}) AS BIGINT) AS tn, CAST(count_if(y = 0 AND p >= {t}) AS BIGINT) AS fp,
  CAST(count_if(y = 1 AND p < {t}) AS BIGINT) AS fn, CAST(count_if(y = 1 AND p >= {t}) AS BIGINT) AS tp"""


def _rates_sql(src: str) -> str:
    def d(a, b):
        return f"coalesce(CAST({a} AS DOUBLE) / nullif({b}, 0), 0.0)"
    return (f"SELECT *, {r4(d('tp + tn', 'tn + fp + fn + tp'))} AS accuracy, {r4(d('tp', 'tp + fp'))} AS precision, "
            f"{r4(d('tp', 'tp + fn'))} AS recall, {r4(d('2 * tp', '2 * tp + fp + fn'))} AS f1, "
            f"{r4('(' + d('tp', 'tp + fn') + ' + ' + d('tn', 'tn + fp') + ') / 2')} AS balanced_accuracy "
            f"FROM ({src}) c")


@register("confusion", sql("SELECT split, " + _CM.format(t=0.5) + " FROM scored GROUP BY split", "scored"))
def q_confusion(spark, sf):
    return metrics.confusion(scored(spark, sf), threshold=0.5, groups=["split"])


@register("class_metrics", sql(
    _rates_sql("SELECT split, CAST(count(*) AS BIGINT) AS n_samples, CAST(sum(y) AS BIGINT) AS n_positive, "
               + _CM.format(t=0.5) + ", " + r4("avg((p - y) * (p - y))") + " AS brier_score, CAST(0.5 AS DOUBLE) AS threshold "
               "FROM scored GROUP BY split"), "scored"))
def q_class_metrics(spark, sf):
    return metrics.class_metrics(scored(spark, sf), threshold=0.5, groups=["split"])


_AUC = """SELECT split, CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN
  {r} ELSE 0.5 END AS roc_auc FROM (
  SELECT split, s, pos, neg, coalesce(sum(neg) OVER (PARTITION BY split ORDER BY s
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lt_neg
  FROM (SELECT split, p AS s, count_if(y = 1) AS pos, count_if(y <> 1) AS neg FROM scored GROUP BY split, p) a) b
  GROUP BY split"""


@register("roc_auc", sql(_AUC.format(
    r=r4("sum(pos * (lt_neg + 0.5 * neg)) / (CAST(sum(pos) AS DOUBLE) * sum(neg))")), "scored"))
def q_roc_auc(spark, sf):
    return metrics.roc_auc(scored(spark, sf), groups=["split"])


_AP = """SELECT split, CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN
  {r} ELSE {r_base} END AS pr_auc FROM (
  SELECT split, s, pos, neg,
    sum(pos) OVER (PARTITION BY split ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp_ge,
    sum(pos + neg) OVER (PARTITION BY split ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n_ge,
    sum(pos) OVER (PARTITION BY split) AS P
  FROM (SELECT split, p AS s, count_if(y = 1) AS pos, count_if(y <> 1) AS neg FROM scored GROUP BY split, p) a) b
  GROUP BY split"""


@register("average_precision", sql(_AP.format(
    r=r4("sum(CASE WHEN pos > 0 THEN CAST(pos AS DOUBLE) / P * tp_ge / n_ge ELSE 0 END)"),
    r_base=r4("CAST(sum(pos) AS DOUBLE) / greatest(sum(pos + neg), 1)")), "scored"))
def q_average_precision(spark, sf):
    return metrics.average_precision(scored(spark, sf), groups=["split"])


def _sweep_sql(ths: list[float]) -> str:
    vals = ", ".join(f"({t})" for t in ths)
    src = ("SELECT s.split, CAST(t.threshold AS DOUBLE) AS threshold, " + _CM.format(t="t.threshold")
           + f" FROM scored s JOIN (VALUES {vals}) t(threshold) ON true GROUP BY s.split, t.threshold")
    return _rates_sql(src)


@register("threshold_sweep", sql(_sweep_sql([0.3, 0.4, 0.5, 0.6, 0.7]), "scored"))
def q_threshold_sweep(spark, sf):
    return metrics.threshold_sweep(scored(spark, sf), groups=["split"])


_FINE = [0.30, 0.35, 0.40, 0.45, 0.50, 0.55, 0.60, 0.65, 0.70]


@register("threshold_sweep_fine", sql(_sweep_sql(_FINE), "scored"))
def q_threshold_sweep_fine(spark, sf):
    return metrics.threshold_sweep(scored(spark, sf), thresholds=_FINE, groups=["split"])


@register("best_threshold", sql(
    "SELECT split, first(threshold ORDER BY f1 DESC, threshold ASC) AS best_threshold, max(f1) AS best_f1 FROM ("
    + _sweep_sql([0.3, 0.4, 0.5, 0.6, 0.7]) + ") w GROUP BY split", "scored"))
def q_best_threshold(spark, sf):
    return metrics.best_threshold(metrics.threshold_sweep(scored(spark, sf), groups=["split"]), groups=["split"])


@register("calibration", sql(
    "SELECT split, CASE WHEN p <= 0.2 THEN 0 WHEN p <= 0.4 THEN 1 WHEN p <= 0.6000000000000001 THEN 2 "
    "WHEN p <= 0.8 THEN 3 ELSE 4 END AS bin, CAST(count(*) AS BIGINT) AS n, "
    + r4("avg(CAST(y AS DOUBLE))") + " AS fraction_of_positives, " + r4("avg(p)")
    + " AS mean_predicted_value FROM scored GROUP BY 1, 2", "scored"))
def q_calibration(spark, sf):
    return metrics.calibration(scored(spark, sf), groups=["split"])


@register("roc_points", sql(
    f"""SELECT split, s AS threshold, {r4('coalesce(CAST(fp AS DOUBLE) / nullif(N, 0), 0.0)')} AS fpr,
  {r4('coalesce(CAST(tp AS DOUBLE) / nullif(P, 0), 0.0)')} AS tpr,
  {r4('coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 1.0)')} AS precision,
  {r4('coalesce(CAST(tp AS DOUBLE) / nullif(P, 0), 0.0)')} AS recall FROM (
  SELECT split, s,
    sum(pos) OVER (PARTITION BY split ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
    sum(neg) OVER (PARTITION BY split ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
    sum(pos) OVER (PARTITION BY split) AS P, sum(neg) OVER (PARTITION BY split) AS N
  FROM (SELECT split, p AS s, count_if(y = 1) AS pos, count_if(y <> 1) AS neg FROM scored GROUP BY split, p) a) b""",
    "scored"))
def q_roc_points(spark, sf):
    return metrics.curve_points(scored(spark, sf), groups=["split"])


# ---------------------------------------------------------------------------
# feature tables
# ---------------------------------------------------------------------------

def p3_features(spark: SparkSession, sf: str) -> DataFrame:
    """The P3 feature table, written once per session (EDA reads it)."""
    return PL.materialize(spark, "p3_features", lambda: features.feature_table_p3(PL.pre_departure(spark, sf), KEY), sf)


@register("feature_table_p3", sql("SELECT * FROM p3", "p3"))
def q_feature_table_p3(spark, sf):
    return features.feature_table_p3(PL.pre_departure(spark, sf), KEY)


_CYC = ["departure_hour_sin", "departure_hour_cos", "day_of_week_sin", "day_of_week_cos", "month_sin", "month_cos"]
_A2_HIST = [f"{n}_{m}" for n, _ in oracle.A2_DIMS for m in ("delay_rate", "flight_count")]


@register("feature_table_2a", sql(
    f"""SELECT t.flight_id, t.flight_date, t.airline, t.origin_airport, t.dest_airport,
  CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
  CAST(isodow(d) - 1 AS INTEGER) AS day_of_week, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
  CAST(dayofyear(d) AS INTEGER) AS day_of_year, CAST(isodow(d) >= 6 AS INTEGER) AS is_weekend,
  t.scheduled_dep_time, t.dep_hour AS departure_hour, t.dep_min AS departure_minute,
  t.dep_hour * 60 + t.dep_min AS departure_minutes_since_midnight, {_tod_sql('t.dep_hour')} AS time_of_day,
  t.scheduled_arr_time, t.arr_hour AS arrival_hour, t.arr_min AS arrival_minute,
  t.arr_hour * 60 + t.arr_min AS arrival_minutes_since_midnight,
  {r6('sin(2 * pi() * t.dep_hour / 24.0)')} AS departure_hour_sin, {r6('cos(2 * pi() * t.dep_hour / 24.0)')} AS departure_hour_cos,
  {r6('sin(2 * pi() * (isodow(d) - 1) / 7.0)')} AS day_of_week_sin, {r6('cos(2 * pi() * (isodow(d) - 1) / 7.0)')} AS day_of_week_cos,
  {r6('sin(2 * pi() * (month(d) - 1) / 12.0)')} AS month_sin, {r6('cos(2 * pi() * (month(d) - 1) / 12.0)')} AS month_cos,
  t.route, CAST(t.origin_airport = t.dest_airport AS INTEGER) AS same_airport_flag,
  t.distance, {_HAUL2A.replace('distance', 't.distance')} AS haul_category,
  {', '.join('h.' + c for c in _A2_HIST)}, t.delay_target
  FROM (SELECT *, CAST(flight_date AS DATE) AS d FROM timed) t JOIN ({_a2_sql()}) h USING (flight_id)""",
    "timed", "gprior"))
def q_feature_table_2a(spark, sf):
    t = features.feature_table_2a(PL.pre_departure(spark, sf), KEY)
    return t.withColumns({c: _r6(F.col(c)) for c in _CYC})


# ---------------------------------------------------------------------------
# profiling (A1-A32) on the P3 feature table
# ---------------------------------------------------------------------------

from ..operators import profile as PR  # noqa: E402

_NUMERIC_TYPES = ("TINYINT", "SMALLINT", "INTEGER", "BIGINT", "HUGEINT", "FLOAT", "DOUBLE", "DECIMAL")


_KINDS_SQL = """CASE WHEN v = 'VARCHAR' THEN 'string' WHEN v = 'INTEGER' THEN 'int' ELSE lower(v) END"""


@register("eda_overview", sql(
    f"""SELECT r.total_records, r.duplicate_rows, c.total_features, c.numeric_columns, c.categorical_columns, c.dtypes FROM
  (SELECT CAST(count(*) AS BIGINT) AS total_records, CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * EXCLUDE (flight_id)
     FROM p3) d) AS BIGINT) AS duplicate_rows FROM p3) r,
  (SELECT sum(n) AS total_features, sum(n) FILTER (k <> 'string') AS numeric_columns, sum(n) FILTER (k = 'string') AS categorical_columns,
     string_agg(k || ': ' || n, ', ' ORDER BY k) AS dtypes FROM (SELECT {_KINDS_SQL} AS k, count(*) AS n
     FROM (UNPIVOT (SELECT typeof(COLUMNS(* EXCLUDE (flight_id))) FROM p3 LIMIT 1) ON COLUMNS(*) INTO NAME k VALUE v) u GROUP BY 1) g) c""",
    "p3"))
def q_eda_overview(spark, sf):
    return PR.overview(p3_features(spark, sf), key=KEY)


def _p3_columns() -> list[str]:
    import re as _re
    body = oracle.CTES["p3"][0]
    return _re.findall(r"AS (\w+)(?=,|\s*$|\n)", body)


@register("eda_quality", None)
def q_eda_quality(spark, sf):
    return PR.column_audit(p3_features(spark, sf))


@register("eda_negative", sql(
    "SELECT column_name, CAST(negative_count AS BIGINT) AS negative_count FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count_if({c} < 0) AS negative_count FROM p3"
        for c in ["distance", "route_distance", "prior_origin_flight_volume", "prior_dest_flight_volume"]) + ") x",
    "p3"))
def q_eda_negative(spark, sf):
    return PR.negative_counts(p3_features(spark, sf))


@register("eda_target", sql(
    f"""SELECT CAST(count(*) AS BIGINT) AS total_observations, CAST(count_if(delay_target = 1) AS BIGINT) AS delayed_count,
  CAST(count_if(delay_target = 0) AS BIGINT) AS on_time_count,
  {r4('count_if(delay_target = 1) / count(*)')} AS delay_rate, {r4('count_if(delay_target = 0) / count(*)')} AS on_time_rate,
  CASE WHEN count_if(delay_target = 1) > 0 THEN {r2('CAST(count_if(delay_target = 0) AS DOUBLE) / count_if(delay_target = 1)')}
       ELSE 'inf'::DOUBLE END AS imbalance_ratio FROM p3""", "p3"))
def q_eda_target(spark, sf):
    return PR.target_balance(p3_features(spark, sf))


def _rates_by(key_sql: str, name: str, src: str = "p3") -> str:
    return (f"SELECT {key_sql} AS {name}, CAST(count(*) AS BIGINT) AS flight_count, "
            f"CAST(sum(delay_target) AS BIGINT) AS delay_count, {r4('avg(CAST(delay_target AS DOUBLE))')} AS delay_rate "
            f"FROM {src} GROUP BY 1")


def _reindexed(key_sql: str, name: str, order: list[str]) -> str:
    vals = ", ".join(f"('{v}', {i})" for i, v in enumerate(order))
    return (f"SELECT o.{name}, o.position, coalesce(g.flight_count, 0) AS flight_count, "
            f"coalesce(g.delay_count, 0) AS delay_count, coalesce(g.delay_rate, 0) AS delay_rate "
            f"FROM (VALUES {vals}) o({name}, position) LEFT JOIN ({_rates_by(key_sql, name)}) g USING ({name})")


@register("eda_dow", sql(_reindexed("dayname(CAST(flight_date AS DATE))", "day_of_week",
                                    ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]), "p3"))
def q_eda_dow(spark, sf):
    return PR.by_day_of_week(p3_features(spark, sf))


@register("eda_weekend", sql(_rates_by("CAST(isodow(CAST(flight_date AS DATE)) >= 6 AS INTEGER)", "is_weekend"), "p3"))
def q_eda_weekend(spark, sf):
    return PR.by_weekend(p3_features(spark, sf))


@register("eda_tod", sql(_reindexed("dep_time_of_day", "dep_time_of_day", ["morning", "afternoon", "evening", "night"]),
                         "p3"))
def q_eda_tod(spark, sf):
    return PR.by_time_of_day(p3_features(spark, sf))


@register("eda_time_bucket", sql(_reindexed("dep_time_bucket", "dep_time_bucket",
                                            ["00-04", "04-08", "08-12", "12-16", "16-20", "20-24"]), "p3"))
def q_eda_time_bucket(spark, sf):
    return PR.by_time_bucket(p3_features(spark, sf))


@register("eda_by_date", sql(_rates_by("flight_date", "flight_date"), "p3"))
def q_eda_by_date(spark, sf):
    return PR.by_date(p3_features(spark, sf))


@register("eda_date_range", sql(
    "SELECT CAST(min(CAST(flight_date AS DATE)) AS VARCHAR) AS date_range_start, "
    "CAST(max(CAST(flight_date AS DATE)) AS VARCHAR) AS date_range_end, "
    "CAST(count(DISTINCT flight_date) AS BIGINT) AS total_calendar_days FROM p3", "p3"))
def q_eda_date_range(spark, sf):
    return PR.date_range(p3_features(spark, sf))


@register("eda_airlines", sql(
    f"""SELECT airline, flight_count, delay_count, delay_rate,
  {r2('CAST(flight_count AS DOUBLE) / tf * 100')} AS volume_share_pct, {r2('CAST(delay_count AS DOUBLE) / td * 100')} AS delay_share_pct
  FROM ({_rates_by('airline', 'airline')}) g, (SELECT count(*) AS tf, sum(delay_target) AS td FROM p3) t""", "p3"))
def q_eda_airlines(spark, sf):
    return PR.airlines(p3_features(spark, sf))


@register("eda_origin", sql(_rates_by("origin_airport", "origin_airport"), "p3"))
def q_eda_origin(spark, sf):
    return PR.group_rates(p3_features(spark, sf), "origin_airport")


@register("eda_dest", sql(_rates_by("dest_airport", "dest_airport"), "p3"))
def q_eda_dest(spark, sf):
    return PR.group_rates(p3_features(spark, sf), "dest_airport")


@register("eda_routes", sql(f"SELECT * FROM ({_rates_by('route', 'route')}) g WHERE flight_count >= 5", "p3"))
def q_eda_routes(spark, sf):
    return PR.routes(p3_features(spark, sf))


@register("eda_route_sparsity", sql(
    f"""SELECT CAST(count(*) AS BIGINT) AS total_unique_routes, CAST(count_if(n >= 5) AS BIGINT) AS frequent_routes_count,
  CAST(count_if(n < 5) AS BIGINT) AS sparse_routes_count, {r2('count_if(n < 5) * 100.0 / count(*)')} AS sparse_routes_pct
  FROM (SELECT route, count(*) AS n FROM p3 GROUP BY route) g""", "p3"))
def q_eda_route_sparsity(spark, sf):
    return PR.route_sparsity(p3_features(spark, sf))


_RATE_COLS = config.RATE_COLS


def _long_sql(cols: list[str], src: str = "p3", extra: str = "") -> str:
    return " UNION ALL ".join(f"SELECT {extra}'{c}' AS column_name, CAST({c} AS DOUBLE) AS v FROM {src} "
                              f"WHERE {c} IS NOT NULL" for c in cols)


@register("eda_history_describe", sql(
    f"""SELECT column_name, CAST(count(v) AS BIGINT) AS count, {r4('avg(v)')} AS mean, {r4('stddev_samp(v)')} AS std,
  {r4('min(v)')} AS min, {r4('quantile_cont(v, 0.25)')} AS q25, {r4('quantile_cont(v, 0.5)')} AS q50,
  {r4('quantile_cont(v, 0.75)')} AS q75, {r4('max(v)')} AS max FROM ({_long_sql(_RATE_COLS)}) l GROUP BY column_name""",
    "p3"))
def q_eda_history_describe(spark, sf):
    return PR.describe(p3_features(spark, sf), _RATE_COLS)


_NUM_PROFILE = config.NUM_PROFILE


@register("eda_numeric_profile", sql(
    f"""SELECT column_name, CAST(count(v) AS BIGINT) AS count, {r4('avg(v)')} AS mean, {r4('stddev_samp(v)')} AS std,
  {r4('quantile_cont(v, 0.5)')} AS median, {r4('min(v)')} AS min, {r4('max(v)')} AS max,
  {r4('quantile_cont(v, 0.25)')} AS q25, {r4('quantile_cont(v, 0.75)')} AS q75,
  {r4('quantile_cont(v, 0.75) - quantile_cont(v, 0.25)')} AS iqr, {r4('skewness(v)')} AS skewness
  FROM ({_long_sql(_NUM_PROFILE)}) l GROUP BY column_name""", "p3"))
def q_eda_numeric_profile(spark, sf):
    return PR.numeric_profile(p3_features(spark, sf), _NUM_PROFILE)


#: Text columns of the P3 table; every other one but the key is numeric.
_CAT_COLS = ["flight_date", "airline", "origin_airport", "dest_airport", "season", "dep_time_of_day", "dep_time_bucket",
             "arr_time_of_day", "arr_time_bucket", "route", "route_distance_category", "distance_category"]


def _all_numeric(df: DataFrame) -> list[str]:
    return [c for c in PR.numeric_columns(df) if c not in KEY]


def _all_numeric_sql() -> list[str]:
    return [c for c in oracle.P3_COLUMNS if c not in _CAT_COLS and c not in KEY and c != "delay_target"]


@register("eda_target_corr", sql(
    "SELECT feature, " + r4("r") + " AS correlation FROM (UNPIVOT (SELECT " + ", ".join(
        f"CASE WHEN min({c}) < max({c}) THEN corr(CAST({c} AS DOUBLE), CAST(delay_target AS DOUBLE)) END AS {c}"
        for c in _all_numeric_sql()) + " FROM p3) ON COLUMNS(*) INTO NAME feature VALUE r) u", "p3"))
def q_eda_target_corr(spark, sf):
    df = p3_features(spark, sf)
    return PR.target_correlations(df, _all_numeric(df))


def _pairs_sql(cols: list[str]) -> str:
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    return " UNION ALL ".join(
        f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, {r4(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))')} "
        f"AS correlation FROM p3" for a, b in pairs)


# ---- monthly layout and sketches ------------------------------------------

_SKETCHED = ["airline", "origin_airport", "route", "flight_id"]


def p3_monthly(spark: SparkSession, sf: str) -> str:
    """Folder of the P3 table by month, written once a session."""
    k = (spark.sparkContext.applicationId, "p3_monthly", sf)
    if k not in PL._WRITTEN:
        path = f"{PL.checkpoint_dir(spark).rstrip('/')}/tables/p3_monthly-{uuid.uuid4().hex}"
        PL._WRITTEN[k] = files.write_monthly(p3_features(spark, sf), path)
        PL.forget_at_exit(spark, path)
    return PL._WRITTEN[k]


def _middle(spark, sf) -> tuple[str, str]:
    """A tenth to four tenths into the table's dates (two values reach the driver)."""
    a, b = p3_features(spark, sf).agg(F.min("flight_date"), F.max("flight_date")).first()
    days = spark.range(1).select(F.datediff(F.lit(b), F.lit(a))).first()[0]
    return tuple(str(r) for r in spark.range(1).select(F.date_add(F.lit(a).cast("date"), days // 10), F.date_add(F.lit(a).cast("date"), 4 * days // 10)).first())


@register("dated_read", sql(
    """SELECT flight_date, CAST(count(*) AS BIGINT) AS flights, CAST(sum(delay_target) AS BIGINT) AS delays FROM p3,
  (SELECT CAST(min(flight_date) AS DATE) AS a, date_diff('day', CAST(min(flight_date) AS DATE), CAST(max(flight_date) AS DATE)) AS n FROM p3) r
  WHERE CAST(flight_date AS DATE) BETWEEN a + CAST(n // 10 AS INTEGER) AND a + CAST(4 * n // 10 AS INTEGER) GROUP BY flight_date""", "p3"))
def q_dated_read(spark, sf):
    """Flights a day between two dates, read from the monthly table: only the folders of these months are scanned."""
    part = files.read_dated(spark, p3_monthly(spark, sf), *_middle(spark, sf))
    return part.groupBy("flight_date").agg(F.count(F.lit(1)).cast("long").alias("flights"), F.sum("delay_target").cast("long").alias("delays"))


@register("monthly_sketches", sql(
    " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST(count(*) AS BIGINT) AS rows, CAST(count(*) - count({c}) AS BIGINT) AS missing, "
                       f"CAST(count(DISTINCT {c}) AS BIGINT) AS unique_values, true AS within_bound FROM p3" for c in _SKETCHED), "p3"))
def q_monthly_sketches(spark, sf):
    """A24/A29 from sketches kept by month and merged, beside the exact counts: within four standard errors of them."""
    df = p3_features(spark, sf)
    kept = PL.materialize(spark, "p3_sketches", lambda: sketches.monthly(df, _SKETCHED), sf)
    exact = PR.column_summary(df, _SKETCHED).select("column_name", "unique_values")
    off = F.abs(F.col("estimate") - F.col("unique_values"))
    both = sketches.summary(kept).withColumnRenamed("unique_values", "estimate").join(exact, "column_name")
    return both.select("column_name", "rows", "missing", "unique_values",
                       (off <= F.greatest(F.lit(1.0), 4 * 1.04 / 2 ** (sketches.LG_K / 2) * F.col("unique_values"))).alias("within_bound"))


def _on_2a(body: str) -> str:
    """A body over `p3`, read from the 2A table instead."""
    head, table = ORACLES["feature_table_2a"].split("\nSELECT t.flight_id", 1)
    return f"{head},\np3 AS (SELECT t.flight_id{table})\n{body}"


@register("corr_matrix", sql(_pairs_sql(config.CORRELATION_P3), "p3"))
def q_corr_matrix(spark, sf):
    return PR.correlation_pairs(p3_features(spark, sf), config.CORRELATION_P3)


@register("corr_matrix_2a", _on_2a(_pairs_sql(config.CORRELATION_2A)))
def q_corr_matrix_2a(spark, sf):
    t = features.feature_table_2a(PL.pre_departure(spark, sf), KEY)
    return PR.correlation_pairs(t, config.CORRELATION_2A)


def _collinear_sql(cols: list[str]) -> str:
    each = ", ".join(f"CASE WHEN min({a}) < max({a}) AND min({b}) < max({b}) THEN corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) END "
                     f"AS \"{a}|{b}\"" for i, a in enumerate(cols) for b in cols[i + 1:])
    return (f"SELECT split_part(k, '|', 1) AS feature_1, split_part(k, '|', 2) AS feature_2, {r4('r')} AS correlation "
            f"FROM (UNPIVOT (SELECT {each} FROM p3) ON COLUMNS(*) INTO NAME k VALUE r) u WHERE abs(r) >= 0.85")


@register("eda_collinear_pairs", sql(_collinear_sql(_all_numeric_sql()), "p3"))
def q_eda_collinear(spark, sf):
    df = p3_features(spark, sf)
    return PR.collinear_pairs(df, [c for c in _all_numeric(df) if c != "delay_target"])


_OUTLIER_COLS = config.OUTLIER_COLS


@register("eda_outliers", sql(
    f"""SELECT l.column_name, {r2('b.lo')} AS lower_bound, {r2('b.hi')} AS upper_bound,
  CAST(count_if(v < lo OR v > hi) AS BIGINT) AS outlier_count,
  {r2('count_if(v < lo OR v > hi) * 100.0 / count(*)')} AS outlier_pct,
  {r2('min(CASE WHEN v < lo OR v > hi THEN v END)')} AS min_outlier,
  {r2('max(CASE WHEN v < lo OR v > hi THEN v END)')} AS max_outlier
  FROM ({_long_sql(_OUTLIER_COLS)}) l JOIN (SELECT column_name,
      quantile_cont(v, 0.25) - 1.5 * (quantile_cont(v, 0.75) - quantile_cont(v, 0.25)) AS lo,
      quantile_cont(v, 0.75) + 1.5 * (quantile_cont(v, 0.75) - quantile_cont(v, 0.25)) AS hi
    FROM ({_long_sql(_OUTLIER_COLS)}) q GROUP BY column_name) b USING (column_name)
  GROUP BY l.column_name, b.lo, b.hi""", "p3"))
def q_eda_outliers(spark, sf):
    return PR.outliers(p3_features(spark, sf), _OUTLIER_COLS)


def _r1(x: str) -> str:
    return f"(CAST(round_even(CAST({x} AS DOUBLE) * 10.0, 0) AS DOUBLE) / 10.0 + 0.0)"


@register("eda_delay_percentiles", sql(
    f"""SELECT column_name, {_r1('min(v)')} AS min, {_r1('max(v)')} AS max, {_r1('avg(v)')} AS mean,
  {_r1('quantile_cont(v, 0.5)')} AS median, {_r1('quantile_cont(v, 0.9)')} AS p90, {_r1('quantile_cont(v, 0.95)')} AS p95,
  {_r1('quantile_cont(v, 0.99)')} AS p99 FROM ({_long_sql(['arrival_delay', 'departure_delay'], 'clean')}) l
  GROUP BY column_name""", "clean"))
def q_eda_delay_percentiles(spark, sf):
    return PR.delay_percentiles(PL.cleaned_flights(spark, sf))


_HOUR_SQL = hhmm("scheduled_dep_time")[0]


@register("eda_hour", sql(_rates_by(_HOUR_SQL, "departure_hour"), "p3"))
def q_eda_hour(spark, sf):
    return PR.group_rates(p3_features(spark, sf), S.hhmm_parts(F.col("scheduled_dep_time"))[0], name="departure_hour")


@register("eda_haul", sql(_reindexed("distance_category", "distance_category",
                                     ["short_haul", "medium_haul", "long_haul"]), "p3"))
def q_eda_haul(spark, sf):
    return PR.reindex(PR.group_rates(p3_features(spark, sf), "distance_category"), "distance_category",
                      ["short_haul", "medium_haul", "long_haul"])


def _top_sql(key: str, min_n: int, k: int, volume: bool = False) -> str:
    first = "flight_count DESC, " if volume else ""
    return (f"SELECT * FROM ({_rates_by(key, key)}) g WHERE flight_count >= {min_n} "
            f"ORDER BY {first}delay_count / flight_count DESC, {key} LIMIT {k}")


@register("top_airports", sql(
    f"SELECT 'origin' AS side, origin_airport AS airport, * EXCLUDE (origin_airport) FROM ({_top_sql('origin_airport', 10, 10)}) a UNION ALL "
    f"SELECT 'destination', dest_airport, * EXCLUDE (dest_airport) FROM ({_top_sql('dest_airport', 10, 10)}) b", "p3"))
def q_top_airports(spark, sf):
    df = p3_features(spark, sf)
    sides = [PR.top_groups(df, c, 10, 10).withColumnRenamed(c, "airport").select(F.lit(side).alias("side"), "*")
             for side, c in (("origin", "origin_airport"), ("destination", "dest_airport"))]
    return sides[0].unionByName(sides[1])


@register("top_routes", sql(_top_sql("route", 5, 12, volume=True), "p3"))
def q_top_routes(spark, sf):
    return PR.top_groups(p3_features(spark, sf), "route", 5, 12, by="volume")


_BOX_COLS = ["distance", "scheduled_dep_time", "prior_route_frequency"]


@register("dist_by_target", sql(
    f"""SELECT target, column_name, CAST(count(v) AS BIGINT) AS n, {r4('min(v)')} AS min,
  {r4('quantile_cont(v, 0.25)')} AS q25, {r4('quantile_cont(v, 0.5)')} AS median, {r4('quantile_cont(v, 0.75)')} AS q75,
  {r4('max(v)')} AS max FROM ({_long_sql(_BOX_COLS, extra='delay_target AS target, ')}) l
  GROUP BY target, column_name""", "p3"))
def q_dist_by_target(spark, sf):
    return PR.distribution_by_target(p3_features(spark, sf), _BOX_COLS)


@register("rate_histogram", sql(
    f"""SELECT column_name, CAST(least(floor((v - lo) / (hi - lo) * 20), 19) AS INTEGER) AS bin, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT column_name, v, CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo, CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi FROM (
  SELECT column_name, v, min(v) OVER (PARTITION BY column_name) AS mn, max(v) OVER (PARTITION BY column_name) AS mx
  FROM ({_long_sql(_RATE_COLS)}) l) m) b GROUP BY 1, 2""", "p3"))
def q_rate_histogram(spark, sf):
    return PR.rate_histogram(p3_features(spark, sf), _RATE_COLS)


@register("kpi_overview", sql(
    f"""SELECT CAST(count(*) AS BIGINT) AS flights,
  {r4('''count_if(NOT (_is_duplicate OR _bad_date OR _bad_airport OR _bad_distance OR _bad_delay) AND NOT _is_cancelled
     AND NOT _is_diverted AND arrival_delay >= 15) / greatest(count_if(NOT (_is_duplicate OR _bad_date OR _bad_airport
     OR _bad_distance OR _bad_delay) AND NOT _is_cancelled AND NOT _is_diverted), 1)''')} AS delay_rate,
  {r2('''avg(CASE WHEN NOT (_is_duplicate OR _bad_date OR _bad_airport OR _bad_distance OR _bad_delay)
     AND NOT _is_cancelled AND NOT _is_diverted THEN arrival_delay END)''')} AS avg_arrival_delay,
  {r4('count_if(_is_cancelled) / count(*)')} AS cancellation_rate FROM flags""", "flags"))
def q_kpi_overview(spark, sf):
    return PR.kpi_overview(quality.annotate(PL.canonical_flights(spark, sf)))


@register("hotspot_matrix", sql(
    f"SELECT origin_airport, dep_hour AS departure_hour, CAST(count(*) AS BIGINT) AS flights, "
    f"{r4('avg(CAST(delay_target AS DOUBLE))')} AS delay_rate FROM timed GROUP BY 1, 2", "timed"))
def q_hotspot_matrix(spark, sf):
    pre = PL.pre_departure(spark, sf).withColumns(S.departure_columns())
    return PR.hotspot_matrix(pre)


@register("categorical_profile", sql(
    """SELECT column_name, CAST(count(*) AS BIGINT) AS distinct_values,
  min(value) FILTER (WHERE n = mx) AS mode, CAST(max(n) AS BIGINT) AS mode_count FROM (
  SELECT column_name, value, n, max(n) OVER (PARTITION BY column_name) AS mx FROM (
  SELECT column_name, value, count(*) AS n FROM (""" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM p3 WHERE {c} IS NOT NULL"
        for c in _CAT_COLS) + ") l GROUP BY 1, 2) c) m GROUP BY column_name", "p3"))
def q_categorical_profile(spark, sf):
    return PR.categorical_profile(p3_features(spark, sf), _CAT_COLS)


_VC_COLS = ["delay_target", "prior_route_frequency", "dep_time_of_day", "distance_category"]


@register("value_counts", sql(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, value, n, {r2('n * 100.0 / sum(n) OVER ()')} AS share_pct FROM "
        f"(SELECT CAST({c} AS VARCHAR) AS value, CAST(count(*) AS BIGINT) AS n FROM p3 GROUP BY 1) g{i}"
        for i, c in enumerate(_VC_COLS)), "p3"))
def q_value_counts(spark, sf):
    df = p3_features(spark, sf)
    out = None
    for c in _VC_COLS:
        v = PR.value_counts(df, c).select(F.lit(c).alias("column_name"), "*")
        out = v if out is None else out.unionByName(v)
    return out


_CYC_PAIRS = [("dep_minute_sin", "dep_minute_cos"), ("arr_hour_sin", "arr_hour_cos")]


@register("cyclical_identity", sql(
    "SELECT " + ", ".join(f"{r6(f'min({s_} * {s_} + {c_} * {c_})')} AS {s_}_min, "
                          f"{r6(f'max({s_} * {s_} + {c_} * {c_})')} AS {s_}_max" for s_, c_ in _CYC_PAIRS)
    + " FROM p3", "p3"))
def q_cyclical_identity(spark, sf):
    return PR.cyclical_identity(p3_features(spark, sf), _CYC_PAIRS)


from . import ml_queries as _ml_queries  # noqa: E402,F401  (registers the model-layer queries)


# ---- column audits with oracles ---------------------------------------------------------

_P3C = oracle.P3_COLUMNS


def _audit_sql() -> str:
    parts = []
    for c in _P3C:
        parts.append(
            f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS missing_count, "
            f"{r2(f'(count(*) - count({c})) * 100.0 / greatest(count(*), 1)')} AS missing_pct, "
            f"(count(DISTINCT {c}) + CASE WHEN count(*) > count({c}) THEN 1 ELSE 0 END) <= 1 AS is_constant, "
            f"CAST(count(DISTINCT {c}) AS BIGINT) AS unique_values FROM p3")
    return " UNION ALL ".join(parts)


ORACLES["eda_quality"] = sql("SELECT column_name, missing_count, missing_pct, is_constant FROM ("
                             + _audit_sql() + ") a", "p3")


# columns of the P3 table that are made as copies of another one
_TWINS = dict(prior.P3_ALIASES) | {"route_distance_category": "distance_category", "prior_route_frequency": "prior_route_flight_count",
                                   "prior_origin_flight_volume": "prior_origin_flight_count", "prior_dest_flight_volume": "prior_dest_flight_count"}


@register("p3_column_summary", sql("SELECT column_name, missing_count, missing_pct, unique_values FROM ("
                                   + _audit_sql() + ") a", "p3"))
def q_p3_column_summary(spark, sf):
    return PR.column_summary(p3_features(spark, sf), twins=_TWINS).drop("dtype")


@register("feature_quality", None)
def q_feature_quality(spark, sf):
    return PR.feature_quality(features.feature_table_2a(PL.pre_departure(spark, sf), KEY))


def _feature_quality_sql() -> str:
    # the 2A table as a derived table, then one aggregate
    full = ORACLES["feature_table_2a"]
    head, body = full.split("\nSELECT t.flight_id", 1)
    cols = ["flight_id", "flight_date", "airline", "origin_airport", "dest_airport", "year", "month", "day",
            "day_of_week", "week_of_year", "day_of_year", "is_weekend", "scheduled_dep_time", "departure_hour",
            "departure_minute", "departure_minutes_since_midnight", "time_of_day", "scheduled_arr_time",
            "arrival_hour", "arrival_minute", "arrival_minutes_since_midnight", *_CYC, "route", "same_airport_flag",
            "distance", "haul_category", *_A2_HIST, "delay_target"]
    missing = " + ".join(f"(count(*) - count({c}))" for c in cols)
    types = ("(SELECT count_if(split_part(v, '(', 1) IN ('TINYINT', 'SMALLINT', 'INTEGER', 'BIGINT', 'HUGEINT', "
             "'FLOAT', 'DOUBLE', 'DECIMAL')) AS numeric_features, count_if(v = 'VARCHAR') AS categorical_features "
             "FROM (UNPIVOT (SELECT typeof(COLUMNS(*)) FROM f LIMIT 1) ON COLUMNS(*) INTO NAME k VALUE v) u) ty")
    return (head + ",\nf AS (SELECT t.flight_id" + body + ")\n"
            f"SELECT ty.numeric_features, ty.categorical_features, CAST({missing} AS BIGINT) AS missing_cells, "
            f"{r2(f'({missing}) * 100.0 / (count(*) * {len(cols)})')} AS missing_pct, min(distance) AS min_distance, "
            "max(distance) AS max_distance, min(departure_minutes_since_midnight) AS min_departure_minute, "
            f"max(departure_minutes_since_midnight) AS max_departure_minute FROM f, {types} "
            "GROUP BY ty.numeric_features, ty.categorical_features")


ORACLES["feature_quality"] = _feature_quality_sql()


@register("best_threshold_fine", sql(
    "SELECT split, first(threshold ORDER BY CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0) DESC NULLS LAST, "
    "threshold ASC) AS best_threshold, max(f1) AS best_f1 FROM (" + _sweep_sql(_FINE) + ") w GROUP BY split",
    "scored"))
def q_best_threshold_fine(spark, sf):
    """.30-.70 step .05, argmax on the unrounded F1."""
    sw = metrics.threshold_sweep(scored(spark, sf), thresholds=_FINE, groups=["split"])
    return metrics.best_threshold(sw, groups=["split"], rounded=False)


@register("pr_points", sql(
    f"""SELECT split, s AS threshold, {r4('coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 1.0)')} AS precision,
  {r4('coalesce(CAST(tp AS DOUBLE) / nullif(P, 0), 0.0)')} AS recall FROM (
  SELECT split, s,
    sum(pos) OVER (PARTITION BY split ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
    sum(neg) OVER (PARTITION BY split ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
    sum(pos) OVER (PARTITION BY split) AS P
  FROM (SELECT split, p AS s, count_if(y = 1) AS pos, count_if(y <> 1) AS neg FROM scored GROUP BY split, p) a) b""",
    "scored"))
def q_pr_points(spark, sf):
    return metrics.curve_points(scored(spark, sf), groups=["split"]).select("split", "threshold", "precision", "recall")


def _p3_weather_sql() -> str:
    flags = ", ".join(f"coalesce(a.weather_origin_is_{k}, 0) AS {p}{form.format(k)}"
                      for p in ("", "origin_", "weather_origin_") for k in _WFLAGS for form in ("is_{}", "{}_flag"))
    return f"SELECT p.* EXCLUDE (delay_target), {flags}, p.delay_target FROM p3 p JOIN ({_asof_sql('origin_airport', 'weather_origin_')}) a USING (flight_id)"


@register("feature_table_p3_weather", sql(_p3_weather_sql(), "p3", "timed", "weather"))
def q_feature_table_p3_weather(spark, sf):
    """P3 table with the indicators of the nearest prior origin observation."""
    return features.feature_table_p3(PL.pre_departure(spark, sf), KEY, weather=PL.weather(spark, sf))


def _a2_weather_sql() -> str:
    table = "SELECT t.flight_id" + ORACLES["feature_table_2a"].split("\nSELECT t.flight_id", 1)[1]
    kept = ["obs_id", *_MEASURES, "weather_condition", *[form.format(k) for k in _WFLAGS for form in ("is_{}", "{}_flag")]]
    cols = ", ".join(f"a.weather_origin_{c}, a.weather_origin_{c} AS origin_{c}" for c in kept)
    return (f"SELECT t.* EXCLUDE (delay_target), {cols}, a.weather_origin_missing_flag, a.weather_origin_missing_flag AS origin_weather_observed_missing, "
            f"t.delay_target FROM ({table}) t JOIN ({_asof_sql('origin_airport', 'weather_origin_')}) a USING (flight_id)")


@register("feature_table_2a_weather", sql(_a2_weather_sql(), "timed", "gprior", "weather"))
def q_feature_table_2a_weather(spark, sf):
    """2A table with the joined nearest prior origin weather columns."""
    t = features.feature_table_2a(PL.pre_departure(spark, sf), KEY, weather=PL.weather(spark, sf))
    return t.withColumns({c: _r6(F.col(c)) for c in _CYC} | {f"{p}{c}": _r4(F.col(f"{p}{c}")) for p in ("weather_origin_", "origin_") for c in _MEASURES})


@register("split_overlaps", sql(
    """SELECT 'train_val' AS boundary, max(flight_date) FILTER (WHERE split = 'train')
         > min(flight_date) FILTER (WHERE split = 'val') AS overlap,
       max(flight_date) FILTER (WHERE split = 'train') AS left_max, min(flight_date) FILTER (WHERE split = 'val') AS right_min
  FROM splitp
  UNION ALL
  SELECT 'val_test', max(flight_date) FILTER (WHERE split = 'val') > min(flight_date) FILTER (WHERE split = 'test'),
       max(flight_date) FILTER (WHERE split = 'val'), min(flight_date) FILTER (WHERE split = 'test') FROM splitp""",
    "splitp"))
def q_split_overlaps(spark, sf):
    return split.split_overlaps(split.chronological_split(PL.pre_departure(spark, sf), key="flight_id"))
