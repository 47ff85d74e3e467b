"""DuckDB oracle SQL built from named CTE fragments.

Every fragment is written directly in SQL from the semantics (not generated
from the Spark plan), so a query and its oracle are two independent
implementations. ``sql(body, *ctes)`` prepends the needed fragments in
dependency order.
"""

from __future__ import annotations

from ..sources import fixtures

CANON_COLS = ["flight_id", "flight_date", "airline", "origin_airport", "dest_airport", "scheduled_dep_time",
              "scheduled_arr_time", "arrival_delay", "departure_delay", "distance", "cancelled", "diverted"]
PRE_COLS = ["flight_id", "flight_date", "airline", "origin_airport", "dest_airport", "scheduled_dep_time",
            "scheduled_arr_time", "distance", "cancelled", "diverted", "delay_target"]


def strip(x: str) -> str:
    return f"regexp_replace(CAST({x} AS VARCHAR), '^\\s+|\\s+$', '', 'g')"


def hhmm(x: str) -> tuple[str, str]:
    """(hour, minute) SQL for an HHMM column: bad/null -> 0, minutes roll over, hour mod 24."""
    v = f"coalesce(TRY_CAST(trunc(TRY_CAST({x} AS DOUBLE)) AS INTEGER), 0)"
    raw_min = f"((({v}) % 100 + 100) % 100)"
    raw_hour = f"CAST(floor(({v}) / 100.0) AS INTEGER)"
    hour = f"CAST(((({raw_hour} + CAST(floor({raw_min} / 60.0) AS INTEGER)) % 24) + 24) % 24 AS INTEGER)"
    minute = f"CAST({raw_min} % 60 AS INTEGER)"
    return hour, minute


def r4(x: str) -> str:
    return f"(CAST(round_even(CAST({x} AS DOUBLE) * 10000.0, 0) AS DOUBLE) / 10000.0 + 0.0)"


def r2(x: str) -> str:
    return f"(CAST(round_even(CAST({x} AS DOUBLE) * 100.0, 0) AS DOUBLE) / 100.0 + 0.0)"


def r6(x: str) -> str:
    return f"(CAST(round_even(CAST({x} AS DOUBLE) * 1000000.0, 0) AS DOUBLE) / 1000000.0 + 0.0)"


def window_prior(agg: str, keys: list[str], lo: str = "UNBOUNDED PRECEDING", lag: int = 0) -> str:
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""
    return f"{agg} OVER ({part}ORDER BY dep_minute RANGE BETWEEN {lo} AND {1 + lag} PRECEDING)"


_DEP_H, _DEP_M = hhmm("scheduled_dep_time")
_ARR_H, _ARR_M = hhmm("scheduled_arr_time")
_ALL = ", ".join(CANON_COLS)

CTES: dict[str, tuple[str, list[str]]] = {
    "raw": (f"raw AS ({fixtures.FLIGHTS_DUCKDB_SQL})", []),
    "canon": ("""canon AS (SELECT flight_id, "FL_DATE" AS flight_date, "OP_UNIQUE_CARRIER" AS airline,
  "ORIGIN" AS origin_airport, "DEST" AS dest_airport, "CRS_DEP_TIME" AS scheduled_dep_time,
  "CRS_ARR_TIME" AS scheduled_arr_time, "ARR_DELAY" AS arrival_delay, "DEP_DELAY" AS departure_delay,
  "DISTANCE" AS distance, "CANCELLED" AS cancelled, "DIVERTED" AS diverted FROM raw)""", ["raw"]),
    "flags": (f"""flags AS (SELECT *,
  row_number() OVER (PARTITION BY {_ALL}) > 1 AS _is_duplicate,
  coalesce(CAST(cancelled AS DOUBLE), 0) = 1 AS _is_cancelled,
  coalesce(CAST(diverted AS DOUBLE), 0) = 1 AS _is_diverted,
  TRY_CAST(flight_date AS DATE) IS NULL AS _bad_date,
  (coalesce(NOT regexp_full_match({strip('origin_airport')}, '[A-Za-z]{{3}}'), true)
   OR coalesce(NOT regexp_full_match({strip('dest_airport')}, '[A-Za-z]{{3}}'), true)) AS _bad_airport,
  (distance IS NULL OR distance <= 0 OR distance > 10000) AS _bad_distance,
  (coalesce(CAST(cancelled AS DOUBLE), 0) <> 1 AND coalesce(CAST(diverted AS DOUBLE), 0) <> 1
   AND (arrival_delay IS NULL OR arrival_delay < -120 OR arrival_delay > 2880)) AS _bad_delay
  FROM canon)""", ["canon"]),
    "valid": (f"""valid AS (SELECT DISTINCT {_ALL} FROM flags
  WHERE NOT (_bad_date OR _bad_airport OR _bad_distance OR _bad_delay OR _is_cancelled OR _is_diverted))""",
              ["flags"]),
    "clean": (f"""clean AS (SELECT flight_id, strftime(CAST(flight_date AS DATE), '%Y-%m-%d') AS flight_date,
  upper({strip('airline')}) AS airline, upper({strip('origin_airport')}) AS origin_airport,
  upper({strip('dest_airport')}) AS dest_airport, scheduled_dep_time, scheduled_arr_time,
  CAST(arrival_delay AS DOUBLE) AS arrival_delay, departure_delay, CAST(distance AS DOUBLE) AS distance,
  cancelled, diverted, CAST(coalesce(CAST(arrival_delay >= 15 AS INTEGER), 0) AS INTEGER) AS delay_target
  FROM valid)""", ["valid"]),
    "pre": (f"pre AS (SELECT {', '.join(PRE_COLS)} FROM clean)", ["clean"]),
    "timed": (f"""timed AS (SELECT *,
  CAST(date_diff('day', DATE '1970-01-01', CAST(flight_date AS DATE)) AS BIGINT) * 1440
    + {_DEP_H} * 60 + {_DEP_M} AS dep_minute,
  {_DEP_H} AS dep_hour, {_DEP_M} AS dep_min, {_ARR_H} AS arr_hour, {_ARR_M} AS arr_min,
  origin_airport || '_' || dest_airport AS route
  FROM pre)""", ["pre"]),
    "gprior": (f"""gprior AS (SELECT DISTINCT dep_minute,
  CASE WHEN {window_prior('count(*)', [])} > 0
       THEN CAST({window_prior('sum(delay_target)', [])} AS DOUBLE) / {window_prior('count(*)', [])} END AS g
  FROM timed)""", ["timed"]),
    "weather": (f"weather AS ({fixtures.WEATHER_DUCKDB_SQL})", []),
}

P3_DIMS = [("prior_airline", ["airline"]), ("prior_origin", ["origin_airport"]), ("prior_dest", ["dest_airport"]),
           ("prior_route", ["route"]), ("prior_airline_dep_hour", ["airline", "dep_hour"]),
           ("prior_origin_dep_hour", ["origin_airport", "dep_hour"])]
A2_DIMS = [("historical_origin", ["origin_airport"]), ("historical_destination", ["dest_airport"]),
           ("historical_airline", ["airline"]), ("historical_route", ["route"])]


def _hist_counts(dims) -> str:
    parts = []
    for name, keys in dims:
        parts.append(f"{window_prior('count(*)', keys)} AS {name}_n")
        parts.append(f"coalesce({window_prior('sum(delay_target)', keys)}, 0) AS {name}_s")
    return ",\n  ".join(parts)


CTES["histn"] = (f"""histn AS (SELECT t.*, gp.g,
  {_hist_counts(P3_DIMS)}
  FROM timed t JOIN gprior gp USING (dep_minute))""", ["timed", "gprior"])


def _p3_cols(min_history: int = 3, fallback: str = "coalesce(g, 0.0)") -> str:
    parts = []
    for name, _ in P3_DIMS:
        n, s = f"{name}_n", f"{name}_s"
        parts.append(f"CAST({n} AS INTEGER) AS {name}_flight_count")
        parts.append(f"CAST({s} AS INTEGER) AS {name}_delay_count")
        parts.append(f"{r4(f'CASE WHEN {n} >= {min_history} THEN CAST({s} AS DOUBLE) / {n} ELSE {fallback} END')}"
                     f" AS {name}_delay_rate")
    return ",\n  ".join(parts)


def lagged_history(dims, lag: int, min_history: int = 3, lo: str = "UNBOUNDED PRECEDING",
                   fallback: str = "coalesce(g, 0.0)") -> str:
    """Counts and rates of flights whose outcome was known ``lag`` minutes after departure."""
    parts = []
    for name, keys in dims:
        n = window_prior("count(*)", keys, lo, lag)
        s = f"coalesce({window_prior('sum(delay_target)', keys, lo, lag)}, 0)"
        parts.append(f"CAST({n} AS INTEGER) AS {name}_flight_count")
        parts.append(f"{r4(f'CASE WHEN {n} >= {min_history} THEN CAST({s} AS DOUBLE) / {n} ELSE {fallback} END')}"
                     f" AS {name}_delay_rate")
    g = (f"SELECT *, CASE WHEN {window_prior('count(*)', [], lag=lag)} > 0 THEN "
         f"CAST({window_prior('sum(delay_target)', [], lag=lag)} AS DOUBLE) / {window_prior('count(*)', [], lag=lag)} END AS g FROM timed")
    return f"SELECT flight_id, {', '.join(parts)} FROM ({g}) t"


CTES["hist3"] = (f"hist3 AS (SELECT flight_id, flight_date, scheduled_dep_time, delay_target, dep_minute,\n  "
                 f"{_p3_cols()} FROM histn)", ["histn"])

# chronological split and deterministic score
CTES["splitp"] = ("""splitp AS (SELECT *, CASE WHEN pos < n_train THEN 'train'
  WHEN pos < n_train + n_val THEN 'val' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (ORDER BY flight_date, scheduled_dep_time NULLS LAST, flight_id) - 1 AS pos,
     CAST(floor(count(*) OVER () * CAST(0.7 AS DOUBLE)) AS BIGINT) AS n_train,
     CAST(floor(count(*) OVER () * CAST(0.15 AS DOUBLE)) AS BIGINT) AS n_val FROM pre) x)""", ["pre"])
CTES["scored"] = ("""scored AS (SELECT s.flight_id, s.split, s.delay_target AS y, h.prior_origin_delay_rate AS p
  FROM splitp s JOIN hist3 h USING (flight_id))""", ["splitp", "hist3"])


def sql(body: str, *needs: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)
    for n in needs:
        visit(n)
    if not order:
        return body
    return "WITH " + ",\n".join(CTES[n][0] for n in order) + "\n" + body


def _tod(h: str) -> str:
    return (f"CASE WHEN {h} >= 22 OR {h} < 6 THEN 'night' WHEN {h} < 12 THEN 'morning' "
            f"WHEN {h} < 18 THEN 'afternoon' ELSE 'evening' END")


def _bucket(h: str) -> str:
    return ("CASE " + " ".join(f"WHEN {h} >= {4 * i} AND {h} < {4 * i + 4} THEN '{4 * i:02d}-{4 * i + 4:02d}'"
                               for i in range(6)) + " ELSE '08-12' END")


_DIST_INT = "coalesce(TRY_CAST(trunc(TRY_CAST(distance AS DOUBLE)) AS INTEGER), 0)"
_HAUL = (f"CASE WHEN {_DIST_INT} < 500 THEN 'short_haul' WHEN {_DIST_INT} < 1500 THEN 'medium_haul' "
         "ELSE 'long_haul' END")
_ALIASES = [(a, src) for a_pfx, s_pfx in [("carrier_prior", "prior_airline"), ("airline_prior", "prior_airline"),
                                          ("origin_prior", "prior_origin"), ("dest_prior", "prior_dest"),
                                          ("route_prior", "prior_route"),
                                          ("carrier_origin_hour_prior", "prior_airline_dep_hour"),
                                          ("airline_dep_hour_prior", "prior_airline_dep_hour")]
            for a, src in [(f"{a_pfx}_{m}", f"{s_pfx}_{m}") for m in ("flight_count", "delay_count", "delay_rate")]]
_HIST_COLS = [f"{n}_{m}" for n, _ in P3_DIMS for m in ("flight_count", "delay_count", "delay_rate")]

CTES["vols"] = (f"""vols AS (SELECT flight_id,
  {window_prior('count(*)', ['route'])} AS prior_route_frequency,
  {window_prior('count(*)', ['origin_airport'])} AS prior_origin_flight_volume,
  {window_prior('count(*)', ['dest_airport'])} AS prior_dest_flight_volume FROM timed)""", ["timed"])
CTES["p3"] = (f"""p3 AS (SELECT t.flight_id, t.flight_date, t.airline, t.origin_airport, t.dest_airport,
  t.scheduled_dep_time, t.scheduled_arr_time, t.distance, t.cancelled, t.diverted,
  CAST(day(CAST(t.flight_date AS DATE)) = 1 AS INTEGER) AS is_month_start,
  CAST(CAST(t.flight_date AS DATE) = last_day(CAST(t.flight_date AS DATE)) AS INTEGER) AS is_month_end,
  CAST(quarter(CAST(t.flight_date AS DATE)) AS INTEGER) AS quarter,
  CASE WHEN month(CAST(t.flight_date AS DATE)) IN (12, 1, 2) THEN 'winter'
       WHEN month(CAST(t.flight_date AS DATE)) IN (3, 4, 5) THEN 'spring'
       WHEN month(CAST(t.flight_date AS DATE)) IN (6, 7, 8) THEN 'summer' ELSE 'fall' END AS season,
  {_tod('t.dep_hour')} AS dep_time_of_day, {_bucket('t.dep_hour')} AS dep_time_bucket,
  {r6('sin(2 * pi() * t.dep_min / 60.0)')} AS dep_minute_sin, {r6('cos(2 * pi() * t.dep_min / 60.0)')} AS dep_minute_cos,
  {_tod('t.arr_hour')} AS arr_time_of_day, {_bucket('t.arr_hour')} AS arr_time_bucket,
  {r6('sin(2 * pi() * t.arr_hour / 24.0)')} AS arr_hour_sin, {r6('cos(2 * pi() * t.arr_hour / 24.0)')} AS arr_hour_cos,
  t.route, {_DIST_INT} AS route_distance, {_HAUL} AS route_distance_category, {_HAUL} AS distance_category,
  v.prior_route_frequency, v.prior_origin_flight_volume, v.prior_dest_flight_volume,
  {', '.join('h.' + c for c in _HIST_COLS)},
  {', '.join(f'h.{src} AS {a}' for a, src in _ALIASES)},
  t.delay_target
  FROM timed t JOIN hist3 h USING (flight_id) JOIN vols v USING (flight_id))""", ["timed", "hist3", "vols"])

# column list of the P3 table (flight key first), as defined above
P3_COLUMNS = (PRE_COLS[:-1] + ["is_month_start", "is_month_end", "quarter", "season", "dep_time_of_day",
                               "dep_time_bucket", "dep_minute_sin", "dep_minute_cos", "arr_time_of_day",
                               "arr_time_bucket", "arr_hour_sin", "arr_hour_cos", "route", "route_distance",
                               "route_distance_category", "distance_category", "prior_route_frequency",
                               "prior_origin_flight_volume", "prior_dest_flight_volume"]
              + _HIST_COLS + [a for a, _ in _ALIASES] + ["delay_target"])
