"""Feature-table assembly (2A: 38 columns, P3: 68 columns, + the flight key).

Columns are added on one lineage (``withColumns``); history and weather are
attached by key joins, never by position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import asof, prior

BASE_IDS = ["flight_date", "airline", "origin_airport", "dest_airport"]


def same_airport_varies(df: DataFrame) -> bool:
    """F8: emit ``same_airport_flag`` only if origin == dest varies."""
    same = (S.std_code(S.col("origin_airport")) == S.std_code(S.col("dest_airport"))).cast("int")
    r = df.agg(F.min(same).alias("lo"), F.max(same).alias("hi")).first()
    return r["lo"] is not None and r["lo"] != r["hi"]


def require_dates(df: DataFrame, date_col: str = "flight_date") -> None:
    """a table whose dates all fail to parse is an error."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.count(S.to_date(S.col(date_col))).alias("dates")).first()
    if r["n"] and not r["dates"]:
        raise ValueError(f"no value of '{date_col}' is a date")


def base_features_2a(df: DataFrame, key: list[str] | None = None, same_airport: bool | None = None) -> DataFrame:
    """Calendar, schedule, cyclical and route features of the 2A table."""
    key = key or []
    require_dates(df)
    cols = [S.col(c) for c in key] + [S.col(c) for c in BASE_IDS if c in df.columns]
    x = df.withColumns(S.calendar_columns("flight_date"))
    x = x.withColumns(S.departure_columns("scheduled_dep_time"))
    has_arr = "scheduled_arr_time" in df.columns
    if has_arr:
        x = x.withColumns(S.arrival_columns("scheduled_arr_time"))
    x = x.withColumns(S.cyclical_columns())
    x = x.withColumns({"route": S.route(), "_distance": S.to_double(S.col("distance")),
                       "haul_category": S.haul_2a(S.col("distance"))})
    if same_airport is None:
        same_airport = same_airport_varies(df)
    cal = ["year", "month", "day", "day_of_week", "week_of_year", "day_of_year", "is_weekend"]
    dep = ["scheduled_dep_time", "departure_hour", "departure_minute", "departure_minutes_since_midnight",
           "time_of_day"]
    arr = (["scheduled_arr_time", "arrival_hour", "arrival_minute", "arrival_minutes_since_midnight"]
           if has_arr else [])
    cyc = ["departure_hour_sin", "departure_hour_cos", "day_of_week_sin", "day_of_week_cos", "month_sin",
           "month_cos"]
    sel = cols + [S.col(c) for c in cal + dep + arr + cyc] + [S.col("route")]
    if same_airport:
        sel.append((S.std_code(S.col("origin_airport")) == S.std_code(S.col("dest_airport")))
                   .cast("int").alias("same_airport_flag"))
    sel += [F.col("_distance").alias("distance"), S.col("haul_category")]
    if "delay_target" in df.columns:
        sel.append(S.col("delay_target").cast("int").alias("delay_target"))
    return x.select(*sel)


def feature_table_2a(pre: DataFrame, key: list[str], weather: DataFrame | None = None,
                     min_history: int = 3, fallback: str = "global_prior", method: str = "prefix",
                     tie_key: str | None = "obs_id") -> DataFrame:
    base = base_features_2a(pre, key)
    hist = prior.history_2a(base, min_history=min_history, fallback=fallback, key=key, method=method)
    hist = hist.drop(prior.T)
    if weather is not None:
        hist = asof.asof_weather(hist, weather, key=key, tie_key=tie_key).drop(prior.T)
    cols = [c for c in hist.columns if c != "delay_target"] + ["delay_target"]
    return hist.select(*[S.col(c) for c in cols])


def base_features_p3(pre: DataFrame) -> DataFrame:
    """P3 date, time and route/airport columns on the pre-departure table."""
    x = pre.withColumns(S.date_p3_columns("flight_date"))
    x = x.withColumns(S.time_p3_columns(pre.columns))
    if "route" in pre.columns:
        r = S.col("route").cast("string")
    else:
        r = F.concat_ws("_", S.col("origin_airport").cast("string"), S.col("dest_airport").cast("string"))
    dist = S.route_distance_int(S.col("distance")) if "distance" in pre.columns else F.lit(500)
    x = x.withColumns({"route": r, "route_distance": dist})
    cat = S.haul_p3(F.col("route_distance"))
    return x.withColumns({"route_distance_category": cat, "distance_category": cat})


def feature_table_p3(pre: DataFrame, key: list[str], weather: DataFrame | None = None,
                     min_history: int = 3, fallback: str = "global_prior", wrap_hour: bool = True,
                     with_aliases: bool = True, method: str = "prefix", tie_key: str | None = "obs_id") -> DataFrame:
    """P3 table. Each dimension's strictly prior (n, s) is computed once: the
    route / origin / destination volumes are the history flight counts."""
    base = base_features_p3(pre)
    hist = prior.history_p3(base, min_history=min_history, fallback=fallback, key=key,
                            wrap_hour=wrap_hour, with_aliases=with_aliases, method=method)
    vols = {"prior_route_frequency": F.col("prior_route_flight_count").cast("long"),
            "prior_origin_flight_volume": F.col("prior_origin_flight_count").cast("long"),
            "prior_dest_flight_volume": F.col("prior_dest_flight_count").cast("long")}
    head = [c for c in base.columns if c != "delay_target"]
    tail = [c for c in hist.columns if c not in base.columns and c != prior.T]
    out = hist.select(*[S.col(c) for c in head], *[v.alias(k) for k, v in vols.items()],
                      *[S.col(c) for c in tail], S.col("delay_target"))
    if weather is not None:
        joined = asof.asof_weather(out, weather, key=key, tie_key=tie_key).drop(prior.T)
        flags = asof.derived_flags([c for c in joined.columns if c not in out.columns])
        cols = [c for c in out.columns if c != "delay_target"]
        out = joined.withColumns({f"_wf_{k}": v for k, v in flags.items()}).select(
            *[S.col(c) for c in cols], *[F.col(f"_wf_{k}").alias(k) for k in flags], S.col("delay_target"))
    return out
