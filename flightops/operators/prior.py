"""Point-in-time ("strictly prior") history features.

For a flight departing at minute T in group g, the history is every flight of
g with departure minute < T (flights in the same minute never see each other).

Scalable plan (default): project to the narrow columns, pre-aggregate to a
(group, minute) timeline (partial aggregation absorbs hot groups), run the
two-level day/minute prefix of ``prefix.exclusive_prefix`` (largest window
partition = one group-day = 1440 rows), and equi-join the timeline back on
(group, minute). The plain RANGE-window plan is kept as ``method="window"``:
it is the readable definition and the test oracle, but it sorts a whole group
in one task.

Several dimensions share one *melted* timeline: flights are exploded to
(dimension, key, minute), counted (the only rows that meet are counts), given
one prefix for all dimensions, joined back once and folded to a row a flight.

``availability_lag_minutes`` = L makes a flight's outcome known L minutes after
its departure: the frame of a flight at T ends at T - 1 - L. The timeline then
merges two kinds of events, publications at departure + L, which carry the
counts, and predictions at the departure, which carry none and only read the
running total; without a lag they are the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..session import stage_table
from . import prefix as P

MINUTES_PER_DAY = 1440
T = "dep_minute"


def with_departure_minute(df: DataFrame, date_col: str = "flight_date",
                          time_col: str = "scheduled_dep_time") -> DataFrame:
    if T in df.columns:
        return df
    date_col = date_col if date_col in df.columns else "fl_date"
    time_col = time_col if time_col in df.columns else "crs_dep_time"
    return df.withColumn(T, S.departure_minute(date_col, time_col))


def target_value(target: str) -> Column:
    return F.coalesce(S.to_double(S.col(target)), F.lit(0.0))


def timeline(df: DataFrame, keys: list[str], target: str = "delay_target",
             availability_lag_minutes: int = 0) -> DataFrame:
    """(keys, minute) -> flights n and delayed s published in that minute; with a lag, minutes in which
    only predictions fall come with zeros."""
    keyed = [S.col(k) for k in keys]
    lag = _checked(availability_lag_minutes)
    events = df.select(*keyed, S.col(T) + lag if lag else S.col(T), F.lit(1).alias("n"), target_value(target).alias("s"))
    if lag:
        events = (events.toDF(*keys, T, "n", "s")
                  .unionByName(df.select(*keyed, S.col(T), F.lit(0).alias("n"), F.lit(0.0).alias("s"))))
    return (events.groupBy(*keyed, S.col(T))
            .agg(F.sum("n").cast("long").alias("n"), F.sum("s").alias("s")))


def _checked(lag: int) -> int:
    if lag < 0:
        raise ValueError("availability_lag_minutes must not be negative")
    return lag


def _running(tl: DataFrame, keys: list[str], days: int | None, lag: int, null_safe: bool = True) -> DataFrame:
    """(keys, minute, prior_n, prior_s) of a timeline: all earlier events, or those of the last ``days``."""
    if days is None:
        day = F.floor(F.col(T) / F.lit(MINUTES_PER_DAY))
        return P.exclusive_prefix(tl, keys, T, ["n", "s"], day, null_safe=null_safe).drop("n", "s")
    width = days * MINUTES_PER_DAY - lag  # publications since T - days + lag are departures since T - days
    if width <= 0:
        return tl.withColumns({"prior_n": F.lit(0).cast("long"), "prior_s": F.lit(0.0)}).drop("n", "s")
    return P.block_rolling(tl, keys, T, ["n", "s"], width, prefix="prior_").drop("n", "s")


def prior_timeline(df: DataFrame, keys: list[str], target: str = "delay_target", days: int | None = None,
                   availability_lag_minutes: int = 0) -> DataFrame:
    """(keys, minute, prior_n, prior_s) by the two-level prefix, or over [T - days, T)."""
    lag = availability_lag_minutes
    return _running(timeline(df, keys, target, lag), keys, days, lag)


def prior_stats_window(df: DataFrame, keys: list[str], target: str = "delay_target",
                       days: int | None = None, availability_lag_minutes: int = 0) -> DataFrame:
    """Reference plan: RANGE frame over the flight rows themselves."""
    hi = -1 - _checked(availability_lag_minutes)
    if days is not None and days * MINUTES_PER_DAY < -hi:
        return df.withColumns({"prior_n": F.lit(0).cast("long"), "prior_s": F.lit(0.0)})
    lo = Window.unboundedPreceding if days is None else -days * MINUTES_PER_DAY
    w = Window.partitionBy(*[S.col(k) for k in keys]).orderBy(S.col(T)).rangeBetween(lo, hi)
    return df.withColumns({
        "prior_n": F.coalesce(F.count(F.lit(1)).over(w), F.lit(0)).cast("long"),
        "prior_s": F.coalesce(F.sum(target_value(target)).over(w), F.lit(0.0)),
    })


def attach(df: DataFrame, stats: DataFrame, keys: list[str], rename: dict[str, str]) -> DataFrame:
    """Left-join a (keys, minute) table onto flights (null keys match null)."""
    s = stats.withColumnsRenamed(rename)
    return P.null_safe_join(df, s, keys + [T], how="left")


def prior_group_stats(df: DataFrame, keys: list[str], target: str = "delay_target",
                      method: str = "prefix", days: int | None = None,
                      availability_lag_minutes: int = 0) -> DataFrame:
    """Flights with ``prior_n`` (count) and ``prior_s`` (delayed) columns."""
    df = with_departure_minute(df)
    if method == "window":
        return prior_stats_window(df, keys, target, days, availability_lag_minutes)
    tl = prior_timeline(df, keys, target, days, availability_lag_minutes)
    out = attach(df, tl, keys, {})
    return out.withColumns({"prior_n": F.coalesce(F.col("prior_n"), F.lit(0)).cast("long"),
                            "prior_s": F.coalesce(F.col("prior_s"), F.lit(0.0))})


def latest_prior_minute(df: DataFrame, keys: list[str]) -> DataFrame:
    """Flights with ``latest``: the last departure minute of the same group
    strictly before their own (null if none) -- two-level lag (inside a day,
    then over per-day maxima), used to audit the strictly-prior contract."""
    df = with_departure_minute(df)
    tl = df.select(*[S.col(k) for k in keys], S.col(T)).distinct()
    day = F.floor(F.col(T) / F.lit(MINUTES_PER_DAY))
    tl = tl.withColumn("_day", day)
    inner = F.lag(T).over(Window.partitionBy(*keys, "_day").orderBy(T))
    tl = tl.withColumn("_prev_in_day", inner)
    days = tl.groupBy(*keys, "_day").agg(F.max(T).alias("_day_max"))
    days = days.withColumn("_prev_day_max", F.lag("_day_max").over(Window.partitionBy(*keys).orderBy("_day")))
    tl = P.null_safe_join(tl, days.drop("_day_max"), keys + ["_day"])
    tl = tl.select(*keys, T, F.coalesce("_prev_in_day", "_prev_day_max").alias("latest"))
    return attach(df, tl, keys, {})


def global_prior_rate(df: DataFrame, target: str = "delay_target", availability_lag_minutes: int = 0) -> DataFrame:
    """(minute, global_prior_rate): delayed share of all flights before the
    minute; null when there is none. Two-level prefix, no single-task window
    over flights (the only unpartitioned window runs over per-day totals)."""
    tl = prior_timeline(with_departure_minute(df), [], target, availability_lag_minutes=availability_lag_minutes)
    return tl.select(T, F.when(F.col("prior_n") > 0, F.try_divide(F.col("prior_s"), F.col("prior_n")))
                     .alias("global_prior_rate"))


# ---------------------------------------------------------------------------
# feature tables
# ---------------------------------------------------------------------------

def _fallback(fallback: str, global_rate: Column, null_to_zero: bool) -> Column:
    if fallback == "global_prior":
        return F.coalesce(global_rate, F.lit(0.0)) if null_to_zero else global_rate
    if fallback == "nan":
        return F.lit(None).cast("double")
    return F.lit(float(fallback))


def rate_with_fallback(n: Column, s: Column, min_history: int, fallback: str, global_rate: Column,
                       null_to_zero: bool) -> Column:
    rate = F.when(n >= min_history, F.try_divide(s, n)).otherwise(_fallback(fallback, global_rate, null_to_zero))
    return S.round_half_even(rate, 4)


P3_DIMENSIONS = [
    ("prior_airline", ["airline"]),
    ("prior_origin", ["origin_airport"]),
    ("prior_dest", ["dest_airport"]),
    ("prior_route", ["route"]),
    ("prior_airline_dep_hour", ["airline", "_dep_hour"]),
    ("prior_origin_dep_hour", ["origin_airport", "_dep_hour"]),
]

A2_DIMENSIONS = [
    ("historical_origin", ["origin_airport"]),
    ("historical_destination", ["dest_airport"]),
    ("historical_airline", ["airline"]),
    ("historical_route", ["route"]),
]

# alias names of the P3 table: alias -> source column
P3_ALIASES: list[tuple[str, str]] = []
for _alias_pfx, _src in [("carrier_prior", "prior_airline"), ("airline_prior", "prior_airline"),
                         ("origin_prior", "prior_origin"), ("dest_prior", "prior_dest"),
                         ("route_prior", "prior_route"),
                         ("carrier_origin_hour_prior", "prior_airline_dep_hour"),
                         ("airline_dep_hour_prior", "prior_airline_dep_hour")]:
    for _m in ("flight_count", "delay_count", "delay_rate"):
        P3_ALIASES.append((f"{_alias_pfx}_{_m}", f"{_src}_{_m}"))


SHORT_NAMES = {"airline": "carrier", "origin_airport": "origin", "dest_airport": "dest",
               "scheduled_dep_time": "crs_dep_time", "flight_date": "fl_date"}


def resolve(df: DataFrame) -> dict[str, str]:
    """Canonical name -> column present (canonical first, else the short header)."""
    return {c: (c if c in df.columns else s if s in df.columns else c) for c, s in SHORT_NAMES.items()}


def _dims(dims, names: dict[str, str]):
    return [(n, [names.get(k, k) for k in ks]) for n, ks in dims]


def _prepare(df: DataFrame, wrap_hour: bool) -> DataFrame:
    names = resolve(df)
    df = with_departure_minute(df, names["flight_date"], names["scheduled_dep_time"])
    add = {}
    if "route" not in df.columns:
        add["route"] = F.concat_ws("_", S.col(names["origin_airport"]).cast("string"),
                                   S.col(names["dest_airport"]).cast("string"))
    dep = names["scheduled_dep_time"]
    if "departure_hour" in df.columns:
        add["_dep_hour"] = S.col("departure_hour")
    elif dep not in df.columns:
        add["_dep_hour"] = F.lit(12)
    elif wrap_hour:
        add["_dep_hour"] = S.hhmm_parts(S.col(dep))[0]
    else:
        add["_dep_hour"] = S.raw_hour(S.col(dep))
    return df.withColumns(add)


#: A missing minute sorts before all others.
_NO_MINUTE = -(1 << 60)


def melted_timeline(df: DataFrame, dims, target: str = "delay_target", days: int | None = None,
                    availability_lag_minutes: int = 0) -> DataFrame:
    """(dim, dim_key, minute, prior_n, prior_s) for all dimensions at once.

    dims: lists of key columns; ``dim`` is the place in the list and ``dim_key`` the key's values as text.
    """
    lag = _checked(availability_lag_minutes)
    at = F.coalesce(S.col(T), F.lit(_NO_MINUTE))
    flights = df.select(_melted(dims).alias("d"), at.alias(T), target_value(target).alias("s"))
    known = F.when(F.col(T) > _NO_MINUTE, F.col(T) + lag).otherwise(F.col(T)) if lag else F.col(T)
    events = flights.select("d.*", known.alias(T), F.lit(1).alias("n"), "s")
    if lag:
        events = events.unionByName(flights.select("d.*", T, F.lit(0).alias("n"), F.lit(0.0).alias("s")))
    tl = events.groupBy("dim", "dim_key", T).agg(F.sum("n").cast("long").alias("n"), F.sum("s").alias("s"))
    tl = stage_table(tl, "timeline_counts")  # the prefix reads it twice
    return _running(tl, ["dim", "dim_key"], days, lag, null_safe=False)


def _dim_keys(dims) -> list[Column]:
    return [F.array(*[S.col(k).cast("string") for k in ks]).cast("array<string>").alias(f"_key_{i}") for i, ks in enumerate(dims)]


def _melted(dims) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(i).alias("dim"), k.alias("dim_key")) for i, k in enumerate(_dim_keys(dims))]))


def _carriers(all_dims) -> dict[int, list[int]]:
    """Dimensions that flights meet -> the dimensions whose sums their timelines bring along: those with fewer key
    columns, all of them among their own. A (group, minute) has one sum of any coarser group."""
    out: dict[int, list[int]] = {}
    for i in sorted(range(len(all_dims)), key=lambda i: -len(all_dims[i])):
        finer = [j for j in out if set(all_dims[i]) < set(all_dims[j])]
        if finer:
            out[finer[0]].append(i)  # the finest
        else:
            out[i] = []
    return out


def _carrying(tl: DataFrame, all_dims, i: int, coarser: list[int]) -> DataFrame:
    """(_key, _min, _n, _s of dimension i and of the coarser ones) a (group, minute) of dimension i."""
    def dim(j: int, key: str, at: str) -> DataFrame:
        return tl.where(F.col("dim") == j).select(F.col("dim_key").alias(key), F.col(T).alias(at), F.col("prior_n").alias(f"_n{j}"), F.col("prior_s").alias(f"_s{j}"))

    out = dim(i, "_key", "_min")
    for j in coarser:
        part = F.array(*[F.col("_key")[all_dims[i].index(k)] for k in all_dims[j]]).cast("array<string>")
        out = out.join(dim(j, "_ckey", "_cmin"), (part == F.col("_ckey")) & (F.col("_min") == F.col("_cmin")), "left").drop("_ckey", "_cmin")
    return out


def _history(df: DataFrame, dims, target: str, key: list[str] | None, method: str, days: int | None = None,
             stage: bool = True, lag: int = 0) -> tuple[DataFrame, dict[str, tuple[str, str]]]:
    """Attach (prior_n, prior_s) for every dimension plus the global prior rate.

    The narrow projection (unique ``key``, or the distinct group columns and
    minutes; group columns, minute, target) meets the written timelines of the
    finest dimensions, one by one, which bring the sums of the coarser ones
    along, and is joined to the wide table once. With a key it is staged as a
    written table first."""
    group_cols = sorted({c for _, ks in dims for c in ks})
    names: dict[str, tuple[str, str]] = {f"{name}": (f"_{name}_n", f"_{name}_s") for name, _ in dims}
    if method == "window":
        out = df
        for name, ks in dims:
            n_col, s_col = names[name]
            out = prior_stats_window(out, ks, target, days, lag).withColumnsRenamed({"prior_n": n_col, "prior_s": s_col})
        g = global_prior_rate(df, target, lag)
        return out.join(g, on=T, how="left"), names
    narrow = df.select(*[S.col(c) for c in dict.fromkeys([*(key or []), *group_cols])], S.col(T), S.col(target))
    if key and stage:
        narrow = stage_table(narrow, "history_input")
    all_dims = [ks for _, ks in dims] + [[]]  # the last is the whole table
    row = key or [*group_cols, T]
    asked = narrow if key else narrow.select(*[S.col(c) for c in row]).distinct()
    used = list(dict.fromkeys(c for c in [*row, *group_cols]))
    asked = asked.select(*[S.col(c).alias(f"_row_{c}") for c in used], F.coalesce(S.col(T), F.lit(_NO_MINUTE)).alias("_at"))
    if days is None:
        tl = melted_timeline(narrow, all_dims, target, None, lag)
    else:  # the fallback rate is over the whole past
        tl = (melted_timeline(narrow, all_dims, target, days, lag).where(F.col("dim") < len(dims))
              .unionByName(melted_timeline(narrow, [[]], target, None, lag).withColumn("dim", F.lit(len(dims)))))
    tl = stage_table(tl, "timeline")
    carried = _carriers(all_dims)
    for i in sorted(carried, key=lambda i: -len(all_dims[i])):  # one row a flight; a small timeline is broadcast
        one = _carrying(tl, all_dims, i, carried[i])
        own = F.array(*[F.col(f"_row_{k}").cast("string") for k in all_dims[i]]).cast("array<string>")
        asked = asked.join(one, (own == F.col("_key")) & (F.col("_at") == F.col("_min")), "left").drop("_key", "_min")
    folded = asked.groupBy(*[f"_row_{c}" for c in row]).agg(*[
        F.max(F.struct(F.col(f"_n{i}").alias("prior_n"), F.col(f"_s{i}").alias("prior_s"))).alias(f"_d{i}") for i in range(len(all_dims))])
    last = F.col(f"_d{len(dims)}")
    fixed = []
    for i, (name, _) in enumerate(dims):
        n_col, s_col = names[name]
        fixed += [F.coalesce(F.col(f"_d{i}.prior_n"), F.lit(0)).cast("long").alias(n_col),
                  F.coalesce(F.col(f"_d{i}.prior_s"), F.lit(0.0)).alias(s_col)]
    rate = F.when(last["prior_n"] > 0, F.try_divide(last["prior_s"], last["prior_n"])).alias("global_prior_rate")
    out = folded.select(*[F.col(f"_row_{c}").alias(c) for c in row], *fixed, rate)
    if key:
        return df.join(out, on=key, how="inner"), names
    return P.null_safe_join(df, out, row, how="left"), names


def history_p3(df: DataFrame, target: str = "delay_target", min_history: int = 3,
               fallback: str = "global_prior", key: list[str] | None = None, wrap_hour: bool = True,
               with_aliases: bool = True, method: str = "prefix", dims: list[str] | None = None,
               availability_lag_minutes: int = 0) -> DataFrame:
    """H6 (+H7 aliases): per dimension flight count, delay count and rate.
    Fewer than ``min_history`` prior flights -> strictly prior global rate,
    0.0 when there is no prior flight at all. ``dims`` restricts the
    dimensions (e.g. ["prior_origin"]); aliases need all of them."""
    df = _prepare(df, wrap_hour)
    chosen = _dims([d for d in P3_DIMENSIONS if dims is None or d[0] in dims], resolve(df))
    with_aliases = with_aliases and dims is None
    out, names = _history(df, chosen, target, key, method, lag=availability_lag_minutes)
    g = F.col("global_prior_rate")
    cols = {}
    for name, (n_col, s_col) in names.items():
        n, s = F.col(n_col), F.col(s_col)
        cols[f"{name}_flight_count"] = n.cast("int")
        cols[f"{name}_delay_count"] = s.cast("int")
        cols[f"{name}_delay_rate"] = rate_with_fallback(n, s, min_history, fallback, g, null_to_zero=True)
    out = out.withColumns(cols)
    if with_aliases:
        out = out.withColumns({a: F.col(src) for a, src in P3_ALIASES})
    drop = [c for pair in names.values() for c in pair] + ["global_prior_rate", "_dep_hour"]
    return out.drop(*drop)


def history_2a(df: DataFrame, target: str = "delay_target", min_history: int = 3,
               fallback: str = "global_prior", key: list[str] | None = None, days: int | None = None,
               method: str = "prefix", availability_lag_minutes: int = 0) -> DataFrame:
    """H5: origin / destination / airline / route rate (fallback keeps null
    when there is no prior flight at all) and count."""
    df = _prepare(df, True)
    out, names = _history(df, _dims(A2_DIMENSIONS, resolve(df)), target, key, method, days, lag=availability_lag_minutes)
    g = F.col("global_prior_rate")
    cols = {}
    for name, (n_col, s_col) in names.items():
        n, s = F.col(n_col), F.col(s_col)
        cols[f"{name}_delay_rate"] = rate_with_fallback(n, s, min_history, fallback, g, null_to_zero=False)
        cols[f"{name}_flight_count"] = n.cast("int")
    drop = [c for pair in names.values() for c in pair] + ["global_prior_rate", "_dep_hour"]
    return out.withColumns(cols).drop(*drop)


def prior_volumes(df: DataFrame, target: str = "delay_target", key: list[str] | None = None,
                  method: str = "prefix", availability_lag_minutes: int = 0) -> DataFrame:
    """Prior route frequency, origin/destination volumes and the raw
    (no fallback, 0.0 when empty) origin/destination delay rates."""
    df = _prepare(df, True)
    dims = _dims([("route", ["route"]), ("origin", ["origin_airport"]), ("dest", ["dest_airport"])], resolve(df))
    out, names = _history(df, dims, target, key, method, lag=availability_lag_minutes)

    def raw_rate(n_col, s_col):
        n, s = F.col(n_col), F.col(s_col)
        return S.round_half_even(F.when(n > 0, F.try_divide(s, n)).otherwise(F.lit(0.0)), 4)
    cols = {"prior_route_frequency": F.col(names["route"][0]),
            "prior_origin_flight_volume": F.col(names["origin"][0]),
            "prior_dest_flight_volume": F.col(names["dest"][0]),
            "prior_origin_delay_rate": raw_rate(*names["origin"]),
            "prior_dest_delay_rate": raw_rate(*names["dest"])}
    drop = [c for pair in names.values() for c in pair] + ["global_prior_rate", "_dep_hour"]
    return out.withColumns(cols).drop(*drop)


def coverage(history: DataFrame, min_history: int = 3) -> DataFrame:
    """H8: per dimension, flights with no / insufficient / sufficient history."""
    dims = [name for name, _ in P3_DIMENSIONS]
    long = history.select(F.explode(F.array(*[
        F.struct(F.lit(d).alias("dimension"), F.col(f"{d}_flight_count").alias("n")) for d in dims
    ])).alias("x")).select("x.*")
    total = F.count(F.lit(1))
    out = long.groupBy("dimension").agg(
        total.cast("long").alias("total_records"),
        F.count_if(F.col("n") == 0).cast("long").alias("no_history_count"),
        F.count_if((F.col("n") > 0) & (F.col("n") < min_history)).cast("long").alias("insufficient_history_count"),
        F.count_if(F.col("n") >= min_history).cast("long").alias("sufficient_history_count"))
    for k in ("no_history", "insufficient_history", "sufficient_history"):
        out = out.withColumn(f"{k}_pct", S.round_half_even(F.col(f"{k}_count") * 100.0 /
                                                  F.greatest(F.col("total_records"), F.lit(1)), 2))
    return out
