"""Descriptive profiling (A1-A32) as single-pass aggregations.

Wide audits compute every column's statistic inside one ``agg`` and
``unpivot`` the one-row result; there is never one job per column and never
several ``count(DISTINCT)`` in one aggregate (which would multiply rows
through an Expand). Percentiles are exact and distributed (``quantiles``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..functions import scalar as S
from ..functions.scalar import col
from . import prefix as P
from . import quality
from . import ranks as R

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _r(c: Column, dp: int = 4) -> Column:
    return S.round_half_even(c, dp)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows minus distinct rows; only rows whose hash repeats are compared at full width."""
    n = F.col(quality.COPIES)
    return quality.copy_counts(df).agg(F.coalesce(F.sum(n - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def overview(df: DataFrame, key: list[str] | None = None) -> DataFrame:
    """A1: rows, columns, numeric / categorical counts, columns by type and
    duplicate rows; the row key is no feature and would hide duplicates."""
    df = df.drop(*(key or []))
    kinds = sorted({f.dataType.simpleString() for f in df.schema.fields})
    n_of = {k: sum(f.dataType.simpleString() == k for f in df.schema.fields) for k in kinds}
    rows = df.agg(F.count(F.lit(1)).cast("long").alias("total_records"))
    d = duplicate_rows(df)
    return (P.null_safe_join(rows, d, [])
            .withColumns({"total_features": F.lit(len(df.columns)), "numeric_columns": F.lit(len(numeric_columns(df))),
                          "categorical_columns": F.lit(len(string_columns(df))),
                          "dtypes": F.lit(", ".join(f"{k}: {n_of[k]}" for k in kinds))}))


def column_audit(df: DataFrame) -> DataFrame:
    """A2/A23/A24 core: per column nulls, null %, constant flag (one value
    including null: all null, or no null and min = max), in one pass."""
    aggs = [F.count(F.lit(1)).cast("long").alias("_rows")]
    for c in df.columns:
        aggs += [F.count_if(col(c).isNull()).cast("long").alias(f"{c}__nulls"),
                 F.min(col(c)).cast("string").alias(f"{c}__min"),
                 F.max(col(c)).cast("string").alias(f"{c}__max")]
    wide = df.agg(*aggs)
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}__nulls`").alias("nulls"),
                        F.col(f"`{c}__min`").alias("mn"), F.col(f"`{c}__max`").alias("mx"))
               for c in df.columns]
    long = wide.select("_rows", F.explode(F.array(*entries)).alias("e")).select("_rows", "e.*")
    rows, nulls = F.col("_rows"), F.col("nulls")
    const = (nulls == rows) | ((nulls == 0) & (F.col("mn") == F.col("mx")))
    return long.select("column_name", nulls.alias("missing_count"),
                       _r(nulls.cast("double") * 100.0 / F.greatest(rows, F.lit(1)), 2).alias("missing_pct"),
                       F.coalesce(const, F.lit(False)).alias("is_constant"))


def constant_columns(df: DataFrame) -> list[str]:
    """Data-detected constant columns (a bounded list on the driver)."""
    return [r["column_name"] for r in column_audit(df).filter("is_constant").collect()]


def negative_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = [c for c in (cols or ["distance", "route_distance", "prior_origin_flight_volume",
                                  "prior_dest_flight_volume"]) if c in df.columns]
    wide = df.agg(*[F.count_if(col(c) < 0).cast("long").alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "negative_count")


def target_balance(df: DataFrame, target: str = "delay_target") -> DataFrame:
    y = col(target)
    a = df.agg(F.count(F.lit(1)).cast("long").alias("total_observations"),
               F.count_if(y == 1).cast("long").alias("delayed_count"),
               F.count_if(y == 0).cast("long").alias("on_time_count"))
    n, d, o = F.col("total_observations"), F.col("delayed_count"), F.col("on_time_count")
    return a.withColumns({"delay_rate": _r(d / n), "on_time_rate": _r(o / n),
                          "imbalance_ratio": F.when(d > 0, _r(o / d, 2)).otherwise(F.lit(math.inf))})


def group_rates(df: DataFrame, key: Column | str, target: str = "delay_target", name: str | None = None) -> DataFrame:
    """count, delayed count and delay rate (4 dp) per key."""
    k = col(key) if isinstance(key, str) else key
    name = name or (key if isinstance(key, str) else "key")
    y = col(target).cast("double")
    return df.groupBy(k.alias(name)).agg(F.count(F.lit(1)).cast("long").alias("flight_count"),
                                         F.sum(col(target).cast("long")).alias("delay_count"),
                                         _r(F.avg(y)).alias("delay_rate"))


def reindex(stats: DataFrame, name: str, order: list[str]) -> DataFrame:
    """Left join from a literal ordered dimension; missing -> 0."""
    spark = stats.sparkSession
    dim = spark.createDataFrame([(v, i) for i, v in enumerate(order)], f"{name} string, position int")
    j = F.broadcast(dim).join(stats, name, "left")   # literal table: size fixed by the category list
    return j.select(name, "position", *[F.coalesce(F.col(c), F.lit(0)).alias(c)
                                        for c in ("flight_count", "delay_count", "delay_rate")])


def by_day_of_week(df: DataFrame, target: str = "delay_target") -> DataFrame:
    d = S.to_date(col("flight_date"))
    return reindex(group_rates(df, F.date_format(d, "EEEE"), target, "day_of_week"), "day_of_week",
                   config.DAY_NAMES)


def by_weekend(df: DataFrame, target: str = "delay_target") -> DataFrame:
    d = S.to_date(col("flight_date"))
    return group_rates(df, (F.weekday(d) >= 5).cast("int"), target, "is_weekend")


def by_time_of_day(df: DataFrame, target: str = "delay_target") -> DataFrame:
    return reindex(group_rates(df, "dep_time_of_day", target), "dep_time_of_day",
                   ["morning", "afternoon", "evening", "night"])


def by_time_bucket(df: DataFrame, target: str = "delay_target") -> DataFrame:
    return reindex(group_rates(df, "dep_time_bucket", target), "dep_time_bucket", config.TIME_BUCKETS_4H)


def by_date(df: DataFrame, target: str = "delay_target") -> DataFrame:
    return group_rates(df, "flight_date", target)


def date_range(df: DataFrame) -> DataFrame:
    d = S.to_date(col("flight_date"))
    return df.agg(F.min(d).cast("string").alias("date_range_start"), F.max(d).cast("string").alias("date_range_end"),
                  F.count_distinct(d).cast("long").alias("total_calendar_days"))


def airlines(df: DataFrame, target: str = "delay_target") -> DataFrame:
    """Per airline volume and shares of all flights / all delays."""
    g = group_rates(df, "airline", target)
    tot = df.agg(F.count(F.lit(1)).alias("_tf"), F.sum(col(target).cast("long")).alias("_td"))
    j = P.null_safe_join(g, tot, [])   # one-row totals table
    return j.select("airline", "flight_count", "delay_count", "delay_rate",
                    _r(F.col("flight_count") / F.col("_tf") * 100, 2).alias("volume_share_pct"),
                    _r(F.col("delay_count") / F.col("_td") * 100, 2).alias("delay_share_pct"))


def routes(df: DataFrame, min_n: int = 5, target: str = "delay_target") -> DataFrame:
    """A10: routes with at least ``min_n`` flights (sorted n desc, rate desc)."""
    g = group_rates(df, "route", target)
    return g.filter(F.col("flight_count") >= min_n).orderBy(F.desc("flight_count"), F.desc("delay_rate"))


def route_sparsity(df: DataFrame, min_n: int = 5) -> DataFrame:
    g = df.groupBy("route").agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.count(F.lit(1)).cast("long").alias("total_unique_routes"),
                 F.count_if(F.col("n") >= min_n).cast("long").alias("frequent_routes_count"),
                 F.count_if(F.col("n") < min_n).cast("long").alias("sparse_routes_count")).withColumn(
        "sparse_routes_pct", _r(F.col("sparse_routes_count") * 100.0 / F.col("total_unique_routes"), 2))


def _long(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, value double) for the listed numeric columns, nulls dropped."""
    return (df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                                   col(c).cast("double").alias("v")) for c in cols])).alias("e"))
            .select("e.*").filter(F.col("v").isNotNull()))


def quantiles(long: DataFrame, keys: list[str], probs: list[float], value: str = "v") -> DataFrame:
    """`keys` and `q`, the exact linearly interpolated percentiles of each group.

    Equal values are counted, the counts of all groups are ranked in one order of sampled ranges, and only the
    ranges that hold a wanted rank are looked into. Neither a group nor a crowded stretch of values is one task."""
    counts = long.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    order = R.ranked(counts, keys, [F.col(value).asc()], "_n", "quantiles")
    spots = order.totals().select(*keys, F.posexplode(F.array(*[
        (F.col("_total") - 1) * F.lit(float(p)) for p in probs])).alias("_i", "_spot"))
    ends = spots.select(*keys, "_i", "_spot", F.explode(F.array_distinct(F.array(F.floor("_spot"), F.ceil("_spot")))).alias("_want"))
    found = order.at(ends.withColumn("_share", F.when(F.col("_want") == F.floor("_spot"), 1 - (F.col("_spot") - F.floor("_spot")))
                                     .otherwise(F.col("_spot") - F.floor("_spot"))))
    low, high = (f(F.struct("_want", F.col(value).alias("x"), "_share")) for f in (F.min, F.max))
    at = found.groupBy(*keys, "_i").agg(low.alias("_a"), high.alias("_b"))
    q = F.col("_a.x") + (F.col("_b.x") - F.col("_a.x")) * F.when(F.col("_a._want") == F.col("_b._want"), 0.0).otherwise(F.col("_b._share"))
    return at.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_i", q.alias("x")))).alias("_q")).select(
        *keys, F.col("_q.x").alias("q"))


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, mean, sample std, min, quartiles, max (4 dp) per column."""
    long, v = _long(df, [c for c in cols if c in df.columns]), F.col("v")
    g = long.groupBy("column_name").agg(
        F.count(v).cast("long").alias("count"), _r(F.avg(v)).alias("mean"), _r(F.stddev_samp(v)).alias("std"),
        _r(F.min(v)).alias("min"), _r(F.max(v)).alias("max"))
    q = quantiles(long, ["column_name"], [0.25, 0.5, 0.75])
    return g.join(q, "column_name").select("column_name", "count", "mean", "std", "min", _r(F.col("q")[0]).alias("q25"),
                                           _r(F.col("q")[1]).alias("q50"), _r(F.col("q")[2]).alias("q75"), "max")


def numeric_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """+ median, IQR and bias-corrected skewness (pandas ``skew``)."""
    long, v = _long(df, [c for c in cols if c in df.columns]), F.col("v")
    g = long.groupBy("column_name").agg(
        F.count(v).alias("_n"), F.avg(v).alias("_mean"), F.stddev_samp(v).alias("_std"), F.min(v).alias("_min"),
        F.max(v).alias("_max"), F.skewness(v).alias("_g1"))
    g = g.join(quantiles(long, ["column_name"], [0.25, 0.5, 0.75]), "column_name")
    n, q = F.col("_n").cast("double"), F.col("q")
    skew = F.when(n > 2, F.col("_g1") * F.sqrt(n * (n - 1)) / (n - 2))
    return g.select("column_name", F.col("_n").cast("long").alias("count"), _r(F.col("_mean")).alias("mean"),
                    _r(F.col("_std")).alias("std"), _r(q[1]).alias("median"), _r(F.col("_min")).alias("min"),
                    _r(F.col("_max")).alias("max"), _r(q[0]).alias("q25"), _r(q[2]).alias("q75"),
                    _r(q[2] - q[0]).alias("iqr"), _r(skew).alias("skewness"))


def _moments(df: DataFrame, cols: list[str]) -> DataFrame:
    """(i, j, n, si, sj, sii, sjj, sij) for every pair i <= j of columns that
    vary, over the rows where both are present. Values are shifted by their
    column's mean (one number a column, from a first pass) so that the sums
    keep their digits; each Arrow batch gives one matrix product, and the
    partial sums, one row a pair and task, are added by Spark."""
    first = df.agg(*[F.avg(col(c).cast("double")).alias(f"m__{c}") for c in cols],
                   *[(F.min(col(c)) < F.max(col(c))).alias(f"v__{c}") for c in cols]).first()
    use = [c for c in cols if first[f"v__{c}"]]
    shift = [float(first[f"m__{c}"]) for c in use]

    def run(parts):
        import numpy as np
        import pyarrow as pa
        i, j = np.triu_indices(len(use))
        total = np.zeros((6, len(i)))
        for part in parts:
            x = np.column_stack([part.column(k).to_numpy(zero_copy_only=False).astype(float) for k in range(len(use))])
            here = ~np.isnan(x)
            x = np.where(here, x - shift, 0.0)
            m = here.astype(float)
            n, s, q = m.T @ m, x.T @ m, (x * x).T @ m
            total += np.stack([n[i, j], s[i, j], s[j, i], q[i, j], q[j, i], (x.T @ x)[i, j]])
        if len(i):
            yield pa.RecordBatch.from_arrays([pa.array(i.astype("int32")), pa.array(j.astype("int32")), *map(pa.array, total)],
                                             names=["i", "j", "n", "si", "sj", "sii", "sjj", "sij"])

    if not use:
        return df.sparkSession.createDataFrame([], "feature_1 string, feature_2 string, r double")
    made = df.select(*[col(c).cast("double") for c in use]).mapInArrow(
        run, "i int, j int, n double, si double, sj double, sii double, sjj double, sij double")
    sums = made.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "si", "sj", "sii", "sjj", "sij")])
    cov, vi, vj = (F.col(q) - F.col(a) * F.col(b) / F.col("n") for q, a, b in (("sij", "si", "sj"), ("sii", "si", "si"), ("sjj", "sj", "sj")))
    names = F.array(*[F.lit(c) for c in use])
    r = F.when((F.col("n") > 1) & (vi > 0) & (vj > 0), cov / F.sqrt(vi * vj))
    return sums.select(F.get(names, "i").alias("feature_1"), F.get(names, "j").alias("feature_2"), r.alias("r"))


def target_correlations(df: DataFrame, cols: list[str], target: str = "delay_target") -> DataFrame:
    """Pearson r of each numeric column that varies with the target."""
    cols = [c for c in cols if c in df.columns and c != target]
    m = _moments(df, [*cols, target]).filter((F.col("feature_2") == target) & (F.col("feature_1") != target))
    return m.select(F.col("feature_1").alias("feature"), _r(F.col("r")).alias("correlation"))


def correlation_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """A31 / A14 input: Pearson r for every unordered pair of columns that vary."""
    m = _moments(df, [c for c in cols if c in df.columns]).filter(F.col("feature_1") != F.col("feature_2"))
    return m.select("feature_1", "feature_2", _r(F.col("r")).alias("correlation"))


def collinear_pairs(df: DataFrame, cols: list[str], threshold: float = 0.85) -> DataFrame:
    """Pairs with |r| of at least the threshold, before rounding."""
    m = _moments(df, [c for c in cols if c in df.columns])
    return (m.filter((F.col("feature_1") != F.col("feature_2")) & (F.abs(F.col("r")) >= threshold))
            .select("feature_1", "feature_2", _r(F.col("r")).alias("correlation")))


def outliers(df: DataFrame, cols: list[str]) -> DataFrame:
    """Tukey fences from exact quartiles, then counts in a second pass
    (the bounds table has one row per column and is broadcast)."""
    cols = [c for c in cols if c in df.columns]
    long = _long(df, cols)
    b = quantiles(long, ["column_name"], [0.25, 0.75]).join(long.groupBy("column_name").agg(F.count("v").alias("n")), "column_name")
    b = b.select("column_name", "n", F.col("q")[0].alias("q25"), F.col("q")[1].alias("q75"))
    b = b.withColumns({"lo": F.col("q25") - 1.5 * (F.col("q75") - F.col("q25")),
                       "hi": F.col("q75") + 1.5 * (F.col("q75") - F.col("q25"))})
    j = long.join(F.broadcast(b), "column_name")
    out = F.col("v") < F.col("lo")
    out = out | (F.col("v") > F.col("hi"))
    return j.groupBy("column_name").agg(
        _r(F.first("lo"), 2).alias("lower_bound"), _r(F.first("hi"), 2).alias("upper_bound"),
        F.count_if(out).cast("long").alias("outlier_count"),
        _r(F.count_if(out) * 100.0 / F.first("n"), 2).alias("outlier_pct"),
        _r(F.min(F.when(out, F.col("v"))), 2).alias("min_outlier"),
        _r(F.max(F.when(out, F.col("v"))), 2).alias("max_outlier"))


def delay_percentiles(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """min/max/mean/median/p90/p95/p99 of delay minutes (1 dp)."""
    cols = [c for c in (cols or ["arrival_delay", "departure_delay"]) if c in df.columns]
    v = F.col("v")
    long = _long(df, cols)
    g = long.groupBy("column_name").agg(F.min(v).alias("mn"), F.max(v).alias("mx"), F.avg(v).alias("mean"))
    g = g.join(quantiles(long, ["column_name"], [0.5, 0.9, 0.95, 0.99]).withColumnRenamed("q", "p"), "column_name")
    return g.select("column_name", _r(F.col("mn"), 1).alias("min"), _r(F.col("mx"), 1).alias("max"),
                    _r(F.col("mean"), 1).alias("mean"), _r(F.col("p")[0], 1).alias("median"),
                    _r(F.col("p")[1], 1).alias("p90"), _r(F.col("p")[2], 1).alias("p95"),
                    _r(F.col("p")[3], 1).alias("p99"))


def top_groups(df: DataFrame, key: str, min_n: int, k: int, target: str = "delay_target", by: str = "rate") -> DataFrame:
    """The top k groups among those with at least min_n flights, by
    unrounded delay rate or by volume and then rate (ties go to the smaller
    key) -- a TakeOrdered, the limit is the feature."""
    g = group_rates(df, key, target).filter(F.col("flight_count") >= min_n)
    order = [F.desc(F.col("delay_count") / F.col("flight_count")), F.asc(key)]
    if by == "volume":
        order.insert(0, F.desc("flight_count"))
    return g.orderBy(*order).limit(k)


def distribution_by_target(df: DataFrame, cols: list[str], target: str = "delay_target") -> DataFrame:
    """Box-plot numbers per class."""
    cols = [c for c in cols if c in df.columns]
    long = df.select(col(target).alias("target"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), col(c).cast("double").alias("v")) for c in cols])).alias("e")) \
        .select("target", "e.*").filter(F.col("v").isNotNull())
    g = long.groupBy("target", "column_name").agg(F.count("v").cast("long").alias("n"), F.min("v").alias("mn"),
                                                  F.max("v").alias("mx"))
    q = quantiles(long, ["target", "column_name"], [0.25, 0.5, 0.75]).withColumnRenamed("q", "p")
    g = P.null_safe_join(g, q, ["target", "column_name"])
    return g.select("target", "column_name", "n", _r(F.col("mn")).alias("min"), _r(F.col("p")[0]).alias("q25"),
                    _r(F.col("p")[1]).alias("median"), _r(F.col("p")[2]).alias("q75"), _r(F.col("mx")).alias("max"))


def rate_histogram(df: DataFrame, cols: list[str], bins: int = 20) -> DataFrame:
    """Equal-width bins over each column's own min..max, the maximum in
    the last bin; a constant column gets a range of one around it."""
    cols = [c for c in cols if c in df.columns]
    long = _long(df, cols)
    ends = long.groupBy("column_name").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    ends = ends.select("column_name", F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
                       F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
    share = (F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo"))
    b = F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int")
    return (long.join(F.broadcast(ends), "column_name")  # one row a column
            .groupBy("column_name", b.alias("bin")).agg(F.count(F.lit(1)).cast("long").alias("n")))


def kpi_overview(annotated: DataFrame) -> DataFrame:
    """Flights, delay rate (valid), average arrival delay, cancellation rate."""
    valid = F.col("_is_valid_completed")
    delay = S.to_double(col("arrival_delay"))
    return annotated.agg(
        F.count(F.lit(1)).cast("long").alias("flights"),
        _r(F.count_if(valid & (delay >= 15)) / F.greatest(F.count_if(valid), F.lit(1))).alias("delay_rate"),
        _r(F.avg(F.when(valid, delay)), 2).alias("avg_arrival_delay"),
        _r(F.count_if(F.col("_is_cancelled")) / F.count(F.lit(1))).alias("cancellation_rate"))


def hotspot_matrix(df: DataFrame, target: str = "delay_target") -> DataFrame:
    """Origin x departure-hour delay rate (long form)."""
    y = col(target).cast("double")
    return df.groupBy("origin_airport", "departure_hour").agg(F.count(F.lit(1)).cast("long").alias("flights"),
                                                             _r(F.avg(y)).alias("delay_rate"))


def categorical_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Distinct values, mode and mode count per string column (nulls
    not counted; ties -> smallest value). One unpivot and one
    (column, value) count feed both results."""
    cols = cols or string_columns(df)
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), col(c).alias("value"))
                                         for c in cols])).alias("e")).select("e.*")
    vc = long.filter(F.col("value").isNotNull()).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    distinct = vc.groupBy("column_name").agg(F.count(F.lit(1)).cast("long").alias("distinct_values"))
    return distinct.join(_modes(vc), "column_name")


def _modes(vc: DataFrame) -> DataFrame:
    """Most frequent value per column; ties go to the smallest value."""
    top = vc.groupBy("column_name").agg(F.max("n").alias("mode_count"))
    j = vc.join(top, "column_name").filter(F.col("n") == F.col("mode_count"))
    return j.groupBy("column_name").agg(F.min("value").alias("mode"), F.first("mode_count").cast("long").alias("mode_count"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Counts with share % of the total."""
    g = df.groupBy(col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).cast("long").alias("n"))
    tot = df.agg(F.count(F.lit(1)).alias("_t"))
    return P.null_safe_join(g, tot, []).select(
        "value", "n", _r(F.col("n") * 100.0 / F.col("_t"), 2).alias("share_pct"))


def cyclical_identity(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Min / max of sin^2 + cos^2 for each pair (6 dp)."""
    aggs = []
    for s_, c_ in pairs:
        e = col(s_) * col(s_) + col(c_) * col(c_)
        aggs += [_r(F.min(e), 6).alias(f"{s_}_min"), _r(F.max(e), 6).alias(f"{s_}_max")]
    return df.agg(*aggs)


def _confirmed(df: DataFrame, twins: dict[str, str]) -> dict[str, str]:
    """Those columns of ``twins`` whose text equals that of their other column in every row (one aggregate)."""
    if not twins:
        return {}
    kinds = dict(df.dtypes)
    exact = {"int", "bigint", "string"}

    def differs(a: str, b: str) -> Column:
        x, y = (col(c) if kinds[a] == kinds[b] and kinds[a] in exact else col(c).cast("string") for c in (a, b))
        return ~x.eqNullSafe(y)
    off = df.agg(*[F.count_if(differs(a, b)).alias(f"_{i}") for i, (a, b) in enumerate(twins.items())]).first()
    return {a: b for i, (a, b) in enumerate(twins.items()) if not off[i]}


def column_summary(df: DataFrame, cols: list[str] | None = None, twins: dict[str, str] | None = None) -> DataFrame:
    """Per column distinct non-null values, missing count and % -- one
    unpivot to (column, value text), distinct pairs, then counts per column
    (no multi-column count(DISTINCT) expansion).

    ``twins``: columns that may repeat another column. One that does so in
    every row takes that column's distinct count; any other is counted."""
    cols = list(cols or df.columns)
    same = _confirmed(df, {a: b for a, b in (twins or {}).items() if a in cols and b in cols and b not in twins})
    counted = [c for c in cols if c not in same]
    long = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), col(c).cast("string").alias("v"))
                                         for i, c in enumerate(counted)])).alias("e")).select("e.*")
    named = F.array(*[F.array(*[F.lit(n) for n in [c, *[a for a, b in same.items() if b == c]]]) for c in counted])
    uniq = long.filter(F.col("v").isNotNull()).distinct().groupBy("i").agg(
        F.count(F.lit(1)).cast("long").alias("unique_values"))
    uniq = uniq.select(F.explode(F.get(named, F.col("i"))).alias("column_name"), "unique_values")
    audit = column_audit(df.select(*[col(c) for c in cols])).select("column_name", "missing_count", "missing_pct")
    types = df.sparkSession.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema.fields
                                             if f.name in cols], "column_name string, dtype string")
    return audit.join(uniq, "column_name", "left").fillna({"unique_values": 0}).join(F.broadcast(types), "column_name")


def feature_quality(df: DataFrame) -> DataFrame:
    """Numeric / categorical counts, missing cells and %, distance and
    departure-minute ranges of a feature table (one aggregate)."""
    num, cat = numeric_columns(df), string_columns(df)
    missing = sum((F.count_if(col(c).isNull()) for c in df.columns), F.lit(0))
    out = df.agg(F.count(F.lit(1)).alias("_n"), missing.cast("long").alias("missing_cells"),
                 F.min("distance").alias("min_distance"), F.max("distance").alias("max_distance"),
                 F.min("departure_minutes_since_midnight").alias("min_departure_minute"),
                 F.max("departure_minutes_since_midnight").alias("max_departure_minute"))
    return out.select(F.lit(len(num)).alias("numeric_features"), F.lit(len(cat)).alias("categorical_features"),
                      "missing_cells", _r(F.col("missing_cells") * 100.0 / (F.col("_n") * len(df.columns)), 2)
                      .alias("missing_pct"), "min_distance", "max_distance", "min_departure_minute",
                      "max_departure_minute")
