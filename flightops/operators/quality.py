"""Validation: defect flags, duplicate accounting, quality summary, cohorts.

Exact duplicates are handled by aggregation, never by a window over all
columns: ``groupBy(*all columns).count()`` combines copies map-side, so a
group of copies holding a third of the table costs one partial-aggregate row
per map task. Counting audits weight each distinct row by its copy count;
the row-level annotated table re-expands copies (see ``expand_copies``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S

from .. import config
from ..functions.scalar import col, strip, to_date, to_double

COPIES = "_copies"
# rows per expansion chunk: groups with more copies are split into chunks
# that are spread over tasks before they are exploded
EXPAND_CHUNK = 1 << 20


def _flag_or_false(df: DataFrame, name: str, expr) -> Column:
    return expr(col(name)) if name in df.columns else F.lit(False)


def row_flags(df: DataFrame, delay_threshold: float | None = None) -> dict[str, Column]:
    """Per-row defect predicates (everything except duplication)."""
    def is_one(c: Column) -> Column:
        # numeric 1 -> flag; letter codes (e.g. a cancellation code) count as set
        num = to_double(c)
        txt = strip(c.cast("string"))
        return F.coalesce(num == 1.0, F.when(num.isNull() & (F.length(txt) > 0), F.lit(True)), F.lit(False))
    cancelled = _flag_or_false(df, "cancelled", is_one)
    diverted = _flag_or_false(df, "diverted", is_one)
    bad_date = _flag_or_false(df, "flight_date", lambda c: to_date(c).isNull())

    def bad_airport(c: Column) -> Column:
        return F.coalesce(~strip(c.cast("string")).rlike(config.AIRPORT_PATTERN), F.lit(True))
    bad_airport_any = (_flag_or_false(df, "origin_airport", bad_airport)
                       | _flag_or_false(df, "dest_airport", bad_airport))

    def bad_distance(c: Column) -> Column:
        x = to_double(c)
        return x.isNull() | (x <= 0) | (x > 10000)
    bad_dist = _flag_or_false(df, "distance", bad_distance)

    def bad_delay(c: Column) -> Column:
        x = to_double(c)
        return ~cancelled & ~diverted & (x.isNull() | (x < -120) | (x > 2880))
    bad_delay_e = _flag_or_false(df, "arrival_delay", bad_delay)
    return {"_is_cancelled": cancelled, "_is_diverted": diverted, "_bad_date": bad_date,
            "_bad_airport": bad_airport_any, "_bad_distance": bad_dist, "_bad_delay": bad_delay_e}


ROW_HASH = "_row_hash"


def _hashed(df: DataFrame) -> DataFrame:
    return df.withColumn(ROW_HASH, F.xxhash64(*[col(c) for c in df.columns]))


def _split_by_hash(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose 64-bit row hash is unique, rows sharing a hash with
    another row). Only the hash column is shuffled to find the shared
    hashes (map-side combined); the semi/anti joins against that set are
    broadcast by AQE when it is small (few duplicates), else sort-merge."""
    h = _hashed(df)
    shared = h.groupBy(ROW_HASH).agg(F.count(F.lit(1)).alias("_hn")).filter("_hn > 1").select(ROW_HASH)
    unique = h.join(shared, ROW_HASH, "left_anti").drop(ROW_HASH)
    cand = h.join(shared, ROW_HASH, "left_semi").drop(ROW_HASH)
    return unique, cand


def copy_counts(df: DataFrame) -> DataFrame:
    """One row per distinct record with its number of exact copies (nulls equal).

    Exact, but the full-width shuffle is limited to rows whose row hash
    repeats (true copies and rare collisions, resolved by grouping on every
    column); all other rows carry one copy without being shuffled."""
    unique, cand = _split_by_hash(df)
    grouped = cand.groupBy(*[col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias(COPIES))
    return unique.withColumn(COPIES, F.lit(1).cast("long")).unionByName(grouped.withColumn(COPIES, F.col(COPIES).cast("long")))


def distinct_rows(df: DataFrame) -> DataFrame:
    """``df.distinct()`` with the full-width shuffle limited to repeated hashes."""
    unique, cand = _split_by_hash(df)
    return unique.unionByName(cand.distinct())


def expand_copies(counts: DataFrame, chunk: int = EXPAND_CHUNK) -> DataFrame:
    """Back to one row per record; ``_is_duplicate`` marks all but one copy.

    Groups of up to ``chunk`` copies are exploded where they are. Larger
    groups are first cut into chunk descriptors (n/chunk rows), which are
    repartitioned so the exploding work for one huge group runs on many tasks.
    """
    cols = [c for c in counts.columns if c != COPIES]
    n = F.col(COPIES)
    small = (counts.filter(n <= chunk)
             .withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), n - 1))))
    big = (counts.filter(n > chunk)
           .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / chunk))))
           .repartition("_chunk", *[col(c) for c in cols])
           .withColumn("_k", F.explode(F.sequence(F.col("_chunk") * chunk,
                                                  F.least(n, (F.col("_chunk") + 1) * chunk) - 1)))
           .drop("_chunk"))
    out = small.unionByName(big)
    return out.withColumn("_is_duplicate", F.col("_k") > 0).drop("_k", COPIES)


def annotate(df: DataFrame) -> DataFrame:
    """Row-level table with the five audit flags of the original validator."""
    expanded = expand_copies(copy_counts(df))
    flags = row_flags(expanded)
    invalid = (F.col("_is_duplicate") | flags["_bad_date"] | flags["_bad_airport"]
               | flags["_bad_distance"] | flags["_bad_delay"])
    return (expanded.withColumns({"_is_cancelled": flags["_is_cancelled"],
                                  "_is_diverted": flags["_is_diverted"]})
            .withColumn("_is_invalid", invalid)
            .withColumn("_is_valid_completed", ~F.col("_is_invalid") & ~F.col("_is_cancelled")
                        & ~F.col("_is_diverted")))


def cohort_expr(dup: Column, flags: dict[str, Column]) -> Column:
    """invalid > cancelled > diverted > valid."""
    invalid = dup | flags["_bad_date"] | flags["_bad_airport"] | flags["_bad_distance"] | flags["_bad_delay"]
    return (F.when(invalid, "invalid").when(flags["_is_cancelled"], "cancelled")
            .when(flags["_is_diverted"], "diverted").otherwise("valid"))


def quality_summary(df: DataFrame, delay_threshold: float = 15.0) -> DataFrame:
    """One-row audit computed from copy counts (no row expansion)."""
    counts = copy_counts(df)
    f = row_flags(counts)
    n = F.col(COPIES)
    own_invalid = f["_bad_date"] | f["_bad_airport"] | f["_bad_distance"] | f["_bad_delay"]
    first_valid = ~own_invalid & ~f["_is_cancelled"] & ~f["_is_diverted"]
    delay = to_double(col("arrival_delay")) if "arrival_delay" in df.columns else F.lit(None).cast("double")
    required = [c for c in config.REQUIRED_FIELDS if c in df.columns]
    any_missing = F.lit(False)
    for c in required:
        any_missing = any_missing | col(c).isNull()

    def weighted(cond: Column) -> Column:
        return F.sum(F.when(cond, n).otherwise(0)).cast("long")
    out = counts.agg(
        F.sum(n).cast("long").alias("total_records"),
        F.sum(n - 1).cast("long").alias("duplicate_records"),
        weighted(f["_is_cancelled"]).alias("cancelled_flights"),
        weighted(f["_is_diverted"]).alias("diverted_flights"),
        weighted(f["_bad_date"]).alias("invalid_date_records"),
        weighted(f["_bad_airport"]).alias("invalid_airport_records"),
        weighted(f["_bad_distance"]).alias("invalid_distance_records"),
        weighted(f["_bad_delay"]).alias("invalid_delay_records"),
        (F.sum(n - 1) + F.count_if(own_invalid)).cast("long").alias("total_invalid_records"),
        F.count_if(first_valid).cast("long").alias("total_valid_records"),
        F.count_if(first_valid & (delay >= delay_threshold)).cast("long").alias("delayed_flights"),
        weighted(any_missing).alias("missing_required_records"),
    )
    return (out.withColumn("ontime_flights", F.col("total_valid_records") - F.col("delayed_flights"))
            .withColumn("delay_rate_percent", S.round_half_even(
                F.col("delayed_flights").cast("double") * 100.0
                / F.greatest(F.col("total_valid_records"), F.lit(1)), 2)))


def cohort_counts(df: DataFrame) -> DataFrame:
    counts = copy_counts(df)
    f = row_flags(counts)
    n = F.col(COPIES)
    first = counts.select(cohort_expr(F.lit(False), f).alias("cohort"), F.lit(1).cast("long").alias("w"))
    copies = (counts.filter(n > 1)
              .select(F.lit("invalid").alias("cohort"), (n - 1).cast("long").alias("w")))
    return first.unionByName(copies).groupBy("cohort").agg(F.sum("w").cast("long").alias("records"))


def missing_by_column(df: DataFrame) -> DataFrame:
    """Null count per column: one pass, then unpivot to (column_name, missing)."""
    wide = df.agg(*[F.count_if(col(c).isNull()).cast("long").alias(c) for c in df.columns])
    return wide.unpivot([], [col(c) for c in df.columns], "column_name", "missing_count")


# ---- V11: weather audit --------------------------------------------------------

def weather_validate(weather: DataFrame) -> DataFrame:
    lower = {c.lower(): c for c in weather.columns}
    missing = [r for r in config.WEATHER_REQUIRED_FIELDS if r not in lower]
    if missing:
        raise ValueError(f"weather table misses required fields {missing}")
    w = weather.select(*[col(lower[r]).alias(r) for r in config.WEATHER_REQUIRED_FIELDS])
    airport = strip(F.col("airport").cast("string"))
    ok_airport = F.coalesce(airport.rlike(config.AIRPORT_PATTERN), F.lit(False))
    ts = F.col("timestamp").cast("string").try_cast("timestamp_ntz")
    ok_ts = ts.isNotNull()

    def in_range(c: str, lo, hi) -> Column:
        x = to_double(F.col(c))
        cond = x >= lo if hi is None else x.between(lo, hi)
        return F.col(c).isNull() | F.coalesce(cond, F.lit(False))
    ok = ok_airport & ok_ts & in_range("humidity", 0, 100) & in_range("wind_direction", 0, 360) \
        & in_range("wind_speed", 0, None)
    return w.agg(
        F.count(F.lit(1)).cast("long").alias("total_records"),
        F.count_if(~ok).cast("long").alias("invalid_rows"),
        F.count_distinct(F.when(ok_airport, F.col("airport"))).cast("long").alias("airports_covered"),
        F.array_join(F.array_sort(F.collect_set(F.when(ok_airport, F.col("airport")))), ",").alias("airports"),  # three letters: bounded
        F.min(ts).alias("min_timestamp"),
        F.max(ts).alias("max_timestamp"),
    ).withColumn("is_valid", F.col("invalid_rows") == 0)


# ---- V13 / V14 ---------------------------------------------------------------------

def temporal_violations(pairs: DataFrame, history_ts: str, prediction_ts: str) -> DataFrame:
    """Count of (prediction, history) pairs where history is not strictly earlier."""
    bad = F.col(history_ts) >= F.col(prediction_ts)
    return pairs.agg(F.count_if(bad).cast("long").alias("violations"),
                     F.max(F.when(bad, F.col(history_ts))).alias("max_offending_ts"))


def assert_temporal_validity(pairs: DataFrame, history_ts: str, prediction_ts: str) -> bool:
    row = temporal_violations(pairs, history_ts, prediction_ts).first()
    if row["violations"]:
        raise ValueError(f"temporal leakage: {row['violations']} history rows at or after prediction time "
                         f"(max {row['max_offending_ts']})")
    return True


def population_alignment(a: DataFrame, b: DataFrame, key: list[str], compare: list[str]) -> DataFrame:
    """Keyed alignment of two feature tables: rows only on one side and, for
    each compared column, the number of keys whose values differ (null-safe)."""
    la = a.select(*key, *[F.col(c).alias(f"a_{c}") for c in compare], F.lit(True).alias("_in_a"))
    lb = b.select(*key, *[F.col(c).alias(f"b_{c}") for c in compare], F.lit(True).alias("_in_b"))
    j = la.join(lb, on=key, how="full_outer")
    aggs = [F.count_if(F.col("_in_a").isNull()).cast("long").alias("only_in_b"),
            F.count_if(F.col("_in_b").isNull()).cast("long").alias("only_in_a"),
            F.count_if(F.col("_in_a").isNotNull()).cast("long").alias("rows_a"),
            F.count_if(F.col("_in_b").isNotNull()).cast("long").alias("rows_b")]
    both = F.col("_in_a").isNotNull() & F.col("_in_b").isNotNull()
    for c in compare:
        aggs.append(F.count_if(both & ~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))).cast("long")
                    .alias(f"diff_{c}"))
    return j.agg(*aggs)


def assert_population_alignment(a: DataFrame, b: DataFrame, key: list[str], compare: list[str]) -> dict:
    """The two tables hold the same rows with the same values, or a ValueError that says what differs."""
    row = population_alignment(a, b, key, compare).first().asDict()
    wrong = {k: v for k, v in row.items() if v and (k.startswith("only_in_") or k.startswith("diff_"))}
    if wrong:
        raise ValueError(f"feature tables do not align: {wrong}")
    return row
