"""Cleaning: valid cohort, code standardisation, target, outcome purge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.scalar import col, std_code, to_date, to_double
from ..session import stage_table
from . import quality


def delay_target(delay: Column, threshold: float = 15.0) -> Column:
    """1 when the delay is at least the threshold, else 0 (null -> 0)."""
    return F.coalesce((to_double(delay) >= threshold).cast("int"), F.lit(0))


def valid_cohort(df: DataFrame) -> DataFrame:
    """Distinct records that pass every check and were neither cancelled nor
    diverted. Exactly one copy of each duplicate group is kept, as the
    first-copy rule does (``quality.distinct_rows``: only rows with a
    repeated row hash take part in the full-width dedup shuffle)."""
    # written before the checks: inlined into the plan that makes the rows, they exceed the JVM's limit for compiled
    # methods, and the dedup reads its rows three times
    df = stage_table(df, "canonical_rows")
    f = quality.row_flags(df)
    ok = ~(f["_bad_date"] | f["_bad_airport"] | f["_bad_distance"] | f["_bad_delay"]
           | f["_is_cancelled"] | f["_is_diverted"])
    # the row predicates are evaluated before the dedup so they prune early;
    # they only depend on the row itself, so filtering first is equivalent.
    return quality.distinct_rows(df.filter(ok))


def standardize(df: DataFrame, threshold: float = 15.0) -> DataFrame:
    """Trimmed upper-case codes, ISO date text, numeric coercion, target."""
    out = {}
    for c in ("origin_airport", "dest_airport", "airline"):
        if c in df.columns:
            out[c] = std_code(col(c))
    if "flight_date" in df.columns:
        out["flight_date"] = F.date_format(to_date(col("flight_date")), "yyyy-MM-dd")
    for c in ("distance", "arrival_delay"):
        if c in df.columns:
            out[c] = to_double(col(c))
    df = df.withColumns(out)
    if "arrival_delay" not in df.columns:
        raise KeyError("target creation needs 'arrival_delay'")
    return df.withColumn("delay_target", delay_target(col("arrival_delay"), threshold))


def clean_operational(df: DataFrame, threshold: float = 15.0) -> DataFrame:
    """Canonical table -> cleaned operational table (valid cohort only)."""
    return standardize(valid_cohort(df), threshold)


def pre_departure(cleaned: DataFrame) -> DataFrame:
    """Drop outcome columns and audit flags; ``delay_target`` last."""
    drop = [c for c in config.OUTCOME_COLUMNS if c in cleaned.columns]
    drop += [c for c in cleaned.columns if c.startswith("_is_")]
    keep = [c for c in cleaned.columns if c not in drop and c != "delay_target"]
    cols = keep + (["delay_target"] if "delay_target" in cleaned.columns else [])
    return cleaned.select(*[col(c) for c in cols])


def cohorts(df: DataFrame) -> DataFrame:
    """Row-level cohort label for every input record (invalid copies included)."""
    ann = quality.annotate(df)
    return ann.withColumn("cohort", F.when(F.col("_is_invalid"), "invalid")
                          .when(F.col("_is_cancelled"), "cancelled")
                          .when(F.col("_is_diverted"), "diverted").otherwise("valid"))
