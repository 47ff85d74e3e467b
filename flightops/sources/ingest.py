"""Ingestion: canonical names, date synthesis, required-field check."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema


@dataclass
class Ingested:
    df: DataFrame                 # canonical table (lazy)
    mapping: schema.SchemaMapping


def synthesize_date(df: DataFrame) -> DataFrame:
    """Add ``flight_date`` from YEAR/MONTH/DAY when no date column exists."""
    lower = {c.lower(): c for c in df.columns}
    if "flight_date" in lower or "fl_date" in lower:
        return df
    if not all(k in lower for k in ("year", "month", "day")):
        return df
    y, m, d = (F.col(f"`{lower[k]}`").cast("string") for k in ("year", "month", "day"))
    text = F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0"))
    return df.withColumn("flight_date", F.date_format(text.try_cast("date"), "yyyy-MM-dd"))


def canonicalize(df: DataFrame, require: bool = True) -> Ingested:
    df = synthesize_date(df)
    mapping, unmapped = schema.resolve_aliases(df.columns)
    found, missing = (schema.check_required(mapping, df.columns) if require
                      else ([r for r in mapping], []))
    renamed = df.withColumnsRenamed({raw: canon for canon, raw in mapping.items() if raw != canon})
    sm = schema.SchemaMapping(mapping, unmapped, found, missing, schema.outcome_columns(renamed.columns))
    return Ingested(renamed, sm)
