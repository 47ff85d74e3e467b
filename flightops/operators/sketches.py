"""Distinct counts and frequent values from mergeable sketches, kept by month.

A month's sketches are a few kilobytes a column, made where its rows are read; the sketches of any set of months merge
into the same sketch as one pass over their rows. So a table that grows by a month is summarised by reading that month.

The exact plans of ``profile`` (column_summary, categorical_profile) stay as they are; sketches are asked for, never
chosen by size. Distinct counts have a relative standard error of 1.04 / sqrt(2**lg_k): 0.8 % at the default 14.
Frequent values overstate by no more than the number of counted values over the items tracked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import col, to_date

LG_K, TRACKED = 14, 10_000


def _long(df: DataFrame, cols: list[str], date_col: str) -> DataFrame:
    month = F.date_format(to_date(col(date_col)), "yyyy-MM").alias("month")
    return df.select(month, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), col(c).cast("string").alias("v")) for c in cols])).alias("e")).select("month", "e.*")


def monthly(df: DataFrame, cols: list[str], date_col: str = "flight_date", lg_k: int = LG_K, tracked: int = TRACKED) -> DataFrame:
    """(month, column_name, rows, missing, distinct_sketch, top_sketch); rows without a date are month null."""
    v = F.col("v")
    return _long(df, cols, date_col).groupBy("month", "column_name").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(v.isNull()).alias("missing"),
        F.hll_sketch_agg(v, lg_k).alias("distinct_sketch"), F.expr(f"approx_top_k_accumulate(v, {tracked})").alias("top_sketch"))


def merged(sketches: DataFrame) -> DataFrame:
    """(column_name, rows, missing, distinct_sketch, top_sketch) of all given months; itself mergeable."""
    return sketches.groupBy("column_name").agg(
        F.sum("rows").alias("rows"), F.sum("missing").alias("missing"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), F.expr("approx_top_k_combine(top_sketch)").alias("top_sketch"))


def summary(sketches: DataFrame, k: int = 1) -> DataFrame:
    """(column_name, rows, missing, unique_values, top): estimated distinct values, and the k most frequent values
    with their counts, without nulls."""
    top = F.filter(F.expr(f"approx_top_k_estimate(top_sketch, {k + 1})"), lambda x: x["item"].isNotNull())
    return merged(sketches).select("column_name", "rows", "missing", F.hll_sketch_estimate("distinct_sketch").alias("unique_values"),
                                   F.slice(top, 1, k).alias("top"))
