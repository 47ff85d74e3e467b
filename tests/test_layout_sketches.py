"""Monthly tables: only the asked months are read or replaced. Sketches: merged months equal one pass, within their bound."""

import os
import re

import pytest
from pyspark.sql import functions as F

from flightops.operators import sketches
from flightops.sources import files


def flights(spark, n=3000, start="2024-01-15"):
    day = F.date_add(F.lit(start).cast("date"), (F.col("id") % 150).cast("int"))
    return spark.range(n).select(F.col("id").alias("flight_id"), F.when(F.col("id") != 7, F.date_format(day, "yyyy-MM-dd")).alias("flight_date"),
                                 F.concat(F.lit("A"), F.col("id") % 900).alias("origin"), F.when(F.col("id") % 3 > 0, "x").alias("kind"))


def scanned(df):
    """Months of the files that the executed scan reads, and its partition filters."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {re.search(r"month_of=([^/]+)/", f)[1] for f in df.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}, \
        re.search(r"PartitionFilters: \[(.*?)\]", plan)[1]


def test_only_the_asked_months_are_scanned(spark, tmp_path):
    df = flights(spark)
    path = files.write_monthly(df, str(tmp_path / "t"))
    part = files.read_dated(spark, path, "2024-02-20", "2024-04-03")
    want = df.where("flight_date between '2024-02-20' and '2024-04-03'")
    assert part.columns == df.columns and part.exceptAll(want).count() == 0 and part.count() == want.count() > 0
    months, filters = scanned(part)
    assert months == {"2024-02", "2024-03", "2024-04"} and "month_of" in filters and ">= 2024-02" in filters
    listed = [d for d in os.listdir(path) if d.startswith("month_of=")]
    assert len(listed) == 7 and any("DEFAULT" in d for d in listed)  # six months, and rows without a date


def test_only_the_given_months_are_replaced(spark, tmp_path):
    df = flights(spark)
    path = files.write_monthly(df, str(tmp_path / "t"))

    def state():
        return {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("month_of=")}

    before = state()
    files.write_monthly(df.where("flight_date like '2024-03%'").withColumn("kind", F.lit("new")), path)
    after = state()
    assert {d for d in before if before[d] != after[d]} == {"month_of=2024-03"} and before.keys() == after.keys()
    back = spark.read.parquet(path)
    assert back.count() == df.count() and back.where("kind = 'new'").count() == df.where("flight_date like '2024-03%'").count()


def test_merged_months_equal_one_pass_and_keep_their_bound(spark, tmp_path):
    df = flights(spark, 40_000)
    cols = ["flight_id", "origin", "kind"]
    kept = sketches.monthly(df, cols)
    kept.where("month <= '2024-03'").write.parquet(str(tmp_path / "a"))
    kept.where("month > '2024-03' or month is null").write.parquet(str(tmp_path / "b"))
    got = {r["column_name"]: r for r in sketches.summary(spark.read.parquet(str(tmp_path / "a"), str(tmp_path / "b")), 2).collect()}
    whole = {r["column_name"]: r for r in sketches.summary(sketches.monthly(df.withColumn("flight_date", F.lit("2024-01-01")), cols), 2).collect()}
    for c, exact in (("flight_id", 40_000), ("origin", 900), ("kind", 1)):
        assert got[c]["unique_values"] == whole[c]["unique_values"]  # a merge loses nothing
        assert abs(got[c]["unique_values"] - exact) <= max(1, 4 * 1.04 / 2 ** (sketches.LG_K / 2) * exact)
    assert got["kind"]["rows"] == 40_000 and got["kind"]["missing"] == 13_334
    assert [(x["item"], x["count"]) for x in got["kind"]["top"]] == [("x", 26_666)]


def test_json_sink_and_source_columns(spark, tmp_path):
    df = flights(spark, 20)
    out = files.write_table(df, str(tmp_path / "j"), fmt="json")
    assert spark.read.json(out).select(*df.columns).exceptAll(df).count() == 0
    with pytest.raises(ValueError):
        files.write_table(df, str(tmp_path / "x"), fmt="xml")


def test_sketches_of_no_rows(spark):
    assert sketches.summary(sketches.monthly(flights(spark, 5).where("false"), ["origin"])).count() == 0
