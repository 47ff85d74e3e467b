"""Ingestion, validation and cleaning on small hand-built tables."""

import pytest
from pyspark.sql import functions as F

from flightops import schema
from flightops.operators import clean, quality
from flightops.sources import ingest

BTS_SCHEMA = ("FL_DATE string, OP_UNIQUE_CARRIER string, ORIGIN string, DEST string, CRS_DEP_TIME int, "
              "DEP_TIME int, CRS_ARR_TIME int, ARR_TIME int, DEP_DELAY double, ARR_DELAY double, DISTANCE int, "
              "CANCELLED int, DIVERTED int, AIR_TIME int, TAXI_OUT int, TAXI_IN int")


def test_alias_resolution_bts(spark):
    df = spark.createDataFrame([("2024-01-01", "AA", "JFK", "LAX", 800, 805, 1100, 1110, 5.0, 10.0, 2475, 0, 0,
                                 300, 15, 10)], BTS_SCHEMA)
    ing = ingest.canonicalize(df)
    m = ing.mapping.canonical_to_raw
    assert m["flight_date"] == "FL_DATE" and m["airline"] == "OP_UNIQUE_CARRIER"
    assert m["actual_dep_time"] == "DEP_TIME" and m["actual_arr_time"] == "ARR_TIME"
    assert set(ing.mapping.outcome_columns) >= {"arrival_delay", "departure_delay", "air_time", "taxi_out"}
    assert "scheduled_dep_time" in ing.df.columns


def test_alias_resolution_kaggle_with_date_synthesis(spark):
    df = spark.createDataFrame([(2015, 1, 1, "AS", "ANC", "SEA", 5, 2354, 430, 408, -11.0, -22.0, 1448, 0, 0),
                                (2015, 2, 31, "AA", "LAX", "PBI", 10, 2, 750, 741, -8.0, -9.0, 2330, 0, 0)],
                               "YEAR int, MONTH int, DAY int, AIRLINE string, ORIGIN_AIRPORT string, "
                               "DESTINATION_AIRPORT string, SCHEDULED_DEPARTURE int, DEPARTURE_TIME int, "
                               "SCHEDULED_ARRIVAL int, ARRIVAL_TIME int, DEPARTURE_DELAY double, ARRIVAL_DELAY double, "
                               "DISTANCE int, CANCELLED int, DIVERTED int")
    ing = ingest.canonicalize(df)
    got = [r["flight_date"] for r in ing.df.orderBy("DAY").collect()]
    assert got == ["2015-01-01", None]          # Feb 31 is not a date
    assert ing.mapping.canonical_to_raw["dest_airport"] == "DESTINATION_AIRPORT"


def test_missing_required_fields_raise(spark):
    df = spark.createDataFrame([("AA", "JFK")], "carrier string, origin string")
    with pytest.raises(ValueError, match="missing required"):
        ingest.canonicalize(df)


DIRTY = [("2024-01-01", "AA", "JFK", "LAX", 800, 10.0, 2475.0, 0, 0),
         ("bad-date", "AA", "JFK", "LAX", 900, 20.0, 2475.0, 0, 0),
         ("2024-01-01", "AA", "XXXX", "LAX", 1000, 5.0, 2475.0, 0, 0),
         ("2024-01-01", "DL", "ATL", "MIA", 1100, None, 600.0, 1, 0),
         ("2024-01-01", "DL", "ATL", "MIA", 1200, None, 600.0, 0, 0),
         ("2024-01-01", "UA", "ORD", "DEN", 1300, 30.0, -50.0, 0, 0),
         ("2024-01-01", "AA", "JFK", "LAX", 800, 10.0, 2475.0, 0, 0)]
DIRTY_SCHEMA = ("flight_date string, airline string, origin_airport string, dest_airport string, "
                "scheduled_dep_time int, arrival_delay double, distance double, cancelled int, diverted int")


def test_dirty_audit(spark):
    df = spark.createDataFrame(DIRTY, DIRTY_SCHEMA)
    s = quality.quality_summary(df).first()
    assert s["total_records"] == 7 and s["duplicate_records"] == 1
    assert s["invalid_date_records"] == 1 and s["invalid_airport_records"] == 1
    assert s["invalid_distance_records"] == 1 and s["cancelled_flights"] == 1
    assert s["invalid_delay_records"] == 1            # null delay, not cancelled
    assert s["total_invalid_records"] == 5 and s["total_valid_records"] == 1
    ann = quality.annotate(df)
    assert ann.count() == 7
    assert ann.filter("_is_duplicate").count() == 1
    cohorts = {r["cohort"]: r["records"] for r in quality.cohort_counts(df).collect()}
    assert cohorts == {"invalid": 5, "cancelled": 1, "valid": 1}
    assert sum(cohorts.values()) == 7


def test_expand_copies_big_groups(spark):
    """Groups larger than the chunk go through the chunked, repartitioned path."""
    base = spark.range(3).withColumn("v", F.col("id") % 2)
    counts = base.groupBy("id", "v").agg(F.lit(1).alias("_copies")).withColumn(
        "_copies", F.when(F.col("id") == 0, 25).otherwise(F.col("id") + 1).cast("long"))
    out = quality.expand_copies(counts, chunk=4)
    got = {r["id"]: (r["n"], r["d"]) for r in out.groupBy("id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("_is_duplicate").alias("d")).collect()}
    assert got == {0: (25, 24), 1: (2, 1), 2: (3, 2)}


def test_target_boundaries(spark):
    delays = [14.0, 15.0, 30.0, -5.0, 0.0, 14.9, 15.1, None]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(delays)], "i int, arrival_delay double")
    got = [r[0] for r in df.orderBy("i").select(clean.delay_target(F.col("arrival_delay"))).collect()]
    assert got == [0, 1, 1, 0, 0, 0, 1, 0]


def test_clean_and_pre_departure(spark):
    df = spark.createDataFrame(DIRTY, DIRTY_SCHEMA).withColumn("departure_delay", F.lit(3.0))
    cleaned = clean.clean_operational(df)
    assert cleaned.count() == 1
    pre = clean.pre_departure(cleaned)
    assert "arrival_delay" not in pre.columns and "departure_delay" not in pre.columns
    assert pre.columns[-1] == "delay_target"


def test_whitespace_and_case_standardisation(spark):
    df = spark.createDataFrame([("2024-01-01", "\tdl ", " jfk", "lax ", 800, 20.0, 100.0, 0, 0)], DIRTY_SCHEMA)
    r = clean.clean_operational(df).first()
    assert (r["airline"], r["origin_airport"], r["dest_airport"], r["delay_target"]) == ("DL", "JFK", "LAX", 1)


def test_leakage_audit():
    assert schema.assert_no_leakage(["flight_date", "airline", "prior_arr_delay_rate", "historical_dep_delay_x",
                                     "delay_target"])
    with pytest.raises(ValueError):
        schema.assert_no_leakage(["arrival_delay"])
    with pytest.raises(ValueError):
        schema.assert_no_leakage(["avg_taxi_out"])
    with pytest.raises(ValueError):
        schema.assert_no_leakage(["prior_future_rate"])     # temporal keyword: no prefix exemption
    assert "route" in schema.leakage_safe_features(["route", "dep_delay_x", "delay_target"])
    assert schema.leakage_safe_features(["dep_delay_x", "delay_target"]) == []


def test_valid_cohort_reads_its_input_once(spark, tmp_path):
    """The dedup works on the written valid rows; the input is not evaluated again for each of its branches."""
    rows = [("2024-01-01", "DL", "JFK", "LAX", 800 + i, 20.0, 100.0, 0, 0) for i in (0, 0, 0, 1, 2)]
    spark.createDataFrame(rows, DIRTY_SCHEMA).write.parquet(f"{tmp_path}/raw")
    kept = clean.valid_cohort(spark.read.parquet(f"{tmp_path}/raw"))
    assert not any(str(tmp_path) in f for f in kept.inputFiles())
    assert sorted(tuple(r) for r in kept.collect()) == sorted(set(rows))


def test_checks_read_written_rows(spark):
    """The checks' plan does not repeat how the rows were made; that code was too long for the JVM to compile."""
    from flightops.operators import clean
    raw = spark.range(40).select(
        F.col("id").alias("flight_id"), F.when(F.col("id") % 7 == 5, "bad-date").otherwise("2024-01-02").alias("flight_date"),
        F.lit("AAX").alias("origin_airport"), F.lit("BBX").alias("dest_airport"), F.when(F.col("id") % 5 > 0, 100.0).alias("distance"),
        F.lit(3.0).alias("arrival_delay"), F.lit(0).alias("cancelled"), F.lit(0).alias("diverted"))
    got = clean.valid_cohort(raw.unionByName(raw))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "bad-date" not in plan and "Range" not in plan
    assert sorted(r["flight_id"] for r in got.collect()) == [i for i in range(40) if i % 7 != 5 and i % 5]
