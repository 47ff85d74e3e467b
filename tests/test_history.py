"""Melted history timeline and publication lag against window plans and hand-made rows."""

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from flightops.operators import prior
from flightops.plans import pipeline as PL


@pytest.fixture(scope="module")
def pre(spark):
    return prior.with_departure_minute(PL.pre_departure(spark, SF_SMALL)).cache()


def same(a, b, cols):
    a, b = a.select(*cols), b.select(*cols)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("lag,days", [(1, None), (180, None), (4000, None), (180, 7), (1440, 1), (1439, 1), (5000, 2)])
def test_lagged_group_stats_equal_the_shifted_frame(pre, lag, days):
    how = {"days": days, "availability_lag_minutes": lag}
    a = prior.prior_group_stats(pre, ["origin_airport"], **how)
    b = prior.prior_group_stats(pre, ["origin_airport"], method="window", **how)
    assert same(a, b, ["flight_id", "prior_n", "prior_s"])


@pytest.mark.parametrize("lag", [0, 95])
@pytest.mark.parametrize("key", [["flight_id"], None])
def test_melted_history_equals_windows(pre, lag, key):
    a = prior.history_p3(pre, key=key, with_aliases=False, availability_lag_minutes=lag)
    b = prior.history_p3(pre, with_aliases=False, method="window", availability_lag_minutes=lag)
    cols = ["flight_id", *[f"{d}_{m}" for d, _ in prior.P3_DIMENSIONS for m in ("flight_count", "delay_count", "delay_rate")]]
    assert sorted(a.columns) == sorted(b.columns) and same(a, b, cols)


def test_rolling_2a_history_with_lag_equals_windows(pre):
    how = {"days": 3, "availability_lag_minutes": 60}
    a, b = prior.history_2a(pre, key=["flight_id"], **how), prior.history_2a(pre, method="window", **how)
    assert same(a, b, ["flight_id", *[c for c in a.columns if c.startswith("historical_")]])


def flights(spark, rows):
    given = [(i, airline, origin, "B", day, hhmm, y) for i, (airline, origin, day, hhmm, y) in enumerate(rows)]
    return spark.createDataFrame(given, "flight_id int, airline string, origin_airport string, dest_airport string, "
                                        "flight_date string, scheduled_dep_time int, delay_target int")


def test_outcomes_count_from_their_publication_on(spark):
    df = flights(spark, [("X", "A", "2024-01-01", 800, 1), ("X", "A", "2024-01-01", 859, 1), ("X", "A", "2024-01-01", 900, 0),
                         ("X", "A", "2024-01-01", 1000, 1), ("X", "A", "2024-01-01", 1001, 0), (None, "A", "2024-01-01", 1001, 1),
                         (None, "A", None, None, 1)])
    got = rows(prior.history_p3(df, key=["flight_id"], with_aliases=False, availability_lag_minutes=60),
               "flight_id", "prior_airline_flight_count", "prior_origin_flight_count", "prior_origin_delay_count")
    # 08:00 is known at 09:00, so a departure at 09:00 does not see it; a flight without a time is before all others
    assert got == [(0, 0, 1, 1), (1, 0, 1, 1), (2, 0, 1, 1), (3, 2, 3, 3), (4, 3, 4, 3), (5, 1, 4, 3), (6, 0, 0, 0)]
    with pytest.raises(ValueError):
        prior.history_2a(df, key=["flight_id"], availability_lag_minutes=-1)


def test_unwrapped_hours_are_their_own_groups(spark):
    df = flights(spark, [("X", "A", "2024-01-01", 30, 1), ("X", "A", "2024-01-02", 2430, 1), ("X", "A", "2024-01-03", 2430, 0),
                         ("X", "A", "2024-01-03", 45, 0)])
    # 24:30 of one day is 00:30 of hour 0 if wrapped, else hour 24 of its own
    for wrap, want in ((True, {0: 0, 1: 1, 2: 2, 3: 3}), (False, {0: 0, 1: 0, 2: 1, 3: 1})):
        h = prior.history_p3(df, key=["flight_id"], with_aliases=False, wrap_hour=wrap).collect()
        assert {r["flight_id"]: r["prior_airline_dep_hour_flight_count"] for r in h} == want


def test_one_timeline_for_all_dimensions(pre):
    plan = prior.history_p3(pre, key=["flight_id"], with_aliases=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 10  # one timeline a dimension took over 30
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "SinglePartition" not in plan


def test_hot_airline_is_counted_before_it_is_ordered(spark):
    n = 40_000
    df = (spark.range(n).select(F.col("id").alias("flight_id"), F.when(F.col("id") % 3 > 0, "HOT").otherwise(F.concat(F.lit("A"), F.col("id") % 50)).alias("airline"),
                                F.lit("O").alias("origin_airport"), F.lit("D").alias("dest_airport"),
                                F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 20).cast("int")), "yyyy-MM-dd").alias("flight_date"),
                                (F.col("id") % 24 * 100 + F.col("id") % 7).cast("int").alias("scheduled_dep_time"), (F.col("id") % 4 == 0).cast("int").alias("delay_target")))
    timed = prior.with_departure_minute(df)
    tl = prior.melted_timeline(timed, [["airline"], []], availability_lag_minutes=30)
    most = tl.groupBy("dim", "dim_key", F.floor(F.col(prior.T) / 1440)).count().agg(F.max("count")).first()[0]
    assert most <= 2 * 1440  # a window holds minutes of a day, not flights
    a = prior.history_p3(df, key=["flight_id"], with_aliases=False, dims=["prior_airline"], availability_lag_minutes=30)
    b = prior.prior_group_stats(timed, ["airline"], method="window", availability_lag_minutes=30)
    assert a.join(b, "flight_id").where("prior_airline_flight_count <> prior_n or prior_airline_delay_count <> prior_s").count() == 0


def test_finer_timelines_bring_the_sums_of_coarser_groups(pre):
    """Flights meet four timelines, not seven; groups without a finer one keep their own."""
    dims = [ks for _, ks in prior.P3_DIMENSIONS] + [[]]
    assert prior._carriers(dims) == {4: [0, 6], 5: [1], 2: [], 3: []}
    assert prior._carriers([["a"], ["b"], ["a"], []]) == {0: [3], 1: [], 2: []}
    plan = prior.history_p3(pre, key=["flight_id"], with_aliases=False)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") <= 8  # four of flights, three of timelines and the one by key


def test_carried_sums_with_null_and_repeated_groups(spark):
    df = flights(spark, [(a, o, d, t, y) for a in ("X", None, " ") for o in ("A", None) for d, t, y in
                         (("2024-01-01", 800, 1), ("2024-01-01", 800, 1), ("2024-01-02", 830, 0), (None, 830, 1), ("2024-01-03", None, 1))])
    for days in (None, 2):
        timed = prior._prepare(df, True)
        dims = [("a", ["airline"]), ("ao", ["origin_airport", "airline"]), ("h", ["airline", "_dep_hour"])]
        for key in (["flight_id"], None):
            out, _ = prior._history(timed.where(F.col(prior.T).isNotNull()), dims, "delay_target", key, "prefix", days)
            got = {r["flight_id"]: r for r in out.collect()}
            for name, ks in dims:
                for r in prior.prior_group_stats(timed.where(F.col(prior.T).isNotNull()), ks, method="window", days=days).collect():
                    assert (got[r["flight_id"]][f"_{name}_n"], got[r["flight_id"]][f"_{name}_s"]) == (r["prior_n"], r["prior_s"])
