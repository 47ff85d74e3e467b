"""Skew: one key holding a third of the rows must not change results."""

from pyspark.sql import functions as F

from flightops.operators import asof, prior, quality, split


def _skewed(spark, n=9000):
    # a third of all flights: airline HOT, all at 2024-03-05 08:00 (one slot, one minute)
    df = spark.range(n).select(
        F.col("id").alias("flight_id"),
        F.when(F.col("id") % 3 == 0, F.lit("2024-03-05"))
         .otherwise(F.date_format(F.date_add(F.lit("2024-02-20").cast("date"), (F.col("id") % 20).cast("int")),
                                  "yyyy-MM-dd")).alias("flight_date"),
        F.when(F.col("id") % 3 == 0, F.lit(800)).otherwise((F.col("id") % 24) * 100 + (F.col("id") % 4) * 15)
         .cast("int").alias("scheduled_dep_time"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("A"), (F.col("id") % 7).cast("string")))
         .alias("airline"),
        F.concat(F.lit("O"), (F.col("id") % 5).cast("string")).alias("origin_airport"),
        F.lit("DST").alias("dest_airport"),
        (F.col("id") % 2).cast("int").alias("delay_target"))
    return df


def test_hot_key_prefix_equals_window(spark):
    df = prior.with_departure_minute(_skewed(spark))
    for keys in (["airline"], []):
        a = prior.prior_group_stats(df, keys).select("flight_id", "prior_n", "prior_s")
        b = prior.prior_group_stats(df, keys, method="window").select("flight_id", "prior_n", "prior_s")
        assert a.exceptAll(b).count() == 0


def test_split_boundary_inside_hot_slot(spark):
    df = _skewed(spark)
    out = split.chronological_split(df, slot_keys=500).collect()
    order = sorted(out, key=lambda r: (r["flight_date"], r["scheduled_dep_time"], r["flight_id"]))
    n = len(order)
    n_train, n_val = int(n * 0.7), int(n * 0.15)
    assert [r["split"] for r in order] == ["train"] * n_train + ["val"] * n_val + ["test"] * (n - n_train - n_val)
    # the hot slot (3000 rows on 2024-03-05 08:00) straddles a boundary
    hot = {r["split"] for r in out if r["flight_date"] == "2024-03-05" and r["scheduled_dep_time"] == 800}
    assert len(hot) > 1


def test_split_string_key_inside_hot_slot(spark):
    df = _skewed(spark).withColumn("flight_id", F.concat(F.lit("F"), F.lpad(F.col("flight_id").cast("string"), 6, "0")))
    out = split.chronological_split(df, slot_keys=400)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan      # rows are labelled by comparison alone
    order = sorted(out.collect(), key=lambda r: (r["flight_date"], r["scheduled_dep_time"], r["flight_id"]))
    n = len(order)
    n_train, n_val = int(n * 0.7), int(n * 0.15)
    assert [r["split"] for r in order] == ["train"] * n_train + ["val"] * n_val + ["test"] * (n - n_train - n_val)


def test_hot_duplicate_group(spark):
    base = spark.range(6000).select(F.when(F.col("id") < 5000, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                    F.lit("x").alias("v"))
    counts = quality.copy_counts(base)
    assert counts.filter("k = 0").first()["_copies"] == 5000 and counts.count() == 1001
    out = quality.expand_copies(counts, chunk=1000)
    assert out.count() == 6000 and out.filter("_is_duplicate").count() == 4999
    assert quality.distinct_rows(base).count() == 1001


def test_asof_splits_a_hot_airport_hour(spark):
    """A third of the flights at one airport and hour: same result, and AQE splits the hot join partition."""
    flights = _skewed(spark, 30_000).withColumn("origin_airport", F.when(F.col("airline") == "HOT", "HOT").otherwise(F.col("origin_airport")))
    flights = prior.with_departure_minute(flights)
    weather = spark.range(4000).select(
        F.col("id").alias("obs_id"), F.when(F.col("id") % 2 == 0, "HOT").otherwise(F.concat(F.lit("O"), (F.col("id") % 5).cast("string"))).alias("airport"),
        F.expr("timestamp_ntz'2024-02-19 00:00:00' + make_dt_interval(0, 0, cast(id * 11 as int))").alias("timestamp"), F.lit(1.0).alias("temperature"))
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k"}
    before = {k: spark.conf.get(k, None) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        out = asof.asof_weather(flights, weather, key=["flight_id"])
        rows = {r["flight_id"]: r["weather_origin_obs_id"] for r in out.select("flight_id", "weather_origin_obs_id").repartition(3).collect()}
        got = asof.asof_weather(flights, weather, key=["flight_id"])
        got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "isFinalPlan=true" in plan and "skew=true" in plan
    import bisect
    times = {}
    for r in weather.select("obs_id", "airport", F.floor(F.unix_timestamp(F.col("timestamp").cast("string")) / 60).alias("m")).orderBy("obs_id").collect():
        times.setdefault(r["airport"], []).append((r["m"], r["obs_id"]))
    for r in flights.select("flight_id", "origin_airport", prior.T).collect():
        own = times.get(r["origin_airport"], [])
        k = bisect.bisect_right(own, (r[prior.T], 1 << 60)) - 1
        want = own[k][1] if k >= 0 and r[prior.T] - own[k][0] <= 120 else None
        assert rows[r["flight_id"]] == want


def _join_rows(plan) -> int:
    """The most rows that a join of an executed plan made."""
    inner = [plan.children().apply(i) for i in range(plan.children().size())]
    for name in ("finalPhysicalPlan", "plan"):
        if plan.getClass().getSimpleName() in ("AdaptiveSparkPlanExec", "ShuffleQueryStageExec", "BroadcastQueryStageExec"):
            try:
                inner.append(getattr(plan, name)())
            except Exception:
                continue
    own = plan.metrics().apply("numOutputRows").value() if "Join" in plan.nodeName() and plan.metrics().contains("numOutputRows") else 0
    return max([own, *map(_join_rows, inner)])


def test_asof_join_rows_grow_with_minutes(spark):
    """Flights and observations that crowd into the minutes of one airport: never one joined row a pair of them."""
    flights = spark.range(600).select(
        F.col("id").alias("flight_id"), F.lit("AAX").alias("origin_airport"), (28_000_000 + F.col("id") % 2).alias(prior.T))
    weather = spark.range(400).select(
        F.col("id").alias("obs_id"), F.lit("AAX").alias("airport"),
        F.timestamp_micros((27_999_999 - F.col("id") % 2) * 60_000_000 + F.col("id")).cast("timestamp_ntz").alias("timestamp"), F.lit(1.0).alias("temperature"))
    out = asof.asof_weather(flights, weather, key=["flight_id"])
    assert {r["weather_origin_obs_id"] for r in out.collect()} == {398}
    assert 600 <= _join_rows(out._jdf.queryExecution().executedPlan()) <= 2 * 600


def test_history_meets_its_timelines_one_row_a_flight(spark):
    """No join of the history makes a row for each flight and dimension; repeated and null group keys keep their sums."""
    flights = _skewed(spark, 3000)
    dims = [("a", ["airline"]), ("o", ["origin_airport"]), ("ao", ["airline", "origin_airport"])]
    flights = prior.with_departure_minute(flights.withColumn("airline", F.when(F.col("flight_id") % 7 > 0, F.col("airline"))))
    out, _ = prior._history(flights, dims, "delay_target", ["flight_id"], "prefix")
    rows = {r["flight_id"]: r for r in out.collect()}
    assert len(rows) == 3000 and _join_rows(out._jdf.queryExecution().executedPlan()) == 3000
    for name, keys in dims:
        for r in prior.prior_group_stats(flights, keys, method="window").collect():
            assert (rows[r["flight_id"]][f"_{name}_n"], rows[r["flight_id"]][f"_{name}_s"]) == (r["prior_n"], r["prior_s"])
