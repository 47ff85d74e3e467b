"""Model layer, streaming scoring, file sources and sinks."""

import os
import tempfile

import pytest
from conftest import SF_SMALL
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from flightops.ml import explain, models, prep
from flightops.operators import clean, split
from flightops.plans import catalog
from flightops.sources import files, ingest
from flightops.streaming import scoring


def test_preprocessor_unseen_category_is_zero_vector(spark):
    train = spark.createDataFrame([(1.0, "a", 0), (None, "b", 1), (3.0, "a", 0), (5.0, "b", 1)],
                                  "x double, c string, delay_target int")
    p = prep.Preprocessor(["x"], ["c"], scale=True).fit(train)
    assert p.medians["x"] == 3.0
    assert p.feature_names() == ["x", "c_a", "c_b"]
    test = spark.createDataFrame([(None, "zzz", 0)], "x double, c string, delay_target int")
    v = p.transform(test).select(vector_to_array("features").alias("v")).first()["v"]
    # x imputed with the median (3.0) and standardised with the population std of [1, 3, 3, 5]
    assert v[0] == pytest.approx(0.0) and v[1:] == [0.0, 0.0]


def _splits(spark):
    feats = catalog.p3_features(spark, SF_SMALL)
    sp = split.chronological_split(feats, key="flight_id")
    return [sp.filter(F.col("split") == s).drop("split", "split_pos") for s in ("train", "val", "test")]


def test_models_fit_score_and_persist(spark):
    train, val, test = _splits(spark)
    num, cat, consts = prep.registry_v6(train, key=["flight_id"])
    assert "flight_date" not in num + cat and not any(c.startswith("carrier_") for c in num)
    pre = prep.Preprocessor(num, cat, scale=True).fit(train)
    lr = models.fit_logreg(train, pre, max_iter=50)
    s = models.score(lr, test)
    assert s.count() == test.count()
    assert s.filter((F.col(models.PROB) < 0) | (F.col(models.PROB) > 1)).count() == 0
    assert "delay_target" not in s.columns
    path = tempfile.mkdtemp(prefix="flightops-model-")
    again = models.load(models.save(lr, path))
    a = lr.predict(test).select("flight_id", F.col(models.PROB).alias("a"))
    b = again.predict(test).select("flight_id", F.col(models.PROB).alias("b"))
    assert a.join(b, "flight_id").filter(F.abs(F.col("a") - F.col("b")) > 1e-12).count() == 0
    imp = models.importance(lr)
    assert imp.count() == len(pre.feature_names())
    hl = explain.importance_highlights(imp).collect()
    assert {r["base_feature"] for r in hl} >= {"prior_route_frequency", "season"}


def test_permutation_is_a_permutation(spark):
    df = spark.range(500).withColumn("v", (F.col("id") * 7) % 13)
    out = explain.permute_column(df, "v", ["id"], seed=3)
    assert out.count() == 500
    assert sorted(r[0] for r in out.select("v").collect()) == sorted(r[0] for r in df.select("v").collect())
    assert out.join(df.withColumnRenamed("v", "v0"), "id").filter("v != v0").count() > 0


def test_streaming_scoring_matches_batch(spark):
    train, _, test = _splits(spark)
    num, cat, _ = prep.registry_v6(train, key=["flight_id"])
    pre = prep.Preprocessor(num, cat, scale=True).fit(train)
    lr = models.fit_logreg(train, pre, max_iter=30)
    root = tempfile.mkdtemp(prefix="flightops-stream-")
    src, sink, ckpt = (os.path.join(root, d) for d in ("in", "out", "ckpt"))
    test.write.parquet(src)
    q = scoring.start(scoring.score_stream(lr, scoring.feature_stream(spark, src, test.schema)), sink, ckpt, once=True)
    q.awaitTermination(120)
    streamed = spark.read.parquet(sink)
    batch = models.score(lr, test)
    assert streamed.count() == batch.count()
    assert streamed.select("flight_id", models.PROB, "risk_level").exceptAll(
        batch.select("flight_id", models.PROB, "risk_level")).count() == 0


def test_csv_source_and_sinks(spark):
    root = tempfile.mkdtemp(prefix="flightops-io-")
    csv = os.path.join(root, "raw.csv")
    with open(csv, "w") as fh:
        fh.write("FL_DATE,OP_UNIQUE_CARRIER,ORIGIN,DEST,CRS_DEP_TIME,ARR_DELAY,DISTANCE,CANCELLED,DIVERTED\n")
        fh.write("2024-01-01,AA,JFK,LAX,0800,16,2475,0,0\n2024-01-02,DL,ATL,MIA,0900,x,600,0,0\n")
    raw = files.read_table(spark, csv)
    assert all(t == "string" for _, t in raw.dtypes)
    canon = files.type_numeric(ingest.canonicalize(raw).df)
    assert dict(canon.dtypes)["arrival_delay"] == "double"
    cleaned = clean.clean_operational(canon)
    assert [r["delay_target"] for r in cleaned.collect()] == [1]      # 'x' delay -> invalid row
    out = files.write_table(cleaned, os.path.join(root, "clean"), partition_by=["flight_date"])
    back = spark.read.parquet(out)
    assert back.count() == 1 and "flight_date" in back.columns
    files.write_table(cleaned, os.path.join(root, "clean_csv"), fmt="csv")
    with pytest.raises(ValueError):
        files.file_format("data.zip")


def test_one_pass_permutation_importance_equals_explicit(spark):
    from flightops.operators import metrics
    train, val, _ = _splits(spark)
    num, cat, _ = prep.registry_v6(train, key=["flight_id"])
    lr = models.fit_logreg(train, prep.Preprocessor(num, cat, scale=True).fit(train), max_iter=30)
    cols = ["prior_origin_delay_rate", "airline"]
    got = {r["feature"]: r["permuted_pr_auc"] for r in
           explain.permutation_importance(lr, val, cols, ["flight_id"], seed=5).collect()}
    pairs = explain.permutation_pairs(val, ["flight_id"], 5)
    for c in cols:
        p = lr.predict(explain.permute_column(val, c, ["flight_id"], 5, pairs)).select(
            F.col("delay_target").alias("y"), F.col(models.PROB).alias("p"))
        assert metrics.average_precision(p).first()["pr_auc"] == got[c]
