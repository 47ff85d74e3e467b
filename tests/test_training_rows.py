"""The encoded training rows of all fits: whole, dealt evenly, and the same whatever the layout of the table."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from flightops.ml import models, prep


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(7)
    n = 24_000
    x = rng.normal(size=n).round(3)
    rows = [(i, float(v) if i % 50 else None, "abc"[i % 3], int(v + w > 0)) for i, (v, w) in enumerate(zip(x, rng.normal(size=n)))]
    rows += rows[:5]
    return spark.createDataFrame(rows, "flight_id long, x double, c string, delay_target int")


def content(df):
    return sorted(map(str, df.select("delay_target", vector_to_array("features").alias("f")).collect()))


def sizes(df):
    return [r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_few_files_are_dealt_to_all_cores_without_loss(spark, train, monkeypatch):
    monkeypatch.setattr(models, "TASK_ROWS", 100)
    table = train.coalesce(1)
    p = prep.Preprocessor(["x"], ["c"]).fit(table)
    got = models.encode(table, p)
    assert content(got) == content(p.transform(table))
    cores = spark.sparkContext.defaultParallelism
    most = max(sizes(got))
    assert most <= 1.3 * train.count() / cores
    assert content(models.encode(table.where("false"), p)) == []


def test_a_task_holds_no_more_in_a_larger_table(spark, train, monkeypatch):
    monkeypatch.setattr(models, "TASK_ROWS", 10)
    p = prep.Preprocessor(["x"], ["c"]).fit(train)
    cores = spark.sparkContext.defaultParallelism
    for rows in (-(-train.count() // cores), 500, 250):
        monkeypatch.setattr(models, "FILE_ROWS", rows)
        got = models.encode(train.coalesce(2), p)
        assert max(sizes(got)) <= 1.5 * rows and got.count() == train.count()


def test_uneven(monkeypatch):
    monkeypatch.setattr(models, "TASK_ROWS", 2000)
    assert not models.uneven([], 4) and not models.uneven([5000], 4) and not models.uneven([5000] * 4, 4) and not models.uneven([5000] * 40, 4)
    assert models.uneven([5000] * 5, 4) and models.uneven([9000], 4) and models.uneven([9000, 9000, 9000, 9000, 20000], 4)
    assert models.uneven([models.FILE_ROWS + 1] * 4, 4) and not models.uneven([models.FILE_ROWS] * 4, 4)


def test_even_tables_are_read_as_they_are(spark, train):
    p = prep.Preprocessor(["x"], ["c"]).fit(train)
    assert models.dealt(train.limit(100), p) is None
    assert content(models.encode(train.limit(100), p)) == content(p.transform(train.limit(100)))


def test_a_fit_does_not_depend_on_the_order_of_the_table(spark, train, monkeypatch):
    monkeypatch.setattr(models, "TASK_ROWS", 100)
    p = prep.Preprocessor(["x"], ["c"]).fit(train)
    orders = [train.coalesce(1), train.coalesce(1).sortWithinPartitions(F.desc("x"))]
    for fit in (lambda t: models.fit_forest(t, p, trees=5, depth=3), lambda t: models.fit_boosting(t, p, iters=3, depth=2, subsample=0.7)):
        a, b = ([r[0] for r in fit(t).predict(train).orderBy("flight_id").select(models.PROB).collect()] for t in orders)
        assert a == b
