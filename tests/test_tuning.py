"""The registered tuning fits every point of the grids; boosting points share the fits of longer ones."""

from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from flightops.ml import models, prep
from flightops.operators import metrics
from flightops.plans import ml_queries
from flightops.session import stage_table

GRID = [{"iters": n, "depth": 2, "step": step, "subsample": 0.8, "subset": "all"} for n in (2, 5) for step in (0.1, 0.3)]


@pytest.fixture(scope="module")
def parts(spark):
    rng = np.random.default_rng(3)
    n = 1200
    x = rng.normal(size=(n, 2)).round(2)
    y = (x[:, 0] + 0.5 * x[:, 1] ** 2 + rng.normal(size=n) > 0.4).astype(int)
    rows = [(i, float(a), float(b), "abc"[i % 3], int(t)) for i, ((a, b), t) in enumerate(zip(x, y))]
    table = spark.createDataFrame(rows, "flight_id long, x double, z double, c string, delay_target int")
    train, val = table.where("flight_id % 4 > 0"), table.where("flight_id % 4 = 0")
    return train, val, prep.Preprocessor(["x", "z"], ["c"]).fit(train)


def test_the_registered_tuning_is_given_the_whole_grids(spark, monkeypatch):
    given = {}
    monkeypatch.setattr(models, "tune_families", lambda train, val, families, **how: given.update(families) or (None, {}))
    monkeypatch.setattr(models, "encode", lambda train, p, target="delay_target": train)
    ctx = {"train": None, "val": None, "prep_scaled": SimpleNamespace(), "prep_plain": SimpleNamespace(), "encoded": {}}
    monkeypatch.setattr(ml_queries, "context", lambda *a: ctx)
    ml_queries.tuned(spark, "nowhere")
    assert {f: points for f, (_, points) in given.items()} == {f: models.grid_points(f) for f in models.FITTERS}
    assert sum(len(points) for _, points in given.values()) == 98


def test_shared_fits_serve_every_point_once():
    p = SimpleNamespace()
    points = [(f, i, p, params) for f in models.FITTERS for i, params in enumerate(models.grid_points(f))]
    fits = models.shared_fits(points)
    assert sorted(k for _, served in fits for k in served) == list(range(98)) and len(fits) == 8 + 18 + 36
    for params, served in fits:
        for k in served:
            rest = {n: v for n, v in points[k][3].items() if n != "iters"}
            assert rest == {n: v for n, v in params.items() if n != "iters"} and points[k][3].get("iters", 0) <= params.get("iters", 0)


def test_points_of_a_shared_fit_equal_their_own_fits(spark, parts):
    train, val, p = parts
    encoded = stage_table(p.transform(train).select("delay_target", "features"), "encoded")  # draws depend on the table's files
    table, best = models.tune_families(train, val, {"gradient_boosting": (p, GRID)}, encoded={id(p): encoded})
    got = {r["grid_index"]: r["val_pr_auc"] for r in table.collect()}
    assert len(got) == len(GRID)
    for i, params in enumerate(GRID):
        own = models.fit_boosting(train, p, encoded=encoded, **params)
        scores = own.predict(val).select(F.lit(0).alias("point"), F.col("delay_target").alias("y"), F.col(models.PROB).alias("p"))
        assert got[i] == metrics.average_precision(scores, groups=["point"], rounded=False).first()["pr_auc"]
    assert best["gradient_boosting"].model.getNumTrees == GRID[max(got, key=lambda k: (got[k], -k))]["iters"]


def test_shortened_boosting_is_the_shorter_fit(spark, parts, tmp_path):
    train, val, p = parts
    long, short = (models.fit_boosting(train, p, iters=n, depth=3, step=0.2, subsample=0.8, subset="0.8") for n in (6, 3))
    cut = models.shortened(long, 3)
    at = lambda f: [r[0] for r in f.predict(val).orderBy("flight_id").select(models.PROB).collect()]
    assert at(cut) == at(short) != at(long) and cut.model.getMaxIter() == cut.model.getNumTrees == 3
    assert models.shortened(short, 3) is short
    assert at(models.load(models.save(cut, f"file://{tmp_path}/cut"))) == at(short)
