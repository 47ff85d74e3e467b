"""End-to-end lazy plans over a directory of test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import uuid

from ..operators import clean
from ..session import checkpoint_dir, forget_at_exit
from ..sources import fixtures, ingest

KEY = ["flight_id"]
_WRITTEN: dict[tuple[str, str, str], str] = {}


def materialize(spark: SparkSession, name: str, df, sf_dir: str) -> DataFrame:
    """Write ``df`` once per (application, table, input) as parquet under the
    shared checkpoint folder and read it back: later plans scan it with
    column pruning and pushed filters instead of recomputing the lineage."""
    app = spark.sparkContext.applicationId
    k = (app, name, sf_dir)
    if k not in _WRITTEN:
        path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
        (df() if callable(df) else df).write.mode("overwrite").parquet(path)
        forget_at_exit(spark, path)
        _WRITTEN[k] = path
    return spark.read.parquet(_WRITTEN[k])


def canonical_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.canonicalize(fixtures.raw_flights(spark, sf_dir)).df


def cleaned_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_operational(canonical_flights(spark, sf_dir))


def pre_departure(spark: SparkSession, sf_dir: str, written: bool = True) -> DataFrame:
    """Pre-departure table; by default the write-once copy (phase hand-off
    by file, as in a production pipeline)."""
    def plan():
        return clean.pre_departure(cleaned_flights(spark, sf_dir))
    return materialize(spark, "pre_departure", plan, sf_dir) if written else plan()


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.raw_weather(spark, sf_dir)
