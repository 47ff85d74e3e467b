"""Streaming scoring of feature files as they land.

The model is fitted in batch; each micro-batch is a stateless map (the
preprocessor's column expressions, the Spark ML model, the risk tier), so
the stream needs no state store or watermark. Output goes through a
checkpointed sink, so a restarted query resumes without re-scoring files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..ml.models import Fitted, score


def feature_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int = 16) -> DataFrame:
    """Parquet feature files arriving under ``path`` (schema must be given)."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def score_stream(fitted: Fitted, stream: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Same expressions as batch scoring (probability, class, risk tier)."""
    return score(fitted, stream, threshold)


def start(scored: DataFrame, sink_path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append scored rows to parquet; ``once`` processes what is there and stops."""
    w = scored.writeStream.format("parquet").option("path", sink_path).option("checkpointLocation", checkpoint) \
        .outputMode("append")
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime="30 seconds")
    return w.start()
