"""Batch scoring (M17) applied to a stream of prepared feature rows.

The studied workflow has no streaming; this only lets the same fitted feature pipeline
and classifier score feature files as they land. Both are stateless row transforms, so
Structured Streaming runs them per micro-batch with no state store; progress is kept in
a checkpoint folder under the cluster's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from typing import Optional

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from orderlens.operators.metrics import positive_probability
from orderlens.session import scratch_path


def score_stream(spark: SparkSession, feature_model, model, source_dir: str, schema: T.StructType,
                 sink_dir: str, checkpoint_dir: Optional[str] = None, trigger_once: bool = True):
    """Start a query reading Parquet feature rows from ``source_dir`` and appending
    (order_id, prediction, p1) Parquet files to ``sink_dir``. Returns the StreamingQuery."""
    stream = spark.readStream.schema(schema).parquet(source_dir)
    scored = positive_probability(model.transform(feature_model.transform(stream)))
    writer = (scored.select("order_id", "prediction", "p1").writeStream
              .format("parquet").option("path", sink_dir)
              .option("checkpointLocation", checkpoint_dir or scratch_path(spark, "score-stream-ckpt"))
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if trigger_once else writer.trigger(processingTime="1 minute")
    return writer.start()
