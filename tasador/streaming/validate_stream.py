"""Request validation as Structured Streaming (R1-R3 over R6's source).

Stateless: each micro-batch is parsed and validated with the batch
operators and appended to a parquet sink; the checkpoint folder records the
processed files, so a restarted query continues where it stopped.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators.validate import validate
from ..sources.requests import parse_requests

REQUEST_STREAM_SCHEMA = "request_id bigint, event_time timestamp_ntz, payload string"


def validation_stream(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str,
                      available_now: bool = True):
    stream = spark.readStream.schema(REQUEST_STREAM_SCHEMA).parquet(source_dir)
    out = validate(parse_requests(stream, keep_variant=True)).select(
        "request_id", "status_code", "error_kind", "error")
    w = out.writeStream.format("parquet").option("path", sink_dir).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.outputMode("append").start()
