"""Request scoring as Structured Streaming.

The stream carries JSON payloads. Parsing, validation and the feature
projection are stateless; the neighbourhood statistics need the listings
as the static side of a stream-static join, and their aggregation is per
request, so each micro-batch is scored with the batch pipeline inside
``foreachBatch`` and appended to a parquet sink keyed by ``batch_id`` --
a replayed batch overwrites its own output, which keeps the sink
idempotent when a batch is retried after an executor loss. No streaming
state is kept.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.segments import DEFAULT_SEGMENTS
from ..operators.score import responses, score_requests
from ..operators.validate import validate
from ..sources.requests import parse_requests

REQUEST_STREAM_SCHEMA = "request_id bigint, event_time timestamp_ntz, payload string"


def score_batch(batch: DataFrame, reference: DataFrame, bundles: dict, medians: dict,
                summary: dict | None = None) -> DataFrame:
    """Everything for one set of requests: validation outcome for all of
    them, prediction and response body for the valid ones; as many rows out as
    in."""
    segments = [s for s in DEFAULT_SEGMENTS if s.name in bundles]  # the endpoint offers what it has loaded
    v = validate(parse_requests(batch, keep_variant=True), segments)
    ok = v.filter(F.col("status_code") == 200)
    scored = responses(score_requests(ok, reference, bundles, medians, summary))
    bad = v.filter(F.col("status_code") != 200).select(
        "request_id", "status_code", F.to_json(F.struct(F.col("error"))).alias("response"))
    good = scored.select("request_id", F.lit(200).alias("status_code"), "response")
    return good.unionByName(bad)


def start(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str, reference: DataFrame,
          bundles: dict, medians: dict, summary: dict | None = None, available_now: bool = True):
    """Start the stream over parquet files of requests in ``source_dir``."""
    stream = spark.readStream.schema(REQUEST_STREAM_SCHEMA).parquet(source_dir)

    def handle(batch: DataFrame, batch_id: int) -> None:
        out = score_batch(batch, reference, bundles, medians, summary)
        out.write.mode("overwrite").parquet(os.path.join(sink_dir, f"batch_id={batch_id}"))

    w = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
