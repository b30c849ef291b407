"""Source/sink queries: S7, S12, and validation as a stream (R6 source)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..operators import evaluate as E
from ..session import ensure_checkpoint_dir
from ..sources.quarantine import quarantine
from ..sources.requests import requests as requests_view
from ..sources.tables import table
from ..streaming.validate_stream import validation_stream
from .catalog import register
from .q_eval import _with_pred
from .q_requests import requests_sql

# Fixed value: fields per record of the points-of-interest CSV (id, kind, lat, lon).
POI_FIELDS = 4


# The downloaded files: every page itself, and beside three in four of them a sound table made of the
# page's id and length, or such a table that breaks off in the page or in a short line.
DOWNLOADS = """
SELECT page_id, 'page' AS file, coalesce(html, '') AS body FROM pages
UNION ALL
SELECT page_id, 'made' AS file, CASE page_id % 4
    WHEN 1 THEN concat('  ', page_id, ',stop,', length(html), ',1', {nl}, page_id, ',stop,2,3')
    WHEN 2 THEN concat(page_id, ',stop,1,2', {nl}, ' ', html)
    ELSE concat(page_id, ',stop,1,2', {nl}, {nl}, page_id, ',stop') END AS body
FROM pages WHERE page_id % 4 <> 0"""


@register("quarantine_source", f"""
WITH downloads AS ({DOWNLOADS.format(nl="chr(10)")}),
lines AS (SELECT page_id, file, trim(unnest(string_split(replace(replace(body, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10))),
  ' ' || chr(9) || chr(11) || chr(12) || chr(65279)) AS line FROM downloads),
facts AS (SELECT page_id, file, count(*) FILTER (line <> '') AS n, count(*) FILTER (line LIKE '<%') AS marked,
  count(*) FILTER (line <> '' AND length(line) - length(replace(line, ',', '')) <> 3) AS odd FROM lines GROUP BY page_id, file)
SELECT page_id, file, n > 0 AND marked = 0 AND odd = 0 AS is_valid,
  CASE WHEN n = 0 THEN 'empty' WHEN marked > 0 THEN 'markup, not delimited text'
       WHEN odd > 0 THEN 'unexpected field count' END AS quarantine_reason
FROM facts""")
def quarantine_source(spark, sf):
    """Downloaded documents that are markup instead of the expected
    4-field CSV, or break off in something else, are routed to quarantine with a reason."""
    table(spark, sf, "pages").createOrReplaceTempView("_quarantine_pages")
    files = spark.sql(DOWNLOADS.format(nl="char(10)").replace("FROM pages", "FROM _quarantine_pages"))
    return quarantine(files, "body", POI_FIELDS).select("page_id", "file", "is_valid", "quarantine_reason")


@register("stream_validate_requests", requests_sql(
    "SELECT request_id, status_code, error_kind, error FROM validated", validated=True))
def stream_validate_requests(spark, sf):
    """R6 with R1-R3: the requests land as parquet files in the shared
    checkpoint folder, a Structured Streaming query (availableNow) validates
    them into a parquet sink, and the sink is the result -- equal to the
    batch validation."""
    base = ensure_checkpoint_dir(spark)  # the cluster's folder; a scratch one only if unset
    run = os.path.join(base, f"stream-validate-{uuid.uuid4().hex}")
    src, sink, ck = (os.path.join(run, x) for x in ("source", "sink", "checkpoint"))
    requests_view(spark, sf).write.parquet(src)
    q = validation_stream(spark, src, sink, ck)
    q.awaitTermination()
    return spark.read.parquet(sink)


@register("run_metadata")
def run_metadata(spark, sf):
    """The run's metadata document -- per-segment results (test RMSE,
    R^2, MAE, mean, MAE %, train RMSE, overfitting %, test size, weights),
    the overall weighted RMSE and pooled metrics -- as one JSON row built
    from the surrogate evaluation (the trainer writes the same shape)."""
    p = _with_pred(spark, sf)
    m = E.regression_metrics(p, "actual", "pred", ["segment", "is_test"])
    t = m.filter("is_test").select("segment", "n", "rmse", "r2", "mae", "mean_actual")
    tr = m.filter("not is_test").select("segment", F.col("rmse").alias("train_rmse"))
    w = p.groupBy("segment").agg(F.first("best_w").alias("w"))
    seg = t.join(tr, "segment").join(w, "segment").select("segment", F.struct(
        F.col("rmse").alias("test_rmse"), F.col("r2").alias("test_r2"), F.col("mae").alias("test_mae"),
        F.col("mean_actual").alias("test_mean"), (F.col("mae") / F.col("mean_actual") * 100).alias("mae_pct"),
        "train_rmse", ((F.col("rmse") - F.col("train_rmse")) / F.col("train_rmse") * 100).alias("overfitting_pct"),
        F.col("n").alias("test_size"), F.col("w").alias("weight_a"), (1 - F.col("w")).alias("weight_b"),
    ).alias("r"), "n", "rmse")
    # Pooled test metrics: four scalars, attached as literals.
    o = E.regression_metrics(p.filter("is_test"), "actual", "pred").first()
    doc = seg.agg(F.map_from_entries(F.collect_list(F.struct("segment", "r"))).alias("results"),
                  (F.sum(F.col("rmse") * F.col("n")) / F.sum("n")).alias("overall_rmse"))
    return doc.select(F.to_json(F.struct(
        "results", "overall_rmse", F.lit(o["r2"]).alias("overall_r2"), F.lit(o["mae"]).alias("overall_mae"),
        F.lit(o["mean_actual"]).alias("overall_mean"))).alias("metadata"))
