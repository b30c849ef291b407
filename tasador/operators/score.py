"""Training pipelines and request scoring.

``training_frame`` builds the 40 or 45 features of the cleaned listings (one radius
join; the five further ones are location means), imputes global medians (exact, distributed), adds the log target,
the segment and the exact per-segment split, and is persisted once for all
fits. ``predict`` reads its rows once: all bundles travel in one broadcast (their size is
bounded by segments x rounds x leaves), and each row is scored by the trees of its segment.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.segments import DEFAULT_SEGMENTS, price_range_api, segment_expr, segments_df
from .ensemble import REFERENCE, Bundle, blended, fit_ensembles, with_arrow
from .features import FEATURES_40, GROUP_MEANS, build_features
from .neighborhood import loo_means
from .prep import impute_median, median_values, train_test_split


def training_frame(clean: DataFrame, reference: DataFrame, group_by_segment: bool = True,
                   features: list[str] = FEATURES_40, summary: dict | None = None):
    """Returns ``(frame, medians)``; the frame is persisted (caller
    unpersists). Columns whose median is NULL (all missing) are dropped."""
    tier = F.when(F.col("neighborhood_tier") == "premium", 1).otherwise(0)
    # The feature rows feed several passes (median refinement, split
    # cut-offs), so they are materialised once instead of re-running the
    # radius join per pass.
    means = [c for c in GROUP_MEANS if c in features]
    if means:
        clean = loo_means(clean, ["area", "bathrooms", "bedrooms"], keep=clean.columns)
    f = build_features(clean, reference, "listing_id", tier=tier, keep=["price", *means], summary=summary) \
        .persist(StorageLevel.MEMORY_AND_DISK)
    med = median_values(f, features)
    usable = [c for c in features if med.get(c) is not None]
    f = impute_median(f, usable, med).select(
        "listing_id", "price", *usable, F.log1p("price").alias("y"),
        segment_expr("price").alias("segment") if group_by_segment else F.lit("all").alias("segment"))
    f = train_test_split(f, ["segment"]).persist(StorageLevel.MEMORY_AND_DISK)
    return f, {c: med[c] for c in usable}


def train_models(frame: DataFrame, features: list[str], params: dict = REFERENCE, members=("a", "b")) -> dict[str, Bundle]:
    """M7/M8: one ensemble per segment value present in the frame, all of them
    and both members fitted together; then their blend weights."""
    bundles = fit_ensembles(frame, features, params, members)
    if len(members) == 2:
        blended(bundles, predict(frame.filter("is_test"), bundles))
    return bundles


def predict(frame: DataFrame, bundles: dict[str, Bundle]) -> DataFrame:
    """Adds ``pred_a, pred_b, pred_log, prediction`` (price space, no clamping) in one
    pass, each row by its segment's bundle. Rows of a segment
    without a bundle, or without one at all, stay with NULL predictions."""
    features = next((b.features for b in bundles.values()), [])
    shared = frame.sparkSession.sparkContext.broadcast(bundles)
    at = frame.columns.index("segment")

    def run(batch: pa.RecordBatch, columns: list[np.ndarray]) -> list[pa.Array]:
        segment = np.array(batch.column(at).to_pylist(), dtype=object)
        out = np.full((3, len(segment)), np.nan)
        known = np.zeros(len(segment), dtype=bool)
        for name, b in shared.value.items():
            rows = np.flatnonzero(segment == name)
            if len(rows):
                a, b_ = b.predict_log([x[rows] for x in columns])
                w = b.weight_a
                out[:, rows] = a, b_, b_ if w == 0 else a if w == 1 else w * a + (1 - w) * b_
                known[rows] = True
        return [pa.array(np.where(np.isnan(x), 0.0, x), pa.float64(), mask=~known | np.isnan(x)) for x in (*out, np.expm1(out[2]))]

    return with_arrow(frame, features, "pred_a double, pred_b double, pred_log double, prediction double", run)


def model_results(pred: DataFrame, bundles: dict[str, Bundle]) -> DataFrame:
    """Per-segment results table (the metadata's ``results``): test RMSE,
    R^2, MAE, mean, MAE %, train RMSE, overfitting %, test size, weights."""
    from .evaluate import regression_metrics
    p = pred.withColumn("actual", F.expm1("y"))
    m = regression_metrics(p, "actual", "prediction", ["segment", "is_test"])
    t = m.filter("is_test").drop("is_test")
    tr = m.filter("not is_test").select("segment", F.col("rmse").alias("train_rmse"))
    spark = pred.sparkSession
    w = spark.createDataFrame([(k, b.weight_a, 1 - b.weight_a, b.best_iter_b) for k, b in bundles.items()],
                              "segment string, weight_a double, weight_b double, best_iter_b int")
    return (t.join(tr, "segment").join(F.broadcast(w), "segment")
            .select("segment", F.col("rmse").alias("test_rmse"), F.col("r2").alias("test_r2"),
                    F.col("mae").alias("test_mae"), F.col("mean_actual").alias("test_mean"),
                    (F.col("mae") / F.col("mean_actual") * 100).alias("mae_pct"), "train_rmse",
                    ((F.col("rmse") - F.col("train_rmse")) / F.col("train_rmse") * 100).alias("overfitting_pct"),
                    F.col("n").alias("test_size"), "weight_a", "weight_b", "best_iter_b"))


def save_bundles(bundles: dict[str, Bundle], path: str) -> None:
    """One directory per segment (a table of trees, a manifest)."""
    for name, b in bundles.items():
        b.save(os.path.join(path, f"segment={name}"))


def load_bundles(spark, path: str, names) -> dict[str, Bundle]:
    return {n: Bundle.load(spark, os.path.join(path, f"segment={n}")) for n in names}


def score_requests(valid: DataFrame, reference: DataFrame, bundles: dict[str, Bundle], medians: dict,
                   summary: dict | None = None) -> DataFrame:
    """M11 + R4: features of every valid request (tier 0), the training
    medians as the fill for missing values (a single request has no median
    of its own), routed by the requested segment."""
    f = build_features(valid, reference, "request_id", keep=["segment"], summary=summary)
    f = f.select("request_id", "segment", *[F.coalesce(F.col(c).cast("double"), F.lit(medians[c])).alias(c)
                                            if c in medians else F.col(c) for c in FEATURES_40])
    return predict(f, bundles)


def responses(scored: DataFrame, segments=DEFAULT_SEGMENTS) -> DataFrame:
    """``prediction, segment, segment_description, price_range`` plus
    the JSON body. The segment table is bounded by configuration."""
    s = segments_df(scored.sparkSession, segments)
    j = scored.join(F.broadcast(s), scored.segment == s.name, "left")  # a segment that is not configured keeps its row
    body = F.to_json(F.struct(F.col("prediction"), F.col("segment"),
                              F.col("description").alias("segment_description"),
                              price_range_api(F.col("price_min"), F.col("price_max")).alias("price_range")))
    return j.select("request_id", "prediction", "segment", F.col("description").alias("segment_description"),
                    price_range_api(F.col("price_min"), F.col("price_max")).alias("price_range"),
                    body.alias("response"))


