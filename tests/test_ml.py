"""Model fitting, persistence round trip, and stream == batch scoring."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tasador.operators.ensemble import FAST
from tasador.operators.features import FEATURES_40
from tasador.operators.neighborhood import reference_summary
from tasador.operators.score import (load_bundles, predict, save_bundles, score_requests, train_models,
                                     training_frame)
from tasador.operators.validate import validate
from tasador.plans.common import C, L
from tasador.sources.requests import parse_requests, requests
from tasador.streaming.score_stream import score_batch, start
from conftest import SF_SMALL

SMALL = dict(FAST, max_iter=4)


def test_train_save_load_stream(spark):
    ref = L(spark, SF_SMALL)
    summary = reference_summary(ref)
    frame, med = training_frame(C(spark, SF_SMALL), ref, summary=summary)
    feats = [c for c in FEATURES_40 if c in med]
    bundles = train_models(frame, feats, SMALL)
    assert set(bundles) == {"budget", "mid_range", "premium"}
    for b in bundles.values():
        assert 0.0 <= b.weight_a <= 1.0 and 1 <= b.best_iter_b <= 4

    # Better than predicting the mean on the training rows (in log space).
    p = predict(frame, bundles)
    m = p.agg(F.avg((F.col("pred_log") - F.col("y")) ** 2).alias("mse"), F.var_pop("y").alias("var")).first()
    assert m["mse"] < m["var"]

    d = tempfile.mkdtemp(prefix="tasador-models-", dir="/tmp")
    save_bundles(bundles, d)
    loaded = load_bundles(spark, d, list(bundles))
    a = {r["listing_id"]: r["prediction"] for r in predict(frame, bundles).collect()}
    b = {r["listing_id"]: r["prediction"] for r in predict(frame, loaded).collect()}
    assert a == b

    # Streaming over parquet request files equals the batch pipeline.
    req = requests(spark, SF_SMALL)
    src = os.path.join(d, "src")
    req.write.parquet(src)
    batch = {r["request_id"]: (r["status_code"], r["response"]) for r in
             score_batch(spark.read.parquet(src), ref, bundles, med, summary).collect()}
    sink, ck = os.path.join(d, "sink"), os.path.join(d, "ck")
    q = start(spark, src, sink, ck, ref, bundles, med, summary)
    q.awaitTermination(300)
    streamed = {r["request_id"]: (r["status_code"], r["response"]) for r in spark.read.parquet(sink).collect()}
    assert streamed == batch
    assert sum(1 for v in batch.values() if v[0] == 200) > 0
