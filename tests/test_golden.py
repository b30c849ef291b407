"""Golden facts published by the reference's metadata and reports."""
import pytest
from pyspark.sql import functions as F

from tasador.operators import evaluate as E
from tasador.operators.ensemble import patience_best

LABELS = ["budget", "mid_range", "premium"]
MATRIX = [[1128, 261, 0], [429, 2084, 251], [0, 137, 648]]


def test_classification_metrics_from_published_matrix(spark):
    rows = [(LABELS[i], LABELS[j], n) for i in range(3) for j in range(3) for n in [MATRIX[i][j]]]
    # Expand to one row per test example so the operator sees raw pairs.
    df = spark.createDataFrame(rows, "a string, p string, n long").filter("n > 0").select(
        "a", "p", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("_"))
    cm = E.confusion_matrix(df, "a", "p", LABELS)
    rep = {r["label"]: r for r in E.classification_report(cm).collect()}
    assert rep["weighted"]["accuracy"] == pytest.approx(0.7816929931146213, abs=1e-12)
    assert rep["weighted"]["precision"] == pytest.approx(0.7883551502654971, abs=1e-12)
    assert rep["weighted"]["recall"] == pytest.approx(0.7816929931146213, abs=1e-12)
    assert rep["weighted"]["f1"] == pytest.approx(0.782469233608859, abs=1e-12)
    assert rep["budget"]["precision"] == pytest.approx(0.7244701348747592, abs=1e-12)
    assert rep["mid_range"]["recall"] == pytest.approx(0.7539797395079595, abs=1e-12)
    assert rep["premium"]["f1"] == pytest.approx(0.7695961995249406, abs=1e-12)
    assert rep["weighted"]["support"] == 4938


def test_weighted_rmse_from_segment_rows(spark):
    rows = [("budget", 15236.780885701613, 1389), ("mid_range", 35221.81184551709, 2765),
            ("premium", 66744.72464784788, 785)]
    df = spark.createDataFrame(rows, "segment string, rmse double, n long")
    w = df.agg((F.sum(F.col("rmse") * F.col("n")) / F.sum("n")).alias("w")).first()["w"]
    assert w == pytest.approx(34611.62325403015, rel=1e-12)


def test_grid_weight_representation():
    assert E.grid_weights()[17] == 0.8500000000000001
    assert len(E.grid_weights()) == 21


def test_patience_best():
    assert patience_best([5, 4, 3, 3.5, 3.2]) == 3
    losses = [10 - i for i in range(10)] + [1.5] * 60 + [0.1]
    assert patience_best(losses, patience=50) == 10  # stops before the late improvement
    assert patience_best([3, 2, 1]) == 3


def test_segmentation_balance_and_weighted_cv(spark):
    from tasador.operators.segments import strategy_stats
    from tasador.functions.segments import Segment
    df = spark.createDataFrame([(p,) for p in [40000.0, 50000.0, 200000.0, 250000.0, 260000.0, 600000.0]],
                               "price double")
    strat = {"s": (Segment("low", 30000, 150000), Segment("high", 150000, 600000))}
    rows = {r["segment"]: r for r in strategy_stats(df, strat).collect()}
    assert rows["low"]["n"] == 2 and rows["high"]["n"] == 3
    assert rows["low"]["balance_score"] == pytest.approx(2 / 3)
    assert rows["low"]["n_all"] == 6  # the 600,000 row is outside every half-open segment
