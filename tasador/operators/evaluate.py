"""Evaluation operators.

All metrics are algebraic aggregates (sums, counts, ``var_pop``) computed
in one grouped pass with partial aggregation; nothing collects predictions.
R^2 uses ``SST = var_pop(y) * n`` (a numerically stable moment merge), never
``sum(y^2) - n * mean^2``. The blend-weight search evaluates all 21 weights
inside one aggregate (21 RMSE columns) instead of replicating every row 21
times, then unpivots the few result rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The weight grid of the blend search, k * 0.05 for k = 0..20.
GRID_STEPS = 21
GRID_STEP = 0.05


def grid_weights() -> list[float]:
    return [k * GRID_STEP for k in range(GRID_STEPS)]


def blend(a: Column, b: Column, w) -> Column:
    """``expm1(w a + (1 - w) b)`` -- blend in log space, back to price."""
    w = F.lit(w) if isinstance(w, float) else w
    return F.expm1(w * a + (F.lit(1.0) - w) * b)


def regression_metrics(df: DataFrame, actual: str, pred: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """``n, rmse, r2, mae, mean_actual`` per group."""
    e = F.col(pred) - F.col(actual)
    g = df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.sum(e * e).alias("_sse"),
        (F.var_pop(actual) * F.count(F.lit(1))).alias("_sst"),
        F.avg(F.abs(e)).alias("mae"),
        F.avg(actual).alias("mean_actual"),
    )
    return g.select(*group_cols, "n", "rmse", (F.lit(1.0) - F.col("_sse") / F.col("_sst")).alias("r2"),
                    "mae", "mean_actual")


def blend_grid(df: DataFrame, a: str, b: str, actual: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """E2 grid: ``(group, k, w, rmse)`` for the 21 weights, one pass."""
    ws = grid_weights()
    aggs = [F.sqrt(F.avg(F.pow(blend(F.col(a), F.col(b), w) - F.col(actual), 2))).alias(f"_r{k}")
            for k, w in enumerate(ws)]
    g = df.groupBy(*group_cols).agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(w).alias("w"), F.col(f"_r{k}").alias("rmse"))
                               for k, w in enumerate(ws)]))
    return g.select(*group_cols, rows.alias("_g")).select(*group_cols, "_g.k", "_g.w", "_g.rmse")


def best_blend(grid: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """E2 arg-min: smallest RMSE, ties to the smallest weight (the strict
    ``<`` of a loop from w = 0). ``min_by`` over a (rmse, k) struct."""
    key = F.struct("rmse", "k")
    return grid.groupBy(*group_cols).agg(F.min_by("k", key).alias("best_k"), F.min_by("w", key).alias("best_w"),
                                         F.min("rmse").alias("best_rmse"))


def confusion_matrix(df: DataFrame, actual: str, predicted: str, labels: Sequence[str]) -> DataFrame:
    """Long form ``(actual, predicted, n)`` over the full label grid,
    zero cells included. The grid is labels x labels (bounded by the
    configuration); the counts are a grouped aggregate."""
    spark = df.sparkSession
    grid = spark.createDataFrame([(x, y) for x in labels for y in labels], "actual string, predicted string")
    counts = df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))
    return (grid.join(counts, ["actual", "predicted"], "left")
            .select("actual", "predicted", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))


def classification_report(cm: DataFrame) -> DataFrame:
    """E10 from a confusion matrix: per label precision, recall, F1,
    support, plus a ``weighted`` row (support-weighted means) and the
    accuracy on every row. Works on the labels x labels cells only."""
    tp = F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0))
    by_actual = cm.groupBy(F.col("actual").alias("label")).agg(F.sum("n").alias("support"), tp.alias("tp"))
    by_pred = cm.groupBy(F.col("predicted").alias("label")).agg(F.sum("n").alias("pred_n"))
    j = by_actual.join(by_pred, "label", "full")
    prec = F.when(F.col("pred_n") > 0, F.col("tp") / F.col("pred_n")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    per = j.select("label", prec.alias("precision"), rec.alias("recall"), "support", "tp")
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                F.lit(2.0) * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))) \
        .otherwise(F.lit(0.0))
    per = per.select("*", f1.alias("f1"))
    w = Window.partitionBy()
    total = F.sum("support").over(w)
    per = per.select("*", (F.sum("tp").over(w) / total).alias("accuracy"), total.alias("_total"))
    weighted = per.groupBy().agg(
        F.lit("weighted").alias("label"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("precision"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("recall"),
        F.sum("support").alias("support"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"),
        F.first("accuracy").alias("accuracy"))
    cols = ["label", "precision", "recall", "f1", "support", "accuracy"]
    return per.select(*cols).unionByName(weighted.select(*cols))


def cumulative_cut(df: DataFrame, value: str, key: str, share: float = 0.95) -> DataFrame:
    """Rows sorted by ``value`` desc (then ``key``), kept while the
    running share *before* the row is below ``share`` -- the smallest prefix
    whose share reaches it. The input is a feature list (bounded by the
    number of features), so the global ordering window is small."""
    w = Window.orderBy(F.col(value).desc(), F.col(key))
    run = F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    total = F.sum(value).over(Window.partitionBy())
    d = df.select(key, value, F.row_number().over(w).alias("rank"), (run / total).alias("cum_share"),
                  ((run - F.col(value)) / total).alias("_prev"))
    return d.filter(F.col("_prev") < F.lit(share)).drop("_prev")
