"""Evaluation queries (M1-M3, E1-E12, A15) on the closed-form surrogate
predictors of FIXTURES.md: on cleaned listings ``y = log1p(price)``,
member A ``a = log1p(area * 3e3)``, member B ``b = log1p(1.5e5 + area * 4e2)``;
the confusion matrix predicts the segment of ``clamp(area * 2.2e3)``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.segments import DEFAULT_SEGMENTS, segment_expr
from ..operators import evaluate as E
from ..operators.prep import standardize as standardize_op
from ..operators.prep import train_test_split as split_op
from ..session import materialize
from ..sources.pois import importances
from .catalog import register
from .common import C, r
from .fixtures_sql import SEGMENT_CASE, with_views

LABELS = [s.name for s in DEFAULT_SEGMENTS]


def eval_frame(spark, sf):
    """Cleaned listings with segment, stratified exact split and surrogates."""
    # The split reads its rows several times: they are cleaned once.
    c = materialize(C(spark, sf).select("listing_id", "price", "area", segment_expr("price").alias("segment")))
    s = split_op(c, ["segment"])
    return s.select("listing_id", "segment", "is_test", "area",
                    F.log1p("price").alias("y"),
                    F.log1p(F.col("area") * F.lit(3e3)).alias("a"),
                    F.log1p(F.lit(1.5e5) + F.col("area") * F.lit(4e2)).alias("b"),
                    F.expm1(F.log1p("price")).alias("actual"))


_HASH = "('0x' || substr(md5(concat('42:', CAST(listing_id AS VARCHAR))), 1, 8))::BIGINT"
EV_CTE = f"""sp AS (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY h, listing_id) AS rn,
    count(*) OVER (PARTITION BY segment) AS n_seg
  FROM (SELECT listing_id, price, area, {SEGMENT_CASE} AS segment, {_HASH} AS h FROM clean) x),
ev AS (SELECT listing_id, segment, rn <= ceil(2e-1 * n_seg) AS is_test, area, ln(1e0 + price) AS y,
    ln(1e0 + area * 3e3) AS a, ln(1e0 + 1.5e5 + area * 4e2) AS b, exp(ln(1e0 + price)) - 1e0 AS actual FROM sp),
grid AS (SELECT segment, k, k * 5e-2 AS w,
    sqrt(avg(pow(exp(k * 5e-2 * a + (1e0 - k * 5e-2) * b) - 1e0 - actual, 2))) AS rmse
  FROM ev, range(0, 21) t(k) WHERE is_test GROUP BY segment, k),
best AS (SELECT segment, k AS best_k, w AS best_w, rmse AS best_rmse FROM (
    SELECT *, row_number() OVER (PARTITION BY segment ORDER BY rmse, k) AS o FROM grid) g WHERE o = 1),
pr AS (SELECT ev.*, best_w, exp(best_w * a + (1e0 - best_w) * b) - 1e0 AS pred FROM ev JOIN best USING (segment))"""


def ev_sql(body: str) -> str:
    return with_views(body, "clean", extra=EV_CTE)


def _metrics_sql(where: str, group: str = "segment") -> str:
    sel = f"{group}, " if group else ""
    grp = f" GROUP BY {group}" if group else ""
    return (f"SELECT {sel}count(*) AS n, sqrt(avg(pow(pred - actual, 2))) AS rmse, "
            f"1e0 - sum(pow(pred - actual, 2)) / (var_pop(actual) * count(*)) AS r2, "
            f"avg(abs(pred - actual)) AS mae, avg(actual) AS mean_actual FROM pr WHERE {where}{grp}")


def _with_pred(spark, sf):
    # Blend search and every metric read the split frame: it is computed once.
    ev = materialize(eval_frame(spark, sf))
    best = E.best_blend(E.blend_grid(ev.filter("is_test"), "a", "b", "actual", ["segment"]), ["segment"])
    # ``best`` has one row per segment (bounded by the configuration).
    j = ev.join(F.broadcast(best), "segment")
    return j.withColumn("pred", E.blend(F.col("a"), F.col("b"), F.col("best_w")))


@register("train_test_split", with_views(
    f"SELECT listing_id, rn <= ceil(2e-1 * n) AS is_test FROM (SELECT listing_id, "
    f"row_number() OVER (ORDER BY {_HASH}, listing_id) AS rn, count(*) OVER () AS n FROM clean) x", "clean"))
def train_test_split(spark, sf):
    """M1: exactly ceil(0.2 n) test rows by hash order, over all rows."""
    return split_op(C(spark, sf).select("listing_id"), []).select("listing_id", "is_test")


@register("stratified_split", ev_sql("SELECT listing_id, segment, is_test FROM ev"))
def stratified_split(spark, sf):
    """M2: the same split per segment (class shares kept)."""
    return eval_frame(spark, sf).select("listing_id", "segment", "is_test")


_STD = ["area", "bathrooms", "balcony_count", "latitude"]


@register("standardize", with_views(
    "SELECT listing_id, segment, " + ", ".join(
        f"round(({c} - mu_{c}) / CASE WHEN sd_{c} IS NULL OR sd_{c} = 0 THEN 1e0 ELSE sd_{c} END, 6) AS z_{c}"
        for c in _STD) + " FROM s JOIN st USING (segment)", "clean",
    extra=f"""sp AS (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY h, listing_id) AS rn,
    count(*) OVER (PARTITION BY segment) AS n_seg
  FROM (SELECT *, {SEGMENT_CASE} AS segment, {_HASH} AS h FROM clean) x),
s AS (SELECT *, rn <= ceil(2e-1 * n_seg) AS is_test FROM sp),
st AS (SELECT segment, """ + ", ".join(f"avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}" for c in _STD)
    + " FROM s WHERE NOT is_test GROUP BY segment)"))
def standardize(spark, sf):
    """M3: z-scores with train-split mean and population std per segment."""
    c = C(spark, sf).select("listing_id", segment_expr("price").alias("segment"), *_STD)
    s = split_op(c, ["segment"])
    z = standardize_op(s, _STD, fit_filter=~F.col("is_test"), group_cols=["segment"], suffix="_z")
    return z.select("listing_id", "segment", *[r(f"{x}_z").alias(f"z_{x}") for x in _STD])


@register("blend_grid", ev_sql("SELECT segment, k, w, round(rmse, 2) AS rmse FROM grid"))
def blend_grid(spark, sf):
    """Test RMSE of the blend for the 21 weights, per segment."""
    g = E.blend_grid(eval_frame(spark, sf).filter("is_test"), "a", "b", "actual", ["segment"])
    return g.select("segment", F.col("k").cast("bigint").alias("k"), "w", r("rmse", 2).alias("rmse"))


@register("best_blend", ev_sql("SELECT segment, best_k, best_w, round(best_rmse, 2) AS best_rmse FROM best"))
def best_blend(spark, sf):
    """Arg-min weight per segment (ties to the smaller weight)."""
    g = E.blend_grid(eval_frame(spark, sf).filter("is_test"), "a", "b", "actual", ["segment"])
    b = E.best_blend(g, ["segment"])
    return b.select("segment", F.col("best_k").cast("bigint").alias("best_k"), "best_w",
                    r("best_rmse", 2).alias("best_rmse"))


@register("blend_predict", ev_sql(
    "SELECT listing_id, segment, best_w, round(pred, 2) AS pred FROM pr WHERE is_test"))
def blend_predict(spark, sf):
    """Blended prediction of every test row with its segment's weight."""
    p = _with_pred(spark, sf).filter("is_test")
    return p.select("listing_id", "segment", "best_w", r("pred", 2).alias("pred"))


def _metric_cols(d, extra=()):
    return d.select(*extra, "n", r("rmse", 2).alias("rmse"), r("r2").alias("r2"), r("mae", 2).alias("mae"),
                    r("mean_actual", 2).alias("mean_actual"))


@register("regression_metrics", ev_sql(
    "SELECT segment, n, round(rmse, 2) AS rmse, round(r2, 6) AS r2, round(mae, 2) AS mae, "
    f"round(mean_actual, 2) AS mean_actual FROM ({_metrics_sql('is_test')}) m"))
def regression_metrics(spark, sf):
    """Test RMSE, R^2, MAE in price space per segment."""
    m = E.regression_metrics(_with_pred(spark, sf).filter("is_test"), "actual", "pred", ["segment"])
    return _metric_cols(m, ["segment"])


@register("overfitting", ev_sql(
    "SELECT t.segment, round(t.rmse, 2) AS test_rmse, round(tr.rmse, 2) AS train_rmse, "
    "round((t.rmse - tr.rmse) / tr.rmse * 1e2, 6) AS overfitting_pct "
    f"FROM ({_metrics_sql('is_test')}) t JOIN ({_metrics_sql('NOT is_test')}) tr USING (segment)"))
def overfitting(spark, sf):
    """Train vs test RMSE and the overfitting percentage."""
    p = _with_pred(spark, sf)
    m = E.regression_metrics(p, "actual", "pred", ["segment", "is_test"])
    t = m.filter("is_test").select("segment", F.col("rmse").alias("test_rmse"))
    tr = m.filter("not is_test").select("segment", F.col("rmse").alias("train_rmse"))
    j = t.join(tr, "segment")
    return j.select("segment", r("test_rmse", 2).alias("test_rmse"), r("train_rmse", 2).alias("train_rmse"),
                    r((F.col("test_rmse") - F.col("train_rmse")) / F.col("train_rmse") * F.lit(100.0))
                    .alias("overfitting_pct"))


@register("mae_pct", ev_sql(
    "SELECT segment, round(mean_actual, 2) AS test_mean, round(mae, 2) AS mae, "
    f"round(mae / mean_actual * 1e2, 6) AS mae_pct FROM ({_metrics_sql('is_test')}) m"))
def mae_pct(spark, sf):
    """E5: test mean price and MAE as % of it."""
    m = E.regression_metrics(_with_pred(spark, sf).filter("is_test"), "actual", "pred", ["segment"])
    return m.select("segment", r("mean_actual", 2).alias("test_mean"), r("mae", 2).alias("mae"),
                    r(F.col("mae") / F.col("mean_actual") * F.lit(100.0)).alias("mae_pct"))


@register("overall_metrics", ev_sql(
    "SELECT n, round(rmse, 2) AS pooled_rmse, round(r2, 6) AS r2, round(mae, 2) AS mae, "
    f"round(mean_actual, 2) AS mean_actual, round(mae / mean_actual * 1e2, 6) AS mae_pct "
    f"FROM ({_metrics_sql('is_test', group='')}) m"))
def overall_metrics(spark, sf):
    """Metrics over the concatenated test predictions of all segments."""
    m = E.regression_metrics(_with_pred(spark, sf).filter("is_test"), "actual", "pred")
    return m.select("n", r("rmse", 2).alias("pooled_rmse"), r("r2").alias("r2"), r("mae", 2).alias("mae"),
                    r("mean_actual", 2).alias("mean_actual"),
                    r(F.col("mae") / F.col("mean_actual") * F.lit(100.0)).alias("mae_pct"))


@register("weighted_rmse", ev_sql(
    "SELECT round(sum(rmse * n) / sum(n), 2) AS weighted_rmse, CAST(sum(n) AS BIGINT) AS total_test "
    f"FROM ({_metrics_sql('is_test')}) m"))
def weighted_rmse(spark, sf):
    """Test-size-weighted mean of the per-segment RMSEs."""
    m = E.regression_metrics(_with_pred(spark, sf).filter("is_test"), "actual", "pred", ["segment"])
    return m.agg(r(F.sum(F.col("rmse") * F.col("n")) / F.sum("n"), 2).alias("weighted_rmse"),
                 F.sum("n").cast("bigint").alias("total_test"))


@register("error_pct_of_segment_mean", ev_sql(
    "SELECT m.segment, round(a.seg_mean, 2) AS segment_mean, round(m.rmse / a.seg_mean * 1e2, 6) AS rmse_pct, "
    "round(m.mae / a.seg_mean * 1e2, 6) AS mae_pct "
    f"FROM ({_metrics_sql('is_test')}) m JOIN (SELECT segment, avg(actual) AS seg_mean FROM ev GROUP BY segment) a "
    "USING (segment)"))
def error_pct_of_segment_mean(spark, sf):
    """RMSE and MAE as % of the mean price of the whole segment."""
    p = _with_pred(spark, sf)
    m = E.regression_metrics(p.filter("is_test"), "actual", "pred", ["segment"])
    a = p.groupBy("segment").agg(F.avg("actual").alias("seg_mean"))
    j = m.join(a, "segment")
    return j.select("segment", r("seg_mean", 2).alias("segment_mean"),
                    r(F.col("rmse") / F.col("seg_mean") * F.lit(100.0)).alias("rmse_pct"),
                    r(F.col("mae") / F.col("seg_mean") * F.lit(100.0)).alias("mae_pct"))


@register("member_metrics", ev_sql(
    "SELECT segment, model, count(*) AS n, round(sqrt(avg(pow(p - actual, 2))), 2) AS rmse, "
    "round(1e0 - sum(pow(p - actual, 2)) / (var_pop(actual) * count(*)), 6) AS r2 FROM ("
    "SELECT segment, actual, 'a' AS model, exp(a) - 1e0 AS p FROM pr WHERE is_test UNION ALL "
    "SELECT segment, actual, 'b' AS model, exp(b) - 1e0 AS p FROM pr WHERE is_test UNION ALL "
    "SELECT segment, actual, 'blend' AS model, pred AS p FROM pr WHERE is_test) x GROUP BY segment, model"))
def member_metrics(spark, sf):
    """RMSE and R^2 of member A, member B and the blend side by side."""
    p = _with_pred(spark, sf).filter("is_test")
    s = p.select("segment", "actual", F.explode(F.array(
        F.struct(F.lit("a").alias("model"), F.expm1("a").alias("p")),
        F.struct(F.lit("b").alias("model"), F.expm1("b").alias("p")),
        F.struct(F.lit("blend").alias("model"), F.col("pred").alias("p")))).alias("_m")) \
        .select("segment", "actual", "_m.model", "_m.p")
    m = E.regression_metrics(s, "actual", "p", ["segment", "model"])
    return m.select("segment", "model", "n", r("rmse", 2).alias("rmse"), r("r2").alias("r2"))


_CM_PRED = SEGMENT_CASE.replace("price", "least(greatest(area * 2.2e3, 3e4), 6e5)")


@register("confusion_matrix", ev_sql(
    "SELECT g.actual, g.predicted, coalesce(c.n, 0) AS n FROM "
    "(SELECT a.name AS actual, p.name AS predicted FROM (VALUES ('budget'), ('mid_range'), ('premium')) a(name), "
    "(VALUES ('budget'), ('mid_range'), ('premium')) p(name)) g LEFT JOIN "
    f"(SELECT segment AS actual, {_CM_PRED} AS predicted, count(*) AS n FROM ev WHERE is_test GROUP BY 1, 2) c "
    "ON g.actual = c.actual AND g.predicted = c.predicted"))
def confusion_matrix(spark, sf):
    """Actual vs predicted segment on the test split, full 3x3 grid."""
    ev = eval_frame(spark, sf).filter("is_test")
    pred = segment_expr(F.least(F.greatest(F.col("area") * F.lit(2.2e3), F.lit(3e4)), F.lit(6e5)))
    return E.confusion_matrix(ev.select("segment", pred.alias("pred")), "segment", "pred", LABELS)


_CLS_SQL = ev_sql(f"""
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support,
  round(accuracy, 6) AS accuracy FROM (
  SELECT label, precision, recall,
    CASE WHEN precision + recall > 0 THEN 2e0 * precision * recall / (precision + recall) ELSE 0e0 END AS f1,
    support, sum(tp) OVER () / sum(support) OVER () AS accuracy
  FROM (SELECT label, CASE WHEN pred_n > 0 THEN tp / pred_n ELSE 0e0 END AS precision,
          CASE WHEN support > 0 THEN tp / support ELSE 0e0 END AS recall, support, tp
        FROM (SELECT actual AS label, count(*) AS support, CAST(count(*) FILTER (WHERE actual = predicted) AS DOUBLE) AS tp
              FROM cm GROUP BY actual) s
        JOIN (SELECT predicted AS label, count(*) AS pred_n FROM cm GROUP BY predicted) p USING (label)) q
) per
UNION ALL
SELECT 'weighted', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
  round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT), round(max(accuracy), 6) FROM (
  SELECT label, precision, recall,
    CASE WHEN precision + recall > 0 THEN 2e0 * precision * recall / (precision + recall) ELSE 0e0 END AS f1,
    support, sum(tp) OVER () / sum(support) OVER () AS accuracy
  FROM (SELECT label, CASE WHEN pred_n > 0 THEN tp / pred_n ELSE 0e0 END AS precision,
          CASE WHEN support > 0 THEN tp / support ELSE 0e0 END AS recall, support, tp
        FROM (SELECT actual AS label, count(*) AS support, CAST(count(*) FILTER (WHERE actual = predicted) AS DOUBLE) AS tp
              FROM cm GROUP BY actual) s
        JOIN (SELECT predicted AS label, count(*) AS pred_n FROM cm GROUP BY predicted) p USING (label)) q
) per2""").replace("pr AS (", f"cm AS (SELECT segment AS actual, {_CM_PRED} AS predicted FROM ev WHERE is_test),\npr AS (", 1)


@register("classification_metrics", _CLS_SQL)
def classification_metrics(spark, sf):
    """Accuracy and per-class / support-weighted precision, recall, F1."""
    ev = eval_frame(spark, sf).filter("is_test")
    pred = segment_expr(F.least(F.greatest(F.col("area") * F.lit(2.2e3), F.lit(3e4)), F.lit(6e5)))
    cm = E.confusion_matrix(ev.select("segment", pred.alias("pred")), "segment", "pred", LABELS)
    rep = E.classification_report(cm)
    return rep.select("label", r("precision").alias("precision"), r("recall").alias("recall"),
                      r("f1").alias("f1"), F.col("support").cast("bigint").alias("support"),
                      r("accuracy").alias("accuracy"))


@register("top_features_95", with_views("""
SELECT feature, importance, rank, round(cum_share, 6) AS cum_share FROM (
  SELECT feature, importance, row_number() OVER w AS rank,
    sum(importance) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(importance) OVER () AS cum_share,
    (sum(importance) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - importance)
      / sum(importance) OVER () AS prev_share
  FROM importances WINDOW w AS (ORDER BY importance DESC, feature)
) x WHERE prev_share < 9.5e-1""", "importances"))
def top_features_95(spark, sf):
    """The smallest prefix of features (by importance) holding 95 %."""
    d = E.cumulative_cut(importances(spark, sf), "importance", "feature", 0.95)
    return d.select("feature", "importance", F.col("rank").cast("bigint").alias("rank"),
                    r("cum_share").alias("cum_share"))
