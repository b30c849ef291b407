"""Segment queries: J2, A10-A14, P17-P18."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.segments import DEFAULT_SEGMENTS, price_range_api, segment_display
from ..operators import segments as S
from .catalog import register
from .common import C, r
from .fixtures_sql import SEGMENT_CASE, with_views


def sql_half_open(segs, col: str = "price") -> str:
    whens = " ".join(f"WHEN {col} >= {float(s.price_min)!r} AND {col} < {float(s.price_max)!r} THEN '{s.name}'"
                     for s in segs)
    return f"CASE {whens} END"


@register("assign_segment_join", with_views(
    "SELECT c.listing_id, c.price, s.name AS segment FROM clean c LEFT JOIN segments s "
    "ON (c.price >= s.price_min AND c.price < s.price_max) OR (c.price = s.price_max AND s.ord = 2)",
    "clean", "segments"))
def assign_segment_join(spark, sf):
    return S.assign_segment_join(C(spark, sf).select("listing_id", "price"))


@register("segment_distribution", with_views(f"""
SELECT s.name AS segment, s.ord, coalesce(g.n, 0) AS n,
  round(coalesce(g.n, 0) * 100e0 / (SELECT count(*) FROM clean), 6) AS pct,
  concat('$', format('{{:,.0f}}', s.price_min), '-$', format('{{:,.0f}}', s.price_max)) AS price_range
FROM segments s LEFT JOIN (SELECT {SEGMENT_CASE} AS segment, count(*) AS n FROM clean GROUP BY 1) g
  ON g.segment = s.name""", "clean", "segments"))
def segment_distribution(spark, sf):
    d = S.segment_distribution(C(spark, sf))
    return d.select("segment", "ord", "n", r("pct").alias("pct"), "price_range")


@register("segment_labels", with_views(f"""
SELECT s.name AS segment,
  concat('$', format('{{:,.0f}}', s.price_min), '-$', format('{{:,.0f}}', s.price_max)) AS price_range,
  concat(CASE s.name WHEN 'budget' THEN 'Económico' WHEN 'mid_range' THEN 'Medio'
                     WHEN 'premium' THEN 'Premium' ELSE s.name END,
         ' ($', format('{{:,.0f}}', s.price_min), ' - $', format('{{:,.0f}}', s.price_max), ')') AS display,
  coalesce(g.n, 0) AS n
FROM segments s LEFT JOIN (SELECT {SEGMENT_CASE} AS segment, count(*) AS n FROM clean GROUP BY 1) g
  ON g.segment = s.name""", "clean", "segments"))
def segment_labels(spark, sf):
    """API price range and Spanish display label per segment (P17, P18),
    with the number of cleaned listings in each."""
    d = S.segment_distribution(C(spark, sf))
    seg = S.segments_df(spark)
    return (seg.join(d.select("segment", "n"), seg.name == d.segment, "left")
            .select(F.col("name").alias("segment"),
                    price_range_api(F.col("price_min"), F.col("price_max")).alias("price_range"),
                    segment_display(F.col("name"), F.col("price_min"), F.col("price_max")).alias("display"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))


_LAB3 = sql_half_open(DEFAULT_SEGMENTS)

_STATS_SQL = with_views(f"""
SELECT segment, count(*) AS n,
  round(count(*) * 100e0 / (SELECT count(*) FROM clean), 6) AS pct,
  round(avg(price), 2) AS mean_price, round(median(price), 2) AS median_price,
  round(stddev_samp(price), 2) AS std_price,
  round(100e0 * stddev_samp(price) / avg(price), 6) AS cv_pct
FROM (SELECT {_LAB3} AS segment, price FROM clean) x
WHERE segment IS NOT NULL GROUP BY segment""", "clean")


@register("segment_stats", _STATS_SQL)
def segment_stats(spark, sf):
    """N, share, mean, exact median, sample std, CV per segment."""
    s = S.segment_stats(C(spark, sf))
    return s.select("segment", "n", r("pct").alias("pct"), r("mean", 2).alias("mean_price"),
                    r("median", 2).alias("median_price"), r("std", 2).alias("std_price"),
                    r("cv_pct").alias("cv_pct"))


@register("segment_cv", with_views(f"""
SELECT segment, round(100e0 * stddev_samp(price) / avg(price), 6) AS cv_pct
FROM (SELECT {_LAB3} AS segment, price FROM clean) x
WHERE segment IS NOT NULL GROUP BY segment""", "clean"))
def segment_cv(spark, sf):
    """Coefficient of variation (%) per segment."""
    s = S.segment_stats(C(spark, sf), with_median=False)
    return s.select("segment", r("cv_pct").alias("cv_pct"))


def _strategy_sql(strategies) -> str:
    labs = " UNION ALL ".join(
        f"SELECT '{name}' AS strategy, {sql_half_open(segs)} AS segment, price FROM clean"
        for name, segs in strategies.items())
    return with_views(f"""
SELECT strategy, segment, n, round(pct, 6) AS pct, round(mean, 2) AS mean_price, round(std, 2) AS std_price,
  round(cv_pct, 6) AS cv_pct, round(balance_score, 6) AS balance_score, round(weighted_cv, 6) AS weighted_cv,
  n_all
FROM (
  SELECT *, n * 100e0 / n_all AS pct,
    CAST(min(CASE WHEN segment IS NOT NULL THEN n END) OVER w AS DOUBLE)
      / max(CASE WHEN segment IS NOT NULL THEN n END) OVER w AS balance_score,
    sum(CASE WHEN segment IS NOT NULL THEN n * cv_pct END) OVER w / n_all AS weighted_cv
  FROM (
    SELECT *, 100e0 * std / mean AS cv_pct, CAST(sum(n) OVER (PARTITION BY strategy) AS BIGINT) AS n_all
    FROM (SELECT strategy, segment, count(*) AS n, avg(price) AS mean, stddev_samp(price) AS std
          FROM ({labs}) l GROUP BY strategy, segment) a
  ) b
  WINDOW w AS (PARTITION BY strategy)
) c WHERE segment IS NOT NULL""", "clean")


def _strategy_cols(d):
    return d.select("strategy", "segment", "n", r("pct").alias("pct"), r("mean", 2).alias("mean_price"),
                    r("std", 2).alias("std_price"), r("cv_pct").alias("cv_pct"),
                    r("balance_score").alias("balance_score"), r("weighted_cv").alias("weighted_cv"),
                    F.col("n_all").cast("bigint").alias("n_all"))


@register("segmentation_compare", _strategy_sql(S.STRATEGIES))
def segmentation_compare(spark, sf):
    """Both candidate segmentations side by side in one pass."""
    return _strategy_cols(S.strategy_stats(C(spark, sf)))


@register("segmentation_quality", _strategy_sql({"3_segments": DEFAULT_SEGMENTS}))
def segmentation_quality(spark, sf):
    """Balance score and weighted CV of the configured segmentation."""
    return _strategy_cols(S.strategy_stats(C(spark, sf), {"3_segments": DEFAULT_SEGMENTS}))
