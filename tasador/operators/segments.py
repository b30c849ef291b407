"""Segment assignment and segmentation analysis.

Every aggregate here is algebraic (count, sum, avg, stddev) and therefore
partial/final: no segment, however large, is gathered into one task. The
only exact median goes through the distributed rank selection in
``quantiles``. Per-segment results are a handful of rows; the strategy-level
ratios are computed over that small result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.segments import DEFAULT_SEGMENTS, Segment, price_range_api, segment_expr, segments_df
from ..session import materialize
from .quantiles import exact_medians

# ---------------------------------------------------------------------------
# The two strategies compared by the segmentation analysis --
# two segments split at 150,000 and the three configured segments.
# ---------------------------------------------------------------------------
STRATEGIES: dict[str, tuple[Segment, ...]] = {
    "2_segments": (Segment("low", 30000, 150000), Segment("high", 150000, 600000)),
    "3_segments": DEFAULT_SEGMENTS,
}
# ---------------------------------------------------------------------------


def half_open_expr(price: Column, segments) -> Column:
    """Strict half-open membership ``min <= price < max`` (the analysis
    reports count this way: a price equal to the top bound is outside)."""
    e = None
    for s in segments:
        c = (price >= F.lit(float(s.price_min))) & (price < F.lit(float(s.price_max)))
        e = F.when(c, F.lit(s.name)) if e is None else e.when(c, F.lit(s.name))
    return e


def assign_segment(df: DataFrame, segments=DEFAULT_SEGMENTS, price: str = "price") -> DataFrame:
    """P5 as one CASE expression (no join, no UDF)."""
    return df.withColumn("segment", segment_expr(price, segments))


def assign_segment_join(df: DataFrame, segments=DEFAULT_SEGMENTS, price: str = "price") -> DataFrame:
    """P5 as a range join against the segment table.

    The segment table is bounded by the configuration (a few rows), so it
    is broadcast; the join is a broadcast nested loop with a range
    condition -- O(rows x segments) with no shuffle of the listings. The
    configured ranges are checked to be disjoint, so at most one matches."""
    ordered = sorted(segments, key=lambda s: s.price_min)
    for a, b in zip(ordered, ordered[1:]):
        if a.price_max > b.price_min:
            raise ValueError("segment ranges overlap")
    seg = segments_df(df.sparkSession, segments).withColumn(
        "_last", F.col("ord") == F.lit(len(segments) - 1))
    p = F.col(price)
    cond = (((p >= F.col("price_min")) & (p < F.col("price_max")))
            | ((p == F.col("price_max")) & F.col("_last")))
    return (df.join(F.broadcast(seg), cond, "left")
            .drop("ord", "price_min", "price_max", "description", "_last")
            .withColumnRenamed("name", "segment"))


def segment_distribution(df: DataFrame, segments=DEFAULT_SEGMENTS) -> DataFrame:
    """A10: count and share per configured segment (zero-count segments
    kept), with the ``$min-$max`` label. Shares are over all input rows."""
    counts = assign_segment(df, segments).groupBy("segment").agg(F.count(F.lit(1)).alias("n"))
    # ``counts`` has at most len(segments) + 1 rows; windows over it are free.
    counts = counts.select("*", F.sum("n").over(Window.partitionBy()).alias("total"))
    seg = segments_df(df.sparkSession, segments)
    j = seg.join(counts, seg.name == counts.segment, "left")
    n = F.coalesce(F.col("n"), F.lit(0)).cast("bigint")
    total = F.max("total").over(Window.partitionBy())
    return j.select(F.col("name").alias("segment"), "ord", n.alias("n"),
                    (n * F.lit(100.0) / total).alias("pct"),
                    price_range_api(F.col("price_min"), F.col("price_max")).alias("price_range"))


def segment_stats(df: DataFrame, segments=DEFAULT_SEGMENTS, price: str = "price",
                  with_median: bool = True) -> DataFrame:
    """N, share of all rows, mean, median, sample std and CV (%) of
    price per segment, with half-open membership as in the analysis
    reports. Shares are over *all* input rows, including rows outside every
    segment."""
    # Two narrow columns feed the count, the moments and the median passes.
    labelled = materialize(df.select(half_open_expr(F.col(price), segments).alias("segment"),
                                     F.col(price).alias("_p")))
    total = labelled.count()
    g = (labelled.filter(F.col("segment").isNotNull()).groupBy("segment")
         .agg(F.count(F.lit(1)).alias("n"), F.avg("_p").alias("mean"), F.stddev_samp("_p").alias("std")))
    if with_median:
        med = exact_medians(labelled.filter(F.col("segment").isNotNull()), ["_p"], ["segment"]) \
            .select("segment", "median")
        g = g.join(med, "segment", "left")
    return g.select("*", (F.col("n") * F.lit(100.0) / F.lit(float(total))).alias("pct"),
                    (F.lit(100.0) * F.col("std") / F.col("mean")).alias("cv_pct"),
                    F.lit(total).cast("bigint").alias("n_all"))


def strategy_stats(df: DataFrame, strategies: dict = STRATEGIES, price: str = "price") -> DataFrame:
    """A13/A14 for several candidate segmentations in one pass.

    Each row is labelled under every strategy with an ``explode`` of
    per-strategy CASE expressions (a generator inside the scan stage, not a
    join), then one grouped aggregate by ``(strategy, segment)``. Strategy
    ratios -- balance ``min n / max n`` and weighted CV ``sum(n cv) / N`` --
    are computed over the few result rows."""
    p = F.col(price)
    lab = F.explode(F.array(*[F.struct(F.lit(name).alias("strategy"), half_open_expr(p, segs).alias("segment"))
                              for name, segs in strategies.items()]))
    base = df.select(p.alias("_p"), lab.alias("_l")).select("_p", "_l.strategy", "_l.segment")
    g = (base.groupBy("strategy", "segment")
         .agg(F.count(F.lit(1)).alias("n"), F.avg("_p").alias("mean"), F.stddev_samp("_p").alias("std")))
    w = Window.partitionBy("strategy")
    cv = F.lit(100.0) * F.col("std") / F.col("mean")
    seg = F.col("segment").isNotNull()
    g = g.select("*", cv.alias("cv_pct"), F.sum("n").over(w).alias("n_all"))
    return (g.select("*",
                     (F.col("n") * F.lit(100.0) / F.col("n_all")).alias("pct"),
                     (F.min(F.when(seg, F.col("n"))).over(w) / F.max(F.when(seg, F.col("n"))).over(w))
                     .alias("balance_score"),
                     (F.sum(F.when(seg, F.col("n") * F.col("cv_pct"))).over(w) / F.col("n_all"))
                     .alias("weighted_cv"))
            .filter(seg))
