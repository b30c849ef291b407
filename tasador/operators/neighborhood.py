"""Neighbourhood statistics over the radius join.

Per target: rows of the reference within ``r`` km (no self-exclusion, the
reference side is the raw, unfiltered listings), mean and sample std of
``area`` over them, and the density ``count / (pi r^2)``. Targets with no
neighbour take the reference-wide fallback (A8): median area, std of area,
``rows / 1000``.

The variance is accumulated as shifted sums ``sum(x-K), sum((x-K)^2)`` with
``K`` the reference mean, which keeps the one-pass formula accurate and the
sums additive, so copies at one coordinate pre-aggregate into one row.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_checked, materialize, stored
from .quantiles import exact_medians
from .radius import HOT_CELL_POINTS, radius_point_aggregate, radius_row_sums

# Neighbourhood radius (km) and the empty-neighbourhood density divisor.
RADIUS_KM = 2.0
FALLBACK_DENSITY_DIVISOR = 1000.0
CARRIED = 4  # columns that rows take with them to the join of the tiles; wider rows are joined to their points' sums


def reference_summary(reference: DataFrame, measure: str = "area") -> dict:
    """Reference-wide scalars: row count, mean / sample std / exact median of
    the measure. One aggregate plus the distributed median."""
    r = reference.agg(F.count(F.lit(1)).alias("n"), F.avg(measure).alias("mean"),
                      F.stddev_samp(measure).alias("std")).first()
    med = exact_medians(reference, [measure]).first()["median"]
    return {"n": r["n"], "mean": r["mean"], "std": r["std"], "median": med}


def reference_points(reference: DataFrame, shift: float, measure: str = "area") -> DataFrame:
    """The rows' coordinates and additive columns; the radius join adds up copies before it shuffles."""
    x = F.col(measure) - F.lit(shift)
    return reference.select(F.col("latitude").alias("r_lat"), F.col("longitude").alias("r_lon"), F.lit(1).alias("n_rows"),
                            F.col(measure).isNotNull().cast("int").alias("n_meas"), x.alias("s1"), (x * x).alias("s2"))


def target_points(targets: DataFrame) -> DataFrame:
    return targets.select(F.col("latitude").alias("t_lat"), F.col("longitude").alias("t_lon"))


def radius_stats(targets: DataFrame, reference: DataFrame, id_col: str = "listing_id",
                 radius_km: float = RADIUS_KM, measure: str = "area", fallback: bool = True,
                 summary: dict | None = None, hot_cell_points: int = HOT_CELL_POINTS,
                 keep: list[str] | None = None) -> DataFrame:
    """``targets`` (with ``latitude, longitude``) -> ``id_col, n_nearby,
    neighborhood_area_mean, neighborhood_area_std, local_property_density``.

    ``fallback=False`` leaves the no-neighbour rows as ``n_nearby = 0`` with
    NULL statistics (A5-A7); ``fallback=True`` applies A8."""
    # The reference feeds several passes (summary, median refinement, tile
    # widths, hot tiles, the join): read it once, keep three columns.
    ref = stored(reference.select("latitude", "longitude", measure), "reference")
    summary = summary or reference_summary(ref, measure)
    shift = summary["mean"] if summary["mean"] is not None else 0.0
    points, sums = reference_points(ref, shift, measure), ["n_rows", "n_meas", "s1", "s2"]
    keep = keep or []
    t = targets.select(id_col, *keep, F.col("latitude").alias("t_lat"), F.col("longitude").alias("t_lon"))
    if len(keep) <= CARRIED:
        j = radius_row_sums(stored(t, "targets"), points, radius_km, sums, [id_col, *keep], hot_cell_points=hot_cell_points)
    else:
        j = t.join(radius_point_aggregate(target_points(targets), points, radius_km, sums, hot_cell_points=hot_cell_points), ["t_lat", "t_lon"], "left")
    n = F.coalesce(F.col("n_rows"), F.lit(0)).cast("bigint")
    m = F.coalesce(F.col("n_meas"), F.lit(0))
    mean = F.when(m > 0, F.lit(shift) + F.col("s1") / m)
    var = F.when(m > 1, F.greatest(F.lit(0.0), (F.col("s2") - F.col("s1") * F.col("s1") / m) / (m - 1)))
    std = F.when(n > 1, F.sqrt(var)).when(n == 1, F.lit(0.0))
    dens = n.cast("double") / F.lit(math.pi * radius_km ** 2)
    if fallback:
        mean = F.when(n == 0, F.lit(summary["median"]).cast("double")).otherwise(mean)
        std = F.when(n == 0, F.lit(summary["std"]).cast("double")).otherwise(std)
        dens = F.when(n == 0, F.lit(summary["n"] / FALLBACK_DENSITY_DIVISOR)).otherwise(dens)
    return j.select(id_col, *keep, n.alias("n_nearby"), mean.alias("neighborhood_area_mean"),
                    std.alias("neighborhood_area_std"), dens.alias("local_property_density"))


def area_vs_neighborhood(area: str = "area", nb_mean: str = "neighborhood_area_mean"):
    """``area / nb_mean`` when ``nb_mean > 0``, else 1.0 (P13). A NULL mean
    (pandas NaN: NaN > 0 is False) also gives 1.0."""
    return F.when(F.col(nb_mean) > 0, F.col(area) / F.col(nb_mean)).otherwise(F.lit(1.0))


def poi_counts(targets: DataFrame, pois: DataFrame, kinds: list[str], id_col: str = "listing_id",
               radius_km: float = 1.0, hot_cell_points: int = HOT_CELL_POINTS) -> DataFrame:
    """Number of points of interest of each kind within ``radius_km`` (J8):
    columns ``<kind>s_nearby``. Kinds are a caller-given list, so the pivot
    is a fixed set of conditional sums (no extra pass to discover values)."""
    ref = materialize(pois.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
                      .groupBy(F.col("latitude").alias("r_lat"), F.col("longitude").alias("r_lon"))
                      .agg(*[F.count_if(F.col("kind") == F.lit(k)).alias(f"{k}s_nearby") for k in kinds]))
    sums = [f"{k}s_nearby" for k in kinds]
    t = stored(targets.select(id_col, F.col("latitude").alias("t_lat"), F.col("longitude").alias("t_lon")), "targets")
    return (radius_row_sums(t, ref, radius_km, sums, [id_col], hot_cell_points=hot_cell_points)
            .select(id_col, *[F.coalesce(F.col(s), F.lit(0)).cast("bigint").alias(s) for s in sums]))


def loo_means(df: DataFrame, cols: list[str], by: str = "location", id_col: str = "listing_id",
              suffix: str = "_loo_mean", keep: list[str] | None = None) -> DataFrame:
    """Leave-one-out group means (A9): ``(sum_g(x) - x) / (count_g(x) - 1)``;
    NULL when the row's own value is NULL or the group has no other value.
    The columns of ``keep`` stay.

    Written as a grouped aggregate joined back on the key, not a window: the
    aggregate is partial/final with O(1) state, so a group holding a third
    of all rows never sits in one task; the join back broadcasts the table
    of groups if its counted size allows."""
    g = df.groupBy(by).agg(*[F.sum(c).alias(f"_s_{c}") for c in cols],
                           *[F.count(c).alias(f"_n_{c}") for c in cols],
                           *[F.avg(c).alias(f"_m_{c}") for c in cols])
    keep = [c for c in keep or [] if c not in (id_col, by)]
    j = df.select(*dict.fromkeys([id_col, by, *keep, *cols])).join(broadcast_checked(g), by, "left")
    out = [F.col(c) for c in (id_col, by, *keep)]
    for c in cols:
        x, s, n = F.col(c), F.col(f"_s_{c}"), F.col(f"_n_{c}")
        out.append(F.col(f"_m_{c}").alias(f"neighborhood_{c}_mean"))
        out.append(F.when(x.isNotNull() & (n > 1), (s - x) / (n - 1)).alias(f"neighborhood_{c}{suffix}"))
    return j.select(*out)


def loo_means_radius(df: DataFrame, cols: list[str], radius_km: float = RADIUS_KM, id_col: str = "listing_id",
                     suffix: str = "_radius_mean") -> DataFrame:
    """Means over the *other* rows within ``radius_km`` (A9 by radius): the
    radius sums and counts less the row's own value. NULL where no other row
    there has a value, and for rows without coordinates."""
    sums = [f"_{k}_{c}" for c in cols for k in ("s", "n")]
    # Reference, targets and the rows joined back are the same table: read once.
    df = stored(df.select(*dict.fromkeys([id_col, "latitude", "longitude", *cols])), "rows")
    ref = df.select(F.col("latitude").alias("r_lat"), F.col("longitude").alias("r_lon"),
                    *[x.alias(f"_{k}_{c}") for c in cols for k, x in (("s", F.col(c)), ("n", F.col(c).isNotNull().cast("int")))])
    t = df.select(id_col, F.col("latitude").alias("t_lat"), F.col("longitude").alias("t_lon"), *cols)
    j = radius_row_sums(t, ref, radius_km, sums, [*dict.fromkeys([id_col, *cols])])
    out = [F.col(id_col)]
    for c in cols:
        x, s, n = F.col(c), F.col(f"_s_{c}"), F.col(f"_n_{c}") - F.col(c).isNotNull().cast("int")
        out.append(F.when(n > 0, (s - F.coalesce(x, F.lit(0))) / n).alias(f"{c}{suffix}"))
    return j.select(*out)
