"""Training preparation: medians and imputation (A1, A2), the target
transform (P3), train/test splits (M1, M2) and standardisation (M3)."""

from __future__ import annotations

from collections.abc import Sequence

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_checked, materialize
from .quantiles import MAX_SELECT_GROUPS, exact_medians, null_safe_join, select_ranks


def medians_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A1: ``(feature, median)`` per column, exact, NULLs skipped."""
    return exact_medians(df, cols).withColumnRenamed("column", "feature")


def median_values(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    return {r["feature"]: r["median"] for r in medians_long(df, cols).collect()}


def impute_median(df: DataFrame, cols: Sequence[str], medians: dict | None = None) -> DataFrame:
    """A2: ``coalesce(x, median(x))`` with the medians as literals (a
    handful of scalars), so the fill is a projection -- no join, no
    broadcast of data. Filled columns become double, as in pandas."""
    med = medians if medians is not None else median_values(df, cols)
    out = []
    for c in df.columns:
        if c in cols:
            out.append(F.coalesce(F.col(c).cast("double"), F.lit(med[c]).cast("double")).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


# Fixed value: the random_state of both training scripts.
SEED = 42
TEST_FRACTION = 0.2


def split_hash(id_col: str = "listing_id", seed: int = SEED) -> Column:
    """Deterministic 32-bit hash in [0, 2^32): ``md5('<seed>:<id>')``."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string"))), 1, 8),
                  16, 10).cast("bigint")


def train_test_split(df: DataFrame, group_cols: Sequence[str] = (), id_col: str = "listing_id",
                     test_fraction: float = TEST_FRACTION, seed: int = SEED, exact: bool = True) -> DataFrame:
    """M1/M2: adds ``is_test``.

    ``exact=True``: per group exactly ``ceil(f * n)`` test rows -- the rows
    with the smallest ``(hash, id)``. The cut-off is found by distributed
    rank selection (histogram passes over the hash), not by a window that
    would sort each whole group in one task. Ties on the 32-bit hash at the
    cut-off are resolved by a second selection on the id.
    ``exact=False``: Bernoulli ``hash < f * 2^32`` -- one projection, no
    extra pass; the test size is f*n in expectation only."""
    h = split_hash(id_col, seed)
    if not exact:
        return df.withColumn("is_test", h < F.lit(int(test_fraction * 2 ** 32)))
    if not group_cols:
        # One implicit group: the per-group tables below then have one row.
        return (train_test_split(df.withColumn("_all", F.lit(0)), ["_all"], id_col, test_fraction, seed, exact)
                .drop("_all"))
    group_cols = list(group_cols)
    # Group, id and hash feed every selection pass: computed once.
    keyed = materialize(df.select(*group_cols, F.col(id_col), h.alias("_h")))
    rows = keyed.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_n"), F.min("_h").alias("_lo"),
                                          F.max("_h").alias("_hi")).limit(MAX_SELECT_GROUPS + 1).collect()
    if len(rows) > MAX_SELECT_GROUPS:
        # Many small groups: a per-group window is cheap and the cut-off
        # tables would no longer be small enough to broadcast.
        w = Window.partitionBy(*group_cols).orderBy("_h", id_col)
        ranked = df.withColumn("_h", h).select(
            "*", F.row_number().over(w).alias("_rn"), F.count(F.lit(1)).over(Window.partitionBy(*group_cols))
            .alias("_gn"))
        return ranked.withColumn("is_test", F.col("_rn") <= F.ceil(F.lit(test_fraction) * F.col("_gn"))) \
            .drop("_h", "_rn", "_gn")
    sizes = {tuple(r[:len(group_cols)]): r["_n"] for r in rows}
    hstats = {tuple(r[:len(group_cols)]): (r["_n"], float(r["_lo"]), float(r["_hi"])) for r in rows}
    # Same float arithmetic as the reference split: ceil(fraction * n) test rows.
    targets = [(k, math.ceil(test_fraction * n) - 1) for k, n in sizes.items()]
    targets = [(k, m) for k, m in targets if m >= 0]
    cut = select_ranks(keyed, group_cols, "_h", targets, stats=hstats)
    thresholds = {targets[i][0]: int(v) for i, v in cut.items()}
    # Rows strictly below the cut-off hash, and how many ties sit on it.
    spark = df.sparkSession
    key_rows = [tuple(k) + (t, m + 1) for (k, m), t in ((tg, thresholds[tg[0]]) for tg in targets)]
    schema = ", ".join([f"`{g}` {df.schema[g].dataType.simpleString()}" for g in group_cols] +
                       ["_t bigint", "_m bigint"])
    j = null_safe_join(keyed, spark.createDataFrame(key_rows, schema), group_cols)
    counts = {tuple(r[:len(group_cols)]): (r["_lt"], r["_eq"]) for r in
              j.groupBy(*group_cols).agg(F.count_if(F.col("_h") < F.col("_t")).alias("_lt"),
                                         F.count_if(F.col("_h") == F.col("_t")).alias("_eq")).collect()}
    id_cut = {}
    tie_targets = []
    for (k, m) in targets:
        lt, eq = counts[tuple(k)]
        need = m + 1 - lt
        if need < eq:
            tie_targets.append((k, need - 1))
    if tie_targets:
        ties = j.filter(F.col("_h") == F.col("_t"))
        got = select_ranks(ties, group_cols, id_col, tie_targets)
        id_cut = {tie_targets[i][0]: v for i, v in got.items()}
    rows = [tuple(k) + (thresholds[k], id_cut.get(k)) for k, _ in targets]
    schema = ", ".join([f"`{g}` {df.schema[g].dataType.simpleString()}" for g in group_cols] +
                       ["_t bigint", "_idcut double"])
    cuts = spark.createDataFrame(rows, schema)
    base = df.withColumn("_h", h)
    j2 = null_safe_join(base, cuts, group_cols, "left")
    is_test = ((F.col("_h") < F.col("_t"))
               | ((F.col("_h") == F.col("_t"))
                  & (F.col("_idcut").isNull() | (F.col(id_col).cast("double") <= F.col("_idcut")))))
    return j2.withColumn("is_test", F.coalesce(is_test, F.lit(False))).drop("_h", "_t", "_idcut")


def standardize(df: DataFrame, cols: Sequence[str], fit_filter: Column | None = None,
                group_cols: Sequence[str] = (), suffix: str = "") -> DataFrame:
    """M3: ``(x - mean) / std`` with **population** std computed on the
    fitting rows (train split) only, per group; a zero std divides by 1.
    The statistics are one grouped aggregate (a row per group) joined back."""
    group_cols = list(group_cols)
    if not group_cols:
        return standardize(df.withColumn("_all", F.lit(0)), cols, fit_filter, ["_all"], suffix).drop("_all")
    fit = df.filter(fit_filter) if fit_filter is not None else df
    stats = fit.groupBy(*group_cols).agg(*[F.avg(c).alias(f"_mu_{c}") for c in cols],
                                         *[F.stddev_pop(c).alias(f"_sd_{c}") for c in cols])
    # One row per group: no row of df is shuffled on a hot group.
    j = df.join(broadcast_checked(stats), group_cols, "left")
    out = [F.col(c) for c in df.columns if c not in cols or suffix]
    for c in cols:
        sd = F.col(f"_sd_{c}")
        scale = F.when(sd.isNull() | (sd == 0), F.lit(1.0)).otherwise(sd)
        out.append(((F.col(c) - F.col(f"_mu_{c}")) / scale).alias(c + suffix))
    return j.select(*out)

