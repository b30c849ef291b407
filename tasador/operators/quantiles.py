"""Exact order statistics without funnelling a group through one task.

Spark's exact ``median``/``percentile`` aggregate keeps a value->count map
per group and merges all of it in the final task of the group, so a global
median (or a segment holding a third of the rows) lands in a single task.
Here the k-th smallest value of each group is found by histogram
refinement:

1. one aggregate gives ``count, min, max`` per group;
2. each pass buckets the rows inside the current ``[lo, hi]`` of every
   target into ``bins`` equal-width bins (``groupBy(target, bin)`` with
   partial aggregation), and the driver keeps only the bin that holds the
   wanted rank -- it sees at most ``targets x bins`` small rows;
3. when a target's range holds at most ``collect_limit`` rows, those rows
   are fetched and the exact value is picked.

Bucketing by ``floor((x - lo) / (hi - lo) * bins)`` is monotone in ``x``,
so every value below the kept bin is strictly smaller than the bin's
minimum: the rank bookkeeping is exact, not approximate. Each pass costs one
scan of the pruned value column; for uniform data the candidate set shrinks
by a factor of ``bins`` per pass (1e12 rows: four passes).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BINS = 1024
COLLECT_LIMIT = 4096
# Rank selection suits few, possibly huge groups (segments, columns): the
# driver tracks one small state per (group, rank). Beyond this many groups
# the groups are small on average and Spark's per-group ``median`` is used.
MAX_SELECT_GROUPS = 20_000


def _targets_df(spark, key_cols, key_types, state):
    fields = [T.StructField(k, t) for k, t in zip(key_cols, key_types)]
    fields += [T.StructField("_tid", T.LongType()), T.StructField("_lo", T.DoubleType()),
               T.StructField("_hi", T.DoubleType())]
    rows = [tuple(s["key"]) + (tid, s["lo"], s["hi"]) for tid, s in state.items()]
    return spark.createDataFrame(rows, T.StructType(fields))


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``left`` joined to the broadcast ``right`` on ``<=>`` of the keys, so a
    NULL group meets its own row; the keys of ``right`` are left out."""
    if not keys:
        return left.join(F.broadcast(right))
    renamed = right.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                           *[c for c in right.columns if c not in keys])
    on = None
    for i, k in enumerate(keys):
        c = left[k].eqNullSafe(F.col(f"_k{i}"))
        on = c if on is None else on & c
    return left.join(F.broadcast(renamed), on, how).drop(*[f"_k{i}" for i in range(len(keys))])


def _bin(x, lo, hi, bins: int):
    """Bin number, monotone in ``x`` and not the same for ``lo`` and ``hi``:
    infinite ends are bins of their own; halves keep the width finite; a width
    too small to divide by parts the smallest value from the others."""
    inf = float("inf")
    width = hi / 2 - lo / 2
    place = F.least(F.floor((x / 2 - lo / 2) / width * F.lit(float(bins))).cast("int"), F.lit(bins - 1))
    return (F.when((lo == -inf) | (hi == inf), F.when(x == -inf, F.lit(-1)).when(x == inf, F.lit(1)).otherwise(F.lit(0)))
            .when(width == 0, F.when(x > lo, F.lit(1)).otherwise(F.lit(0)))
            .otherwise(place))


def select_ranks(df: DataFrame, key_cols: Sequence[str], value_col: str,
                 targets: Sequence[tuple[tuple, int]], bins: int = BINS,
                 collect_limit: int = COLLECT_LIMIT, stats: dict | None = None) -> dict[int, float]:
    """Exact ``rank``-th smallest (0-based) non-NULL ``value_col`` within the
    group ``key`` for every ``(key, rank)`` target. Returns ``{target index:
    value}``; a target whose rank is outside its group is left out."""
    spark = df.sparkSession
    key_cols = list(key_cols)
    data = df.select(*key_cols, F.col(value_col).cast("double").alias("_x")).filter(F.col("_x").isNotNull() & ~F.isnan("_x"))
    key_types = [df.schema[k].dataType for k in key_cols]

    # Pass 0: group sizes and ranges (skipped when the caller has them).
    if stats is None and key_cols:
        stats = {tuple(r[:len(key_cols)]): (r["_n"], r["_lo"], r["_hi"]) for r in
                 data.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_lo"),
                                             F.max("_x").alias("_hi")).collect()}
    elif stats is None:
        r = data.agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi")).first()
        stats = {(): (r["_n"], r["_lo"], r["_hi"])}

    result: dict[int, float] = {}
    state: dict[int, dict] = {}
    for tid, (key, rank) in enumerate(targets):
        key = tuple(key)
        if key not in stats:
            continue
        n, lo, hi = stats[key]
        if rank < 0 or rank >= n:
            continue
        if lo == hi:
            result[tid] = lo
        else:
            state[tid] = {"key": key, "rank": rank, "n": n, "lo": lo, "hi": hi}

    while state:
        small = {t: s for t, s in state.items() if s["n"] <= collect_limit}
        if small:
            tdf = _targets_df(spark, key_cols, key_types, small)
            rows = (null_safe_join(data, tdf, key_cols)
                    .filter((F.col("_x") >= F.col("_lo")) & (F.col("_x") <= F.col("_hi")))
                    .groupBy("_tid").agg(F.sort_array(F.collect_list("_x")).alias("_xs")).collect())
            for r in rows:
                s = small[r["_tid"]]
                result[r["_tid"]] = r["_xs"][s["rank"]]
            for t in small:
                state.pop(t)
            continue
        tdf = _targets_df(spark, key_cols, key_types, state)
        b = _bin(F.col("_x"), F.col("_lo"), F.col("_hi"), bins)
        hist = (null_safe_join(data, tdf, key_cols)
                .filter((F.col("_x") >= F.col("_lo")) & (F.col("_x") <= F.col("_hi")))
                .groupBy("_tid", b.alias("_b"))
                .agg(F.count(F.lit(1)).alias("_c"), F.min("_x").alias("_mn"), F.max("_x").alias("_mx"))
                .collect())
        per: dict[int, list] = {}
        for r in hist:
            per.setdefault(r["_tid"], []).append((r["_b"], r["_c"], r["_mn"], r["_mx"]))
        for tid in list(state):
            s = state[tid]
            below, before = 0, (s["n"], s["lo"], s["hi"])
            for _, c, mn, mx in sorted(per.get(tid, [])):
                if s["rank"] < below + c:
                    s["rank"] -= below
                    s["n"], s["lo"], s["hi"] = c, mn, mx
                    break
                below += c
            if s["lo"] == s["hi"]:
                result[tid] = s["lo"]
                state.pop(tid)
            elif (s["n"], s["lo"], s["hi"]) == before:
                raise RuntimeError(f"rank selection made no progress for {s}")
    return result


def exact_medians(df: DataFrame, value_cols: Sequence[str], group_cols: Sequence[str] = (),
                  **kw) -> DataFrame:
    """Interpolating median (mean of the two middle values, NULLs skipped)
    of every ``value_col`` per group, as a long table
    ``(group..., column, median)``. Same value as pandas ``median`` and
    DuckDB ``median``; never a whole group in one task."""
    spark = df.sparkSession
    group_cols = list(group_cols)
    stacked = df.select(*group_cols, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.nanvl(F.col(c).cast("double"), F.lit(None)).alias("value")) for c in value_cols
    ])).alias("_kv")).select(*group_cols, "_kv.column", "_kv.value")
    keys = group_cols + ["column"]
    # One small row per (group, column): size and range, never values.
    sizing = stacked.groupBy(*keys).agg(F.count("value").alias("_n"), F.min("value").alias("_lo"),
                                        F.max("value").alias("_hi"))
    rows = sizing.limit(MAX_SELECT_GROUPS + 1).collect()
    if len(rows) > MAX_SELECT_GROUPS:
        return stacked.groupBy(*keys).agg(F.median("value").alias("median"))
    n_of = {tuple(r[k] for k in keys): r["_n"] for r in rows}
    stats = {tuple(r[k] for k in keys): (r["_n"], r["_lo"], r["_hi"]) for r in rows if r["_n"]}
    all_keys = list(n_of)
    targets = []
    for key in all_keys:
        n = n_of.get(key, 0)
        if n:
            targets.append((key, (n - 1) // 2))
            targets.append((key, n // 2))
    got = select_ranks(stacked, keys, "value", targets, stats=stats, **kw)
    out = []
    for i in range(0, len(targets), 2):
        key = targets[i][0]
        lo, hi = got[i], got[i + 1]
        out.append(tuple(key) + (lo if lo == hi else lo + (hi - lo) * 0.5,))
    for key in all_keys:
        if not n_of.get(key):
            out.append(tuple(key) + (None,))
    fields = [T.StructField(k, stacked.schema[k].dataType) for k in keys] + [
        T.StructField("median", T.DoubleType())]
    return spark.createDataFrame(out, T.StructType(fields))
