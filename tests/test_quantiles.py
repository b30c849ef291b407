"""Distributed exact medians and the exact split."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tasador.operators.prep import train_test_split
from tasador.operators.quantiles import exact_medians


def test_exact_medians_many_passes(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        g = "hot" if i % 3 else "cold"
        v = rnd.lognormvariate(0, 2) if i % 5 else 1.0  # heavy duplicates at 1.0
        rows.append((g, v, None if i % 11 == 0 else float(i % 17)))
    df = spark.createDataFrame(rows, "g string, x double, y double")
    got = {(r["g"], r["column"]): r["median"] for r in
           exact_medians(df, ["x", "y"], ["g"], bins=4, collect_limit=8).collect()}
    for g in ("hot", "cold"):
        for c, idx in (("x", 1), ("y", 2)):
            vals = [r[idx] for r in rows if r[0] == g and r[idx] is not None]
            assert got[(g, c)] == pytest.approx(float(np.median(vals)), rel=1e-12)


def test_all_null_column_has_null_median(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    got = {r["column"]: r["median"] for r in exact_medians(df, ["a", "b"]).collect()}
    assert got == {"a": 1.5, "b": None}


def test_exact_split_sizes(spark):
    df = spark.range(0, 1003).select(F.col("id").alias("listing_id"), (F.col("id") % 3).alias("g"))
    s = train_test_split(df, ["g"])
    counts = {r["g"]: (r["n"], r["t"]) for r in
              s.groupBy("g").agg(F.count("*").alias("n"), F.sum(F.col("is_test").cast("int")).alias("t")).collect()}
    for n, t in counts.values():
        assert t == math.ceil(0.2 * n)
    # Deterministic.
    a = sorted(r["listing_id"] for r in s.filter("is_test").collect())
    b = sorted(r["listing_id"] for r in train_test_split(df, ["g"]).filter("is_test").collect())
    assert a == b


def test_many_groups_fallbacks(spark, monkeypatch):
    from tasador.operators import prep, quantiles
    monkeypatch.setattr(quantiles, "MAX_SELECT_GROUPS", 1)
    monkeypatch.setattr(prep, "MAX_SELECT_GROUPS", 1)
    df = spark.range(0, 501).select(F.col("id").alias("listing_id"), (F.col("id") % 4).alias("g"),
                                    (F.col("id") * 1.5).alias("x"))
    med = {r["g"]: r["median"] for r in exact_medians(df, ["x"], ["g"]).collect()}
    for g in range(4):
        vals = [i * 1.5 for i in range(501) if i % 4 == g]
        assert med[g] == pytest.approx(float(np.median(vals)))
    s = train_test_split(df, ["g"])
    for r in s.groupBy("g").agg(F.count("*").alias("n"), F.sum(F.col("is_test").cast("int")).alias("t")).collect():
        assert r["t"] == math.ceil(0.2 * r["n"])
