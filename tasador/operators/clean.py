"""Cleaning filters (F1-F4) and the load funnel.

All predicates are plain Catalyst expressions: F1 and F2 become parquet
``PushedFilters`` when the listings come straight from a file; F3 divides
with ``try_divide`` so a zero area yields NULL (dropped) instead of raising
under ANSI mode, matching pandas' ``inf`` that fails the range test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The cleaning thresholds of both training scripts.
CURRENCY = "USD"
PRICE_MIN, PRICE_MAX = 30_000.0, 600_000.0
PPSQM_MIN, PPSQM_MAX = 800.0, 5_000.0


def price_per_sqm(price: str = "price", area: str = "area") -> Column:
    return F.try_divide(F.col(price), F.col(area))


def usd_pred() -> Column:
    return F.col("currency") == F.lit(CURRENCY)


def price_pred() -> Column:
    return F.col("price").between(F.lit(PRICE_MIN), F.lit(PRICE_MAX))


def ppsqm_pred() -> Column:
    return price_per_sqm().between(F.lit(PPSQM_MIN), F.lit(PPSQM_MAX))


def filter_usd(df: DataFrame) -> DataFrame:
    return df.filter(usd_pred())


def filter_price(df: DataFrame) -> DataFrame:
    """Both ends inclusive; a NULL price is dropped."""
    return df.filter(price_pred())


def filter_ppsqm(df: DataFrame) -> DataFrame:
    """Price per m2 in [800, 5000]; zero or NULL area is dropped."""
    return df.filter(ppsqm_pred())


def clean_listings(df: DataFrame) -> DataFrame:
    """F1 and F2 and F3, the cleaning used by both trainers."""
    return df.transform(filter_usd).transform(filter_price).transform(filter_ppsqm)


def load_funnel(df: DataFrame) -> DataFrame:
    """Row counts after each cleaning step in a single pass.

    One aggregate with ``count_if`` per stage, so the source is scanned once
    and partial counts are combined map-side."""
    usd = usd_pred()
    usd_price = usd & price_pred()
    clean = usd_price & ppsqm_pred()
    return df.agg(
        F.count(F.lit(1)).alias("n_loaded"),
        F.count_if(usd).alias("n_usd"),
        F.count_if(usd_price).alias("n_price_ok"),
        F.count_if(clean).alias("n_clean"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
    )
