"""Helpers shared by the query plans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.listings import listings, nan_to_null
from ..operators.clean import clean_listings


def L(spark, sf_dir):
    """Listings view, NaN normalised to NULL at ingest."""
    return nan_to_null(listings(spark, sf_dir))


def C(spark, sf_dir):
    """Cleaned listings."""
    return clean_listings(L(spark, sf_dir))


def r(c, n: int = 6) -> Column:
    """Round for cross-engine comparison of floating results."""
    return F.round(F.col(c) if isinstance(c, str) else c, n)


def sr(expr: str, n: int = 6) -> str:
    return f"round({expr}, {n})"
