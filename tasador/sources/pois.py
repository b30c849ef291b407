"""Points of interest and feature-importance test views (FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import spread, table

# The POI kinds counted per listing.
POI_KINDS = ["restaurant", "park", "subway_station"]


def pois(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pois``: one point of interest per customer row."""
    k = F.col("c_custkey")
    return spread(table(spark, sf_dir, "customer")).select(
        k.alias("poi_id"),
        F.when(k % 3 == 0, F.lit("restaurant")).when(k % 3 == 1, F.lit("park"))
         .otherwise(F.lit("subway_station")).alias("kind"),
        (F.lit(-34.7) + ((k * 6151) % 9973).cast("double") / F.lit(9.973e3) * F.lit(0.18)).alias("latitude"),
        (F.lit(-58.53) + ((k * 3079) % 9967).cast("double") / F.lit(9.967e3) * F.lit(0.2)).alias("longitude"),
    )


def importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``importances``: a feature-importance table, one row per part brand."""
    return (table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("feature"))
            .agg(F.sum("p_size").cast("double").alias("importance")))
