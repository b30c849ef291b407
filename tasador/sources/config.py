"""Segment configuration source (S3): a JSON document with a ``segments``
array, read by Spark and exploded into one row per segment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.segments import Segment


def read_segment_config(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("multiLine", "true").json(path)
    return (raw.select(F.posexplode("segments").alias("ord", "s"))
            .select(F.col("ord").cast("int").alias("ord"), F.col("s.name").alias("name"),
                    F.col("s.price_min").cast("double").alias("price_min"),
                    F.col("s.price_max").cast("double").alias("price_max"),
                    F.col("s.description").alias("description")))


def segments_from_config(df: DataFrame) -> tuple[Segment, ...]:
    """The few configured segments as values for expression building."""
    return tuple(Segment(r["name"], r["price_min"], r["price_max"], r["description"] or "")
                 for r in df.orderBy("ord").collect())
