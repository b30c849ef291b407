"""Listings source.

Two entry points with one output schema:

* :func:`read_listings_csv` reads a listings CSV the way a user of the
  original scripts would have it: columns by header name, pandas-style
  NA tokens mapped to NULL, NaN mapped to NULL.
* :func:`listings` derives the test view from ``orders x customer x nation``
  (FIXTURES.md). It is a pure projection of the orders table plus two
  dimension lookups, so it scales linearly with ``orders``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import spread, table

LISTINGS_SCHEMA = T.StructType([
    T.StructField("listing_id", T.LongType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("area", T.DoubleType()),
    T.StructField("bedrooms", T.LongType()),
    T.StructField("bathrooms", T.DoubleType()),
    T.StructField("balcony_count", T.LongType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("property_type", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("neighborhood_tier", T.StringType()),
])

# The strings pandas' read_csv treats as missing by default.
PANDAS_NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                    "nan", "null"]


def nan_to_null(df: DataFrame) -> DataFrame:
    """pandas skips NaN in every aggregate; Spark orders NaN above every
    number and propagates it through avg/stddev. Normalising at ingest makes
    every later rule agree with the reference."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.when(F.isnan(f.name), F.lit(None)).otherwise(F.col(f.name))
                        .cast(f.dataType).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def read_listings_csv(spark: SparkSession, path: str, schema: T.StructType = LISTINGS_SCHEMA) -> DataFrame:
    """CSV scan by the names in the header line, whatever their order.

    Fields are read as strings, NA tokens become NULL, then ``try_cast``
    gives each column of ``schema`` its type; a value that does not parse
    becomes NULL instead of failing the job, a column that the file lacks is
    all NULL. Further columns follow in the file's order, as double where all
    their values are numbers (one aggregate over them), else as strings."""
    raw = (spark.read.option("header", "true").option("mode", "PERMISSIVE")
           .option("nullValue", "").option("emptyValue", "")
           .csv(path))
    na = F.array(*[F.lit(t) for t in PANDAS_NA_TOKENS])

    def text(name: str) -> Column:
        s = F.trim(F.col(f"`{name}`"))
        return F.when(F.array_contains(na, s), F.lit(None)).otherwise(s)

    known = {f.name for f in schema.fields}
    extra = [c for c in raw.columns if c not in known]
    cols = [(text(f.name) if f.name in raw.columns else F.lit(None)).try_cast(f.dataType).alias(f.name)
            for f in schema.fields]
    if extra:
        odd = raw.agg(*[F.count_if(text(c).isNotNull() & text(c).try_cast("double").isNull()).alias(c) for c in extra]).first()
        cols += [(text(c).try_cast("double") if odd[c] == 0 else text(c)).alias(c) for c in extra]
    return nan_to_null(raw.select(*cols))


def _price(k: Column, totalprice: Column) -> Column:
    return (F.when(k % 500 == 1, F.lit(3e4)).when(k % 500 == 2, F.lit(1.2e5))
            .when(k % 500 == 3, F.lit(3e5)).when(k % 500 == 4, F.lit(6e5))
            .otherwise(totalprice * F.lit(1.25)))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``listings`` view of FIXTURES.md, built with the DataFrame API.

    ``nation`` has 25 rows by construction, so it is broadcast; ``customer``
    is left to Catalyst/AQE, which broadcasts it only when its measured size
    is under ``spark.sql.autoBroadcastJoinThreshold`` and sort-merge joins
    otherwise."""
    o = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    j = (o.join(c, o.o_custkey == c.c_custkey)
          .join(F.broadcast(n), F.col("c_nationkey") == n.n_nationkey))
    k = F.col("o_orderkey")
    price = _price(k, F.col("o_totalprice"))
    divisor = (F.lit(600) + (F.col("o_custkey") * 7919 + k * 31) % 4601).cast("double")
    return j.select(
        k.alias("listing_id"),
        price.alias("price"),
        F.when(k % 20 == 0, F.lit("ARS")).otherwise(F.lit("USD")).alias("currency"),
        F.when(k % 97 == 0, F.lit(None).cast("double"))
         .when(k % 193 == 0, F.lit(0.0))
         .otherwise(price / divisor).alias("area"),
        F.when(k % 41 == 0, F.lit(None).cast("bigint"))
         .otherwise((F.lit(1) + k % 5).cast("bigint")).alias("bedrooms"),
        (F.lit(1.0) + F.lit(0.5) * (F.col("o_custkey") % 5).cast("double")).alias("bathrooms"),
        (k % 3).cast("bigint").alias("balcony_count"),
        F.when(k % 211 == 0, F.lit(None).cast("double"))
         .otherwise(F.lit(-34.7) + ((k * 7919) % 10007).cast("double") / F.lit(1.0007e4) * F.lit(0.18))
         .alias("latitude"),
        F.when(k % 211 == 0, F.lit(None).cast("double"))
         .otherwise(F.lit(-58.53) + ((k * 104729) % 10009).cast("double") / F.lit(1.0009e4) * F.lit(0.2))
         .alias("longitude"),
        F.when(k % 10 < 7, F.lit("Departamento")).when(k % 10 < 9, F.lit("casa"))
         .otherwise(F.lit("PH")).alias("property_type"),
        F.col("n_name").alias("location"),
        F.when(F.col("n_regionkey") == 0, F.lit("premium"))
         .when(F.col("n_regionkey") < 3, F.lit("mid"))
         .otherwise(F.lit("standard")).alias("neighborhood_tier"),
    )
