"""Lineage cutting and source spreading helpers."""
from pyspark.sql import functions as F

from tasador.session import checkpoint_dir, materialize
from tasador.sources.tables import spread


def test_materialize_keeps_rows_and_cuts_lineage(spark):
    df = spark.range(0, 1000).select((F.col("id") * 2).alias("x"))
    m = materialize(df)
    assert sorted(r["x"] for r in m.collect()) == [2 * i for i in range(1000)]
    if checkpoint_dir(spark):
        # A reliable checkpoint reads back from files, not from the range plan.
        assert "Range" not in m._jdf.queryExecution().optimizedPlan().toString()


def test_spread_only_when_underpartitioned(spark):
    one = spark.range(0, 100, numPartitions=1)
    assert spread(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 100, numPartitions=spark.sparkContext.defaultParallelism + 1)
    assert spread(many).rdd.getNumPartitions() == many.rdd.getNumPartitions()
