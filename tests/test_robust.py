"""Cases that the fixtures never hold: null groups, infinities, odd casts, reordered headers, missing bundles."""

import math
import statistics

import pytest
from pyspark.sql import functions as F

from tasador.operators.boosting import Forest, Tree
from tasador.operators.ensemble import Bundle
from tasador.operators.prep import train_test_split
from tasador.operators.quantiles import exact_medians
from tasador.operators.score import predict
from tasador.operators.validate import validate
from tasador.sources.listings import read_listings_csv
from tasador.sources.quarantine import quarantine
from tasador.sources.requests import parse_requests


def test_medians_with_null_group_and_infinities(spark):
    inf = math.inf
    rows = [(None if i % 3 == 0 else "a", float(i % 977)) for i in range(15000)]
    rows += [("a", inf), ("a", -inf), ("a", float("nan")), ("b", inf), ("b", inf), ("b", 1.0), ("c", None), ("d", 1e308), ("d", -1e308), ("d", 5e-324)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: r["median"] for r in exact_medians(df, ["x"], ["g"], collect_limit=10).collect()}
    for g in (None, "a"):
        assert got[g] == statistics.median([x for k, x in rows if k == g and x == x])
    assert got["b"] == inf and got["c"] is None and got["d"] == 5e-324


def test_split_with_null_group(spark):
    df = spark.range(1000).select(F.col("id").alias("listing_id"), F.when(F.col("id") % 4 == 0, None).otherwise("g").alias("segment"))
    out = train_test_split(df, ["segment"]).groupBy("segment").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()
    assert {(r.segment, r.n, r.t) for r in out} == {(None, 250, 50), ("g", 750, 150)}


@pytest.mark.parametrize("field,value,status", [
    ("area", '"80d"', 400), ("area", '"1_000"', 200), ("area", '"1__0"', 400), ("area", '" nan "', 200), ("area", '"infinity"', 200), ("area", '"0x10"', 400),
    ("area", '".5e1_0"', 200), ("bedrooms", "1e400", 500), ("bedrooms", '"2_0"', 200), ("bedrooms", '"2.0"', 400), ("bedrooms", "2.7", 200), ("bedrooms", "null", 500),
])
def test_casts_as_python_makes_them(spark, field, value, status):
    fields = {"area": "80.5", "bedrooms": "2", "bathrooms": "1.0", "latitude": "-34.6", "longitude": "-58.4"} | {field: value}
    payload = "{" + ", ".join(f'"{k}": {v}' for k, v in fields.items()) + "}"
    df = spark.createDataFrame([(1, payload)], "request_id long, payload string")
    r = validate(parse_requests(df, keep_variant=True)).first()
    assert r.status_code == status
    if value in ('"1_000"', '"2_0"'):
        assert r[field] == float(value.strip('"').replace("_", ""))
    if "nan" in value:
        assert r[field] is None


def test_csv_by_header_name(spark, tmp_path):
    (tmp_path / "l.csv").write_text("area,extra,price,note,currency\n50,1.5,100000,x,USD\n70,NA,200000,,USD\n")
    df = read_listings_csv(spark, str(tmp_path / "l.csv"))
    rows = df.orderBy("price").collect()
    assert [(r.price, r.area, r.extra, r.note, r.currency, r.bedrooms) for r in rows] == [(100000.0, 50.0, 1.5, "x", "USD", None), (200000.0, 70.0, None, None, "USD", None)]
    assert dict(df.dtypes)["extra"] == "double" and dict(df.dtypes)["note"] == "string"


def test_quarantine_reads_the_whole_text(spark):
    texts = ["a,b,1,2\nc,d,3,4\n", " " * 600 + "<html>,,,", "a,b,1,2\n<html>Request Rejected</html>", "\n﻿ <html>", "a,b,1,2\nc,d", "", None, "a,b,c\n"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.quarantine_reason for r in quarantine(df, "t", 4).orderBy("i").collect()]
    m = "markup, not delimited text"
    assert got == [None, m, m, m, "unexpected field count", "empty", "empty", "unexpected field count"]


def test_rows_without_a_bundle_stay(spark):
    bundle = Bundle(["request_id"], {}, {}, 0.5, [[2.0]], 0.5, Forest([], []), Forest([[Tree(value=[1.0])]], []))
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "request_id long, segment string")
    got = {r.request_id: r.prediction for r in predict(df, {"a": bundle}).collect()}
    assert got[1] == pytest.approx(math.e - 1) and got[2] is None and got[3] is None
