"""CSV listings scan, segment configuration source, quarantine, schema-driven features."""
import json
import os
import tempfile

from pyspark.sql import functions as F

from tasador.operators.features import feature_columns
from tasador.sources.config import read_segment_config, segments_from_config
from tasador.sources.listings import LISTINGS_SCHEMA, read_listings_csv
from tasador.sources.quarantine import quarantine


def test_csv_na_tokens_and_bad_values(spark):
    d = tempfile.mkdtemp(prefix="tasador-csv-", dir="/tmp")
    p = os.path.join(d, "listings.csv")
    with open(p, "w") as f:
        f.write(",".join(x.name for x in LISTINGS_SCHEMA.fields) + "\n")
        f.write("1,100000,USD,NaN,2,1.5,0,-34.6,-58.4,casa,X,mid\n")
        f.write("2,N/A,USD,50,NULL,1,1,-34.6,-58.4,casa,X,mid\n")
        f.write("3,abc,USD,50,3,1,1,,-58.4,casa,X,mid\n")
    rows = {r["listing_id"]: r for r in read_listings_csv(spark, p).collect()}
    assert rows[1]["area"] is None and rows[1]["price"] == 100000.0
    assert rows[2]["price"] is None and rows[2]["bedrooms"] is None
    assert rows[3]["price"] is None and rows[3]["latitude"] is None


def test_segment_config_reader(spark):
    d = tempfile.mkdtemp(prefix="tasador-cfg-", dir="/tmp")
    p = os.path.join(d, "cfg.json")
    with open(p, "w") as f:
        json.dump({"segments": [{"name": "a", "price_min": 1, "price_max": 5, "description": "x"},
                                {"name": "b", "price_min": 5, "price_max": 9}]}, f, indent=2)
    segs = segments_from_config(read_segment_config(spark, p))
    assert [s.name for s in segs] == ["a", "b"] and segs[1].price_max == 9.0


def test_quarantine(spark):
    df = spark.createDataFrame([(1, "<!DOCTYPE html><html>Request Rejected</html>"), (2, "1,park,-34.6,-58.4\n"),
                                (3, "a,b\n"), (4, "  ")], "id int, body string")
    got = {r["id"]: (r["is_valid"], r["quarantine_reason"]) for r in quarantine(df, "body", 4).collect()}
    assert got[1] == (False, "markup, not delimited text")
    assert got[2] == (True, None)
    assert got[3] == (False, "unexpected field count")
    assert got[4] == (False, "empty")


def test_feature_columns_by_dtype(spark):
    df = spark.createDataFrame([(1.0, "USD", 2, True, "x", 3.0)],
                               "price double, currency string, bedrooms int, flag boolean, location string, area double")
    assert feature_columns(df) == ["bedrooms", "area"]


def test_metadata_sink(spark):
    from tasador.sources.sinks import write_metadata
    d = tempfile.mkdtemp(prefix="tasador-meta-", dir="/tmp")
    doc = spark.createDataFrame([('{"overall_rmse": 1.0}',)], "metadata string")
    write_metadata(doc, os.path.join(d, "m"))
    assert json.loads(spark.read.text(os.path.join(d, "m")).first()[0]) == {"overall_rmse": 1.0}
