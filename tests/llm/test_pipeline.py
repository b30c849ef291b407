import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from tasador.llm.common import written

from .test_codecs import check_packing
from .test_line_dedup import brute as brute_lines
from .test_pii import brute as brute_spans
from .test_simhash import brute_groups, brute_print

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def kept(spark):
    """The documents before the first stage and after each."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(5000, None, None, None, None), (5001, "", "en", "src0", 0), (5002, "123 456", "en", "src1", 7), (5003, "Слово не воробей, вылетит не поймаешь. " * 3, None, "src2", 120),
           (None, "the of and that with this from a document without an id", "en", "src3", 55), (5004, "the of and that with this a@b.cc and 10.0.0.1 there", "en", "src4", 50), (5004, "the of and that with this a@b.cc and 10.0.0.1 there", "en", "src4", 50)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    out = [docs]
    for name, stage in C.STAGES:
        out.append(written(stage(spark, out[-1], SF), name))
    return out


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_keep_the_columns(kept):
    assert [n for n, _ in C.STAGES] == ["language_id", "line_dedup", "simhash", "pii", "packing"]
    assert all(df.columns == COLUMNS for df in kept[:-1])
    for df in kept[2:-1]:
        assert df.filter(F.col("n_chars") != F.length("text")).count() == 0


def test_language_id_drops_what_has_no_language(kept):
    before, after = pairs(kept[0]), pairs(kept[1])
    gone = {d for d, _ in before} - {d for d, _ in after}
    assert gone == {5000, 5001, 5002, 5003}
    assert {r.lang for r in kept[1].collect()} <= {"en", "fr", "de", "es"}


def test_line_dedup(kept):
    assert sorted(pairs(kept[2]), key=str) == sorted([(d, t) for d, t, *_ in brute_lines(pairs(kept[1]))], key=str)


def test_one_document_of_each_group_stays(kept):
    rows = pairs(kept[2])
    groups = brute_groups([(d, brute_print(t)) for d, t in rows if d is not None])
    want = {d for d, _, least in groups if d == least} | {None}
    after = pairs(kept[3])
    assert sorted(map(str, (d for d, _ in after))) == sorted(map(str, want)) and set(after) <= set(rows)


def test_rows_that_share_an_id(spark):
    """Unrelated texts of one id both stay, unless a group has a lesser id; odd columns do no harm."""
    a, b, c = ("alpha beta gamma delta " * 9, "one two three four five six seven " * 7, "red green blue black white " * 8)
    rows = [(1, a), (1, b), (1, b), (2, a), (3, c), (4, c), (4, b), (None, a), (None, None), (5, None), (6, "")]
    docs = spark.createDataFrame([(d, t, "en", "s", 1, {"k": "v"}, "x") for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long, m map<string,string>, `a.b` string")
    out = C.drop_near_duplicates(spark, C.drop_repeated_lines(spark, docs, SF), SF)
    assert out.columns == docs.columns
    want = [(1, a), (1, b), (3, c), (5, ""), (None, a), (None, "")]
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(want, key=str)


def test_personal_data_is_replaced(kept):
    before, after = dict(pairs(kept[3])), dict(pairs(kept[4]))
    assert set(before) == set(after)
    for doc, text in before.items():
        spans = sorted((s, -e, k) for k, s, e in brute_spans(text))
        if not spans and "[" not in after[doc]:
            assert after[doc] == text
        for k, s, e in brute_spans(text):
            assert text[s:e] not in after[doc] or text.count(text[s:e]) > len(spans)
    assert after[5004] == "the of and that with this [EMAIL] and [IP] there"
    assert sum(len(re.findall(r"\[(EMAIL|IP|CARD|PHONE)\]", t)) for t in after.values()) > 3


def test_packing(kept):
    check_packing(pairs(kept[4]), kept[5].collect())


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in C.STAGES:
        docs = written(stage(spark, docs, SF), name)
    assert docs.count() == 0
