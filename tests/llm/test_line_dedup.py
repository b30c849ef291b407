import re
from collections import defaultdict

import pytest

from tasador.llm import line_dedup as D

LONG, OTHER = "This very line is long enough to be counted here.", "  Another line of more than forty code points, also.\t"
BLANKS = " \t\n\x0b\x0c\r"


def norm(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(BLANKS))


def brute(rows, min_chars=40, min_docs=5):
    docs = defaultdict(set)
    for doc, text in rows:
        if doc is not None:
            for line in (text or "").split("\n"):
                docs[norm(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or len(norm(x)) < min_chars or len(docs[norm(x)]) < min_docs or max(docs[norm(x)]) == doc]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def rows():
    out = [(i, f"unique {i}\n{LONG.upper() if i % 2 else LONG}\n\n{OTHER if i % 9 == 0 else 'short'}\né{'é' * 39}\n{LONG}") for i in range(60)]
    out += [(100, None), (101, ""), (102, "\n\n"), (None, LONG), (3, out[3][1]), (-5, LONG + "\r\nx"), (2**40, OTHER + "\n" + "z" * 500_000), (103, "é" * 20), (104, LONG + "\n" + LONG)]
    return out


@pytest.mark.parametrize("batches,fanout", [(4, 2), (1, 2), (7, 3)])
def test_against_brute_force(spark, batches, fanout):
    docs = spark.createDataFrame([(*r, "x", 9, "y") for r in rows()], "doc_id long, text string, n_lines string, n_dropped int, `other.name` string").repartition(5)
    got = D.dedup_lines(docs, batches=batches, fanout=fanout)
    assert set(got.columns) == {"doc_id", "text", "other.name", "kept_text", "n_lines", "n_dropped"}
    assert sorted(map(tuple, got.select("doc_id", "kept_text", "n_lines", "n_dropped").collect()), key=str) == brute(rows())


def test_levels_are_compacted(spark):
    runs = D.LineRuns(spark, fanout=2)
    for k in range(6, 0, -1):
        runs.add(spark.createDataFrame([(bytes([x]), k) for x in range(k)], "key binary, doc long"))
    assert [len(level) for level in runs.levels] == [0, 1, 1]
    got = {r.key[0]: (r.docs, r.holder) for r in runs.total().collect()}
    assert got == {x: (6 - x, 6) for x in range(6)}


def test_known_keys_are_not_broadcast(spark, monkeypatch):
    plans, write = [], D.LineRuns.write
    monkeypatch.setattr(D.LineRuns, "write", lambda self, run: plans.append(run._jdf.queryExecution().executedPlan().toString()) or write(self, run))
    runs = D.LineRuns(spark)
    for doc in (2, 1):
        runs.add(spark.range(3).selectExpr("cast(string(id) AS binary) AS key", f"{doc}L AS doc"))
    assert "SortMergeJoin" in plans[1] and "Broadcast" not in plans[1]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert D.dedup_lines(docs).count() == 0
