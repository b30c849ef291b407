import random
import re
from collections import Counter

import pytest

from tasador.llm import licences as L
from tasador.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute_base(text):
    ws = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = []
    for phrase, label in (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")):
        p = phrase.split()
        places += [(i, label) for i in range(len(ws)) if ws[i : i + len(p)] == p]
    at = [i for i, _ in places]
    return len(ws), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


@pytest.mark.parametrize("expression,value,tree", [
    ("mit", 1.0, "mit"),
    ("gpl-2 or mit and cc-by-nc", 0.4, "(gpl-2 or (mit and cc-by-nc))"),
    ("( gpl-2 or mit ) and cc-by-nc", 0.2, "((gpl-2 or mit) and cc-by-nc)"),
    ("gpl-2 with classpath-exception or mit and bsd", 1.0, "((gpl-2 with classpath-exception) or (mit and bsd))"),
    ("gpl-3 with x", 0.7, "(gpl-3 with x)"),
    ("a or b or c", 0.5, "((a or b) or c)"),
    ("( ( mit", 1.0, "mit"),
    ("( mit or", 1.0, "mit"),
    ("mit or ( gpl-2 and (", 1.0, "(mit or gpl-2)"),
    ("mit ) or gpl-2", 1.0, "mit"),
    ("mit gpl-2", 1.0, "mit"),
    ("cc-by-nc-sa-4 and cc-by-4", 0.2, "(cc-by-nc-sa-4 and cc-by-4)"),
])
def test_expressions(expression, value, tree):
    got = L.evaluate(expression.split())
    assert got[0] == pytest.approx(value) and got[2] == tree and got[1] == {w for w in expression.split() if w in tree and w not in "()" and w not in L.LEVEL}


def test_no_expression():
    for e in ("", "or mit", "( (", ") mit", "and"):
        assert L.evaluate(e.split()) is None


@pytest.mark.parametrize("text,labels,score", [
    ("Released under the MIT License.", {"mit"}, 1.0),
    ("# SPDX-License-Identifier: (GPL-2.0-only WITH Classpath-exception-2.0) OR Apache-2.0\nplain", {"gpl-2", "classpath-exception-2", "apache-2"}, 1.0),
    ("License-Expression: BSD-3-Clause AND CC-BY-NC-4.0", {"bsd-3-clause", "cc-by-nc-4"}, 0.2),
    ("Use it under the MIT license or the GNU General Public License, version 3.", {"mit", "gpl-3"}, 1.0),
    ("GNU General Public License version 2 with the Classpath exception", {"gpl-2", "classpath-exception"}, 0.7),
    ("MIT license. Long after that, and far away from it, all rights reserved.", {"mit", "all-rights-reserved"}, 0.0),
    ("SPDX-License-Identifier:\nMIT", set(), 0.0),
    ("We permit license plates; the mitigation of apache helicopters with exceptions.", set(), 0.0),
    ("", set(), 0.0),
])
def test_statements(text, labels, score):
    got = L.scan(text.encode())["statements"]
    assert {x for _, ls, _ in got for x in ls} == labels and min((v for v, _, _ in got), default=0.0) == pytest.approx(score)


def texts():
    rng = random.Random(2)
    words = ["under", "the", "MIT", "license", "Apache", "version", "2", "cc", "by", "nc", "é", "漢字", "SPDX-License-Identifier:", "or", "and", "(", ")", "with", "all rights reserved", "x"]
    out = [None, "", " ", "cc by nc cc by nc cc-by-nc", "under the mit licenseé", "UNDER—THE mit license", "cc by nc sa", "x " * 200_000 + "cc by nc", "\x00cc\x7fby\x60nc"]
    return out + ["".join(rng.choice(words) + rng.choice([" ", " ", "-", "\n", ", "]) for _ in range(rng.randrange(40))) for _ in range(500)]


def test_base_against_brute_force(spark):
    rows = [(None if k == 6 else k % 300, t, "c", 1) for k, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels string, score int").repartition(3)
    got = L.scan_licences(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, ",".join(r.base_labels)) for r in got) == Counter((r[0], *brute_base(r[1])) for r in rows)
    assert all(set(r.base_labels) <= set(r.labels) and r.labels == sorted(set(r.labels)) and 0 <= r.score <= 1 for r in got)
    assert L.scan_licences(docs.limit(0)).count() == 0


def test_query(spark):
    rows = {r.doc_id: r for r in QUERIES["op13_licences"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        r = rows[d.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(d.text)
        want = {label for line, label in (("Released under the MIT License.", "mit"), ("Apache License, Version 2.0.", "apache-2"), ("General Public License, version 3.", "gpl-3"), ("CC BY-NC 4.0", "cc-by-nc"), ("All rights reserved.", "all-rights-reserved")) if line in (d.text or "")}
        assert set(filter(None, r.labels.split(","))) == want, d.doc_id
