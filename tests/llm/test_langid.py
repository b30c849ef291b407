import math
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tasador.llm import langid as L
from tasador.llm.queries import QUERIES

EN = "the house of the thing and that with this from them other words"
DE = "der die das und nicht einen schwer zwischen über menschen haben"
ROWS = [(i, EN[i % 9 :] + " " + EN[: 20 + i], "en", "a.example.com") for i in range(30)]
ROWS += [(100 + i, DE[i % 9 :] + " " + DE[: 20 + i], "de-DE", "b.example.de") for i in range(20)]
ROWS += [
    (200, EN * 3, "de", "b.example.de"),  # declared wrongly
    (201, "Слово не воробей вылетит не поймаешь " * 5, None, "a.example.com"),  # in no language known
    (202, None, "en", "a.example.com"), (203, "", None, None), (204, "12 34 %% ..", "de", "b.example.de"),
    (None, DE, None, "b.example.de"), (5, ROWS[5][1], "en", "a.example.com"), (206, EN, "x-none-such", "lonely"), (207, DE * 3000, "DE", "c.example.de"),
]


def brute(rows, temper=0.2, unknown=0.01, strength=50.0):
    """The same fusion, row by row, with dictionaries."""
    tag = lambda t: m[1].lower() if (m := re.fullmatch(r"\s*([A-Za-z]{2,3})(?:[-_].*)?\s*", t or "")) else None
    suffix = lambda h: m[1].lower() if (m := re.search(r"\.([^.]+)$", h or "")) else None
    counts = defaultdict(Counter)
    for _, text, lang, _ in rows:
        if tag(lang):
            counts[tag(lang)].update(L.trigrams((text or "").encode()).tolist())
    langs = [*sorted(counts), "und"]
    total = {x: sum(counts[x].values()) + 0.05 * L.BUCKETS for x in langs}
    log = lambda x, g: -math.log(L.BUCKETS) if x == "und" else math.log((counts[x][g] + 0.05) / total[x])
    logs = [np.array([temper * sum(log(x, g) for g in L.trigrams((t or "").encode()).tolist()) for x in langs]) for _, t, *_ in rows]
    posts = [L.posterior(x) for x in logs]
    by = lambda f: {k: sum(p for p, r in zip(posts, rows, strict=True) if f(r) == k) for k in {f(r) for r in rows}}
    overall = sum(posts)
    prior = (overall + 1)[:-1] / (overall + 1)[:-1].sum() * (1 - unknown)
    prior = np.append(prior, unknown)
    tags, suffixes, hosts = by(lambda r: tag(r[2])), by(lambda r: suffix(r[3])), by(lambda r: r[3])
    spoken, size = sum(v for k, v in tags.items() if k), len([k for k in tags if k])
    smooth = lambda n, above: (n + strength * above) / (n.sum() + strength)
    out = []
    for (_, text, lang, host), x in zip(rows, logs, strict=True):
        above = smooth(suffixes[suffix(host)], prior) if suffix(host) else prior
        x = x + np.log(smooth(hosts[host], above) if host else prior)
        if tag(lang):
            x = x + np.log((tags[tag(lang)] + 1) / (spoken + size + 1))
        best = int(x.argmax())
        p = L.posterior(x)[best]
        out.append((langs[best], p, langs[best] != "und" and p >= 0.5 and bool(re.search(r"[^\W\d_]", text or ""))))
    return out


def test_against_brute_force(spark):
    docs = spark.createDataFrame([(*r, "clash", 1.0) for r in ROWS], "doc_id long, text string, lang string, host string, language string, posterior double").repartition(3).withColumn("n", F.monotonically_increasing_id())
    got = L.identify(docs, declared=F.col("lang"), host=F.col("host")).collect()
    assert len(got) == len(ROWS) and set(got[0].asDict()) == {"doc_id", "text", "lang", "host", "n", "language", "posterior", "text_posterior", "accepted"}
    want = {(r[0], r[1], r[2]): w for r, w in zip(ROWS, brute(ROWS), strict=True)}
    for r in got:
        language, p, accepted = want[r.doc_id, r.text, r.lang]
        assert (r.language, r.accepted) == (language, accepted), r
        assert r.posterior == pytest.approx(p)


def test_decisions(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, host string")
    got = {r.doc_id: (r.language, r.accepted) for r in L.identify(docs, declared=F.col("lang"), host=F.col("host")).collect()}
    assert got[200] == ("en", True) and got[201] == ("und", False) and not got[202][1] and not got[204][1] and got[207] == ("de", True)
    assert all(got[i] == ("en", True) for i in range(30)) and all(got[100 + i] == ("de", True) for i in range(20))


def test_no_evidence_but_the_text_and_empty_table(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, host string")
    assert {r.language for r in L.identify(docs).collect()} == {"und"}
    assert L.identify(docs.limit(0), declared=F.col("lang"), host=F.col("host")).count() == 0


def test_rare_tags_and_clashing_names(spark):
    """Of 150 tags that one row declares each none is a language; columns may be named as the operator's own."""
    tags = [a + b for a in "abcdfghjklmnopq" for b in "pqrstuvwxy"]
    rows = [(r[0], r[1], r[2], r[3], "a", "b", "c") for r in ROWS] + [(1000 + i, EN, t, "a.example.com", "a", "b", "c") for i, t in enumerate(tags)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, host string, __host string, `a.b` string, told string")
    start = time.monotonic()
    got = L.identify(docs, declared=F.col("lang"), host=F.col("host")).collect()
    assert len(got) == len(rows) and {r.language for r in got} <= {"en", "de", "und"} and time.monotonic() - start < 30
    assert all(r.language == "en" and r.accepted for r in got if (r.doc_id or 0) >= 1000)
    assert {(r["__host"], r["a.b"], r.told) for r in got} == {("a", "b", "c")}


def test_many_languages(spark):
    """No expression grows with the square of the languages."""
    tags = [a + b for a in "abcdfghjklmnopq" for b in "pqrstuvwxy"]
    rows = [(i, f"{t} {t}{t} {t}x", t, "h.example.com") for i, t in enumerate(tags) for _ in range(5)]
    start = time.monotonic()
    got = L.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string, host string"), declared=F.col("lang"), host=F.col("host")).collect()
    assert len(got) == len(rows) and {r.language for r in got} >= set(tags[:10]) and time.monotonic() - start < 60


def test_pages(spark):
    found = QUERIES["langid_pages"](spark, "/root/testdata/sf0.01").collect()
    assert len(found) == spark.read.parquet("/root/testdata/sf0.01/pages.parquet").count()
    assert sum(r.declared == r.language and r.kept for r in found) >= 0.99 * len(found)
