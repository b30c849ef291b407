import itertools
import re
from collections import Counter

import numpy as np
import pytest

from tasador.llm import line_crf as L
from tasador.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^ \t\n\x0b\x0c\r]+", text)
    full = [line for line in text.split("\n") if line.strip(" \t\n\x0b\x0c\r")]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    again = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(full) - len(set(full)), len(again)


def test_base_counts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    texts = [r.text for r in rows] + ["", "a", "a a a a a", "x\n\n x\nx\n", "é è é è é è", "\t \n", "a b c a b", "1 | <b>  \x0b1 |\x1c"]
    for text in texts:
        data = text.encode()
        assert L.base_rules(data, data.split(), data.split(b"\n")) == brute_counts(text), text[:80]


@pytest.mark.parametrize("seed", range(20))
def test_viterbi_is_the_best_path(seed):
    rng = np.random.default_rng(seed)
    e, t, s = rng.normal(size=(7, 2)), rng.normal(size=(2, 2)), rng.normal(size=2)
    value = lambda p: s[p[0]] + sum(e[k, c] for k, c in enumerate(p)) + sum(t[a, b] for a, b in itertools.pairwise(p))
    best = max(itertools.product((0, 1), repeat=7), key=value)
    assert tuple(L.viterbi(e, t, s)) == best


def test_gradient_ascent_separates_lines():
    good, bad = b"The house stood by a quiet river, and nobody came there.\nIt was old.", b"Home | News | Sport |\nBUY!! NOW!! BUY!!\n%%% $$$"
    model = L.fit([good] * 20 + [bad] * 20, [1] * 20 + [0] * 20, rounds=60)
    assert L.line_labels(model, L.line_features(good.split(b"\n"))[0]).tolist() == [1, 1]
    assert L.line_labels(model, L.line_features(bad.split(b"\n"))[0]).tolist() == [0, 0, 0]


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = L.train(docs, labels.filter("doc_id % 2 = 0"))
    found = L.quality(docs, model).join(labels.filter("doc_id % 2 = 1"), "doc_id").filter("not base_failed").collect()
    assert len(found) > 100 and sum(r.kept == (r.quality == 1) for r in found) >= 0.97 * len(found)
    good = [r for r in found if r.quality == 1]
    assert sum(r.kept for r in good) >= 0.99 * len(good)


def test_boilerplate_within_good_documents(spark):
    """Lines of a bad document put inside a good one are found there, and the good lines stay."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = L.train(docs, labels.filter("doc_id % 2 = 0"))
    rows = docs.join(labels.filter("doc_id % 2 = 1"), "doc_id").filter("length(text) between 400 and 20000").orderBy("doc_id").collect()
    good = [r.text.split("\n") for r in rows if r.quality == 1]
    bad = [r.text.split("\n") for r in rows if r.quality == 0]
    lines = [line for text in bad for line in text if len(line.split()) >= 4]
    found = planted = kept = own = one_label = n = 0
    for k, text in enumerate(good):
        if len(text) < 2:
            continue
        junk = [lines[(5 * k + j) % len(lines)] for j in range(4)]
        at = len(text) // 2
        whole = "\n".join(text[:at] + junk + text[at:]).encode()
        got = L.line_labels(model, L.line_features(whole.split(b"\n"))[0])
        marked = got[at : at + 4]
        n, found, planted, one_label = n + 1, found + int((marked == 0).sum()), planted + 4, one_label + (len(set(got.tolist())) == 1)
        kept, own = kept + int(got.sum() - marked.sum()), own + len(text)
    print(n, found / planted, one_label / n, kept / own, model["transition"])
    assert n >= 40 and found >= 0.9 * planted and one_label <= 0.05 * n and kept >= 0.9 * own


def test_edges(spark):
    rows = [(None, None), (1, ""), (1, ""), (2, "word " * 200_000), (3, "\n" * 5000), (4, " ".join(f"w{i}" for i in range(60)))]
    docs = spark.createDataFrame([(*r, "x", True) for r in rows], "doc_id long, text string, kept string, n_words boolean")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert L.train(docs, labels) is None
    got = {r.doc_id: r for r in L.quality(docs, None).collect()}
    assert got[None].n_words == 0 and got[None].base_failed and got[2].n_repeat_words == 200_000 and not got[2].kept
    assert got[4].kept and len(got[3].line_labels) == 5001
    assert L.quality(docs.limit(0), None).count() == 0


def test_query_covers_every_document(spark):
    assert QUERIES["op5_line_crf"](spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()
