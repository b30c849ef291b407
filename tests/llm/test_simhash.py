import numpy as np
import pytest
import xxhash

from tasador.llm import simhash as S
from tasador.llm.components import connected_components
from tasador.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute_print(text, shingle=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, threshold=2):
    """(doc, print) -> least doc reachable."""
    distinct = sorted({p for _, p in prints})
    parent = {p: p for p in distinct}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    a = np.array(distinct, dtype=np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i] ^ a[i + 1 :]) <= threshold):
            parent[root(distinct[i])] = root(distinct[i + 1 + j])
    least = {}
    for doc, p in prints:
        if doc is not None:
            least[root(p)] = min(least.get(root(p), doc), doc)
    return [(doc, f"{p:016x}", least.get(root(p))) for doc, p in prints]


def test_golay_code_is_perfect_and_covers():
    _, near, leader = S.golay()
    assert [sum(map(len, x)) for x in near] == [2048, 8855, 33649] and all(bin(int(x)).count("1") <= 3 for x in leader)


@pytest.mark.parametrize("threshold", [0, 1, 2])
def test_links_of_random_fingerprints(spark, threshold):
    rng = np.random.default_rng(threshold)
    fps = rng.integers(-(2**63), 2**63, 300)
    near = fps.copy()
    for _ in range(3):
        near = near ^ (np.int64(1) << rng.integers(0, 64, 300))
        fps = np.concatenate([fps, near])
    fps = np.unique(fps)
    want = {(int(a), int(b)) for i, a in enumerate(fps) for b in fps[i + 1 :][np.bitwise_count((a ^ fps[i + 1 :]).view(np.uint64)) <= threshold]}
    got = [tuple(r) for r in S.near_links(spark.createDataFrame([(int(x),) for x in fps], "fp long"), threshold).collect()]
    assert len(got) == len(set(got)) and {(min(p), max(p)) for p in got} == want


def test_visitors_are_not_broadcast(spark):
    fps = spark.range(50).withColumnRenamed("id", "fp")  # of a known, small size
    plan = S.near_links(fps, 2)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_groups_are_not_broadcast(spark):
    docs = spark.range(50).selectExpr("struct(id, 'x') AS doc_id", "string(id) AS text")
    plan = S.near_duplicates(docs)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 200), (200, 300), (5, 5), (400, 399), (1000, 2000), (2000, 1000)] + [(7000, 7001 + k) for k in range(50)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(41)) and got[300] == got[200] == got[100] == 100 and got[400] == 399 and got[2000] == 1000
    assert all(got[7001 + k] == 7000 for k in range(50)) and 5 in got


def test_documents_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(300).collect()
    rows = [(r.doc_id, r.text) for r in rows]
    long = " ".join(f"w{i}" for i in range(70_000))
    rows += [(9000, None), (9001, ""), (None, " \t"), (9002, "One"), (9003, "one"), (9003, "one"), (9004, "a b"), (None, "only here without an id"), (9005, long), (9006, long + " end"), (8999, "é É A\x0bb c")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, fingerprint string, component_id int").repartition(4)
    got = sorted(map(tuple, S.near_duplicates(docs).collect()), key=str)
    assert got == sorted(brute_groups([(d, brute_print(t)) for d, t in rows]), key=str)


def test_query_and_empty_table(spark):
    assert QUERIES["op8_simhash"](spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert S.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
