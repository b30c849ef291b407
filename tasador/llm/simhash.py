"""SimHash near-duplicates by anchor-point covering.

The anchors are a covering code over the 64-bit fingerprints: the binary Golay
code on bits 0-22, the same on bits 23-45, the other bits free. The Golay code
is perfect, so each 23-bit half lies within 3 bits (the covering radius) of exactly
one code word: a fingerprint has one home anchor. It is replicated as a visitor to
every anchor whose two halves lie within the covering radius plus a share of the
threshold of its own halves, the shares adding up to the threshold at most (61
anchors on average at 2 bits). If x and y differ in at most that many bits, y visits
the home of x, so comparing homes with visitors anchor by anchor finds every pair.

Equal fingerprints are reduced to one before anything is replicated, so copies
cost nothing, and a fingerprint has a bounded number of others within the
threshold, so the links grow with the distinct fingerprints. A crowded anchor is
an ordinary skewed equi-join key, which Spark splits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import utf8, written
from .components import connected_components

BITS = 23  # of a Golay block
RADIUS = 3
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
SLICE = 1 << 16  # shingles counted at once


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash of the text's word shingles (A-Z lower-cased, repeats
    included): a bit is set if over half of the shingles' XXH64 (seed 42) have it.
    Fewer words than a shingle: the whole sequence is one; no word: 0."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # bytes: A-Z and the six ASCII blanks only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1 :]
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, SLICE):
        a, b = starts[at : min(n, at + SLICE)].tolist(), last[at : at + SLICE].tolist()
        h = np.array([xxh64_intdigest(joined[i:j], 42) for i, j in zip(a, b, strict=True)], dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def with_fingerprint(df: DataFrame, text: str = "text", shingle: int = 3, name: str = "fp") -> DataFrame:
    """``df`` with a long column of the fingerprint's 64 bits. A null text counts as empty."""

    @F.pandas_udf("long")
    def fp(texts):
        import pandas as pd

        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype="<u8").view("<i8"))

    return df.withColumn(name, fp(utf8(text)))


@lru_cache(maxsize=1)
def golay() -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Syndromes of the 23 bits; for s = 0, 1, 2 and each syndrome, the
    differences of weight 3 + s or less (s = 0) or exactly 3 + s to code words."""
    from itertools import combinations

    def rest(x: int) -> int:
        for k in range(BITS - 1, 10, -1):
            if x >> k & 1:
                x ^= GENERATOR << (k - 11)
        return x

    bit = np.array([rest(1 << k) for k in range(BITS)], dtype=np.int64)
    by_weight = []
    for weights in (range(RADIUS + 1), (RADIUS + 1,), (RADIUS + 2,)):
        found: list[list[int]] = [[] for _ in range(1 << 11)]
        for w in weights:
            for at in combinations(range(BITS), w):
                found[int(np.bitwise_xor.reduce(bit[list(at)])) if at else 0].append(sum(1 << k for k in at))
        by_weight.append([np.array(x, dtype=np.int64) for x in found])
    assert all(len(x) == 1 for x in by_weight[0])  # a perfect code
    return bit, by_weight, np.array([x[0] for x in by_weight[0]], dtype=np.int64)


def syndrome(x: np.ndarray) -> np.ndarray:
    bit, _, _ = golay()
    out = np.zeros_like(x)
    for k in range(BITS):
        out ^= np.where(x >> k & 1, bit[k], 0)
    return out


def halves(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = (1 << BITS) - 1
    return fp & mask, fp >> BITS & mask


def home_anchor(fp: np.ndarray) -> np.ndarray:
    """The code words nearest to both halves."""
    _, _, leader = golay()
    a, b = halves(fp)
    return (a ^ leader[syndrome(a)]) | (b ^ leader[syndrome(b)]) << BITS


def visited_anchors(fp: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """(index into fp, anchor) for all anchors within the covering radius plus
    the threshold, the threshold shared between the halves."""
    if not 0 <= threshold <= 2:
        raise ValueError("thresholds of 0 to 2 bits are supported")
    _, near, _ = golay()
    a, b = halves(fp)
    sa, sb = syndrome(a), syndrome(b)
    at, anchors = [], []
    for s in range(threshold + 1):
        for t in range(threshold + 1 - s):
            # all differences of half a with s more bits, crossed with those of half b with t more
            na, nb = (np.array([len(x) for x in near[k]]) for k in (s, t))
            fa, fb = (np.concatenate([[0], np.cumsum(n)[:-1]]) for n in (na, nb))
            da, db = np.concatenate(near[s]), np.concatenate(near[t])
            n = na[sa] * nb[sb]
            i = np.repeat(np.arange(len(fp)), n)
            k = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
            x = a[i] ^ da[fa[sa[i]] + k // nb[sb[i]]]
            y = b[i] ^ db[fb[sb[i]] + k % nb[sb[i]]]
            at.append(i)
            anchors.append(x | y << BITS)
    return np.concatenate(at), np.concatenate(anchors)


def homes(fps: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(home_anchor(batch.column(0).to_numpy())), batch.column(0)], names=["anchor", "x"])

    return fps.select("fp").mapInArrow(run, "anchor long, x long")


def visitors(fps: DataFrame, threshold: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy()
            for k in range(0, len(fp), 2048):
                part = fp[k : k + 2048]
                at, anchors = visited_anchors(part, threshold)
                yield pa.RecordBatch.from_arrays([pa.array(anchors), pa.array(part[at])], names=["anchor", "y"])

    return fps.select("fp").mapInArrow(run, "anchor long, y long")


def near_links(fps: DataFrame, threshold: int) -> DataFrame:
    """(a, b), a < b, for all distinct fingerprints of ``fps`` (fp) that differ
    in at most ``threshold`` bits: each pair once, at the home anchor of a.

    Spark sizes the visitors like ``fps``, whose rows they repeat about 61 times, and would broadcast them."""
    pair = homes(fps).join(visitors(fps, threshold).hint("merge"), "anchor")
    return pair.filter((F.col("x") < F.col("y")) & (F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= threshold)).select(F.col("x").alias("a"), F.col("y").alias("b"))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, threshold: int = 2) -> DataFrame:
    """One row per row of ``df``: ``key``, fingerprint (16 lower-case hex digits)
    and component_id, the least key among the rows whose fingerprints are
    reachable by links of at most ``threshold`` bits, the row's own included.

    Null texts count as empty (fingerprint 0, linked like any other). Rows
    with a null key take part with their text but never give an id (null if a
    component has no other). Repeated keys and rows are rows of their own.
    Other columns are left out, whatever their names."""
    texts = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    prints = written(with_fingerprint(texts, shingle=shingle).drop("text"), "prints")
    fps = written(prints.groupBy("fp").agg(F.min("key").alias("least")), "fps")
    roots = connected_components(near_links(fps, threshold))
    named = fps.join(roots.hint("merge"), fps["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = written(named, "roots")
    ids = written(named.groupBy("root").agg(F.min("least").alias("component_id")), "ids")
    groups = written(named.join(ids.hint("merge"), "root").select("fp", "component_id"), "groups")
    return prints.join(groups.hint("merge"), "fp").select(F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
