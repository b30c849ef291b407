"""Exact top-k inner products by Fagin's threshold algorithm.

The vectors are dealt to blocks by a hash of their id, the queries to groups of
their own, and each (query group, block) tile is worked alone: it holds two bounded
sets, whatever the size of the tables. Within a tile the block keeps one list a dimension, its rows
sorted by that component. A query goes down all lists at once, from the top where
its own component is positive, from the bottom where it is negative. Rows met for the
first time are scored in full; the last values met, weighed by the query, bound
every row not yet met, and the query stops when the bound is below its kth score. (At
equality it goes on: a row with the same score and a smaller id may follow.)

Queries of a tile go down the lists together, so that the rows met are scored by one
product of matrices; a row met by one query is scored for all that have not stopped,
which only makes their bounds safer. Where the vectors have no direction that stands
out, the lists' bound stays above any real product and a tile is scored in full.

Every query first meets one block, its home, and takes the kth score found there as
its floor in all other tiles, so a tile that cannot reach it stops at once. The
tiles' best are merged by a ranked window, which Spark cuts to k rows a query before
its shuffle.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

BOUND = 2**62


def integer_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: float = 256.0) -> DataFrame:
    """(id, v): floor(scale * x) of every component as long. Rows without an
    id or a vector, and vectors holding null, non-finite or (scaled) unrepresentable
    components, are left out. Of rows that share an id, the smallest vector counts."""
    x = F.col("x")
    ok = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * scale) < float(BOUND))
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("x")).filter(F.col("id").isNotNull() & x.isNotNull() & F.forall(x, ok))
    return rows.select("id", F.transform(x, lambda c: F.floor(c * scale)).alias("v")).groupBy("id").agg(F.min("v").alias("v"))


def products(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Exact inner products, a row for each query; those beyond a long are moved to its ends."""
    if not vectors.size:
        return np.zeros((len(queries), len(vectors)), dtype=np.int64)
    most = float(np.abs(vectors).max()) * float(np.abs(queries).max()) * vectors.shape[1]
    if most < 2**53:  # every partial sum is a whole number that a double holds
        return (queries.astype(np.float64) @ vectors.astype(np.float64).T).astype(np.int64)
    if most < BOUND:
        return queries @ vectors.T
    limits = np.iinfo(np.int64)
    exact = queries.astype(object) @ vectors.astype(object).T
    return np.array([[min(max(s, limits.min), limits.max) for s in row] for row in exact.tolist()], dtype=np.int64)


class Block:
    """Vectors of one length, with a sorted list for each dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        by_id = np.argsort(ids)
        self.ids, self.vectors = ids[by_id], vectors[by_id]
        self.order = np.argsort(self.vectors, axis=0, kind="stable").T.copy()  # a row for each dimension
        self.values = np.take_along_axis(self.vectors, self.order.T, axis=0).T.copy()

    def search(self, own: int, query: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """``search_many`` for one query."""
        return self.search_many(np.array([own]), query[None], k, np.array([floor]))[0]

    def search_many(self, own: np.ndarray, queries: np.ndarray, k: int, floors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query (ids, scores) of the best k rows other than ``own``, best
        first; rows scoring below its floor may be missing. The queries go down the lists
        together: rows that one of them meets are scored for all that have not stopped."""
        n = len(self.ids)
        at = np.minimum(np.searchsorted(self.ids, own), n - 1)
        own = np.where(self.ids[at] == own, at, -1)
        above, below = np.maximum(queries, 0).astype(np.float64), np.minimum(queries, 0).astype(np.float64)
        found = [(np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))] * len(queries)
        kth, going = floors.astype(np.float64), np.arange(len(queries))
        met, depth, step = np.zeros(n, dtype=bool), 0, max(8, 4 * k)
        while depth < n:
            # the bound for rows not yet met: the list entries at this depth
            high, low = self.values[:, n - 1 - depth].astype(np.float64), self.values[:, depth].astype(np.float64)
            bound, size = above[going] @ high + below[going] @ low, above[going] @ np.abs(high) - below[going] @ np.abs(low)
            going = going[bound + np.where(size >= 2**52, 1e-9 * size, 0.0) >= kth[going]]
            if not len(going):
                break
            down, up = (above[going] > 0).any(0), (below[going] < 0).any(0)
            end = min(n, depth + step) if down.any() or up.any() else n
            here = np.zeros(n, dtype=bool)
            if down.any() or up.any():
                here[self.order[down, n - end : n - depth]] = True
                here[self.order[up, depth:end]] = True
            else:  # queries of zeros only have no list to go down
                here[:] = True
            new = np.flatnonzero(here & ~met)
            met |= here
            for q, scores in zip(going, products(self.vectors[new], queries[going]), strict=True):
                worth = (scores >= kth[q]) & (new != own[q])
                found[q] = best(np.concatenate([found[q][0], self.ids[new[worth]]]), np.concatenate([found[q][1], scores[worth]]), k)
                if len(found[q][0]) >= k:
                    kth[q] = max(kth[q], float(found[q][1][-1]))
            depth, step = end, step * 2
        return found


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if len(ids) > 4 * k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = scores >= floor
        ids, scores = ids[keep], scores[keep]
    at = np.lexsort((ids, -scores))[:k]
    return ids[at], scores[at]


RESULT = "query_id long, vec_id long, score long"


BATCH = 128  # queries that go down a block's lists together


def search_tile(queries: pd.DataFrame, block: pd.DataFrame, k: int) -> pd.DataFrame:
    """The best k rows of the block for each query (id, v, floor)."""
    out = []
    asked = queries["v"].map(len)
    for length, rows in block.groupby(block["v"].map(len)):
        some = queries[asked == length]
        if some.empty:
            continue
        stacked = lambda v: np.stack(v.to_numpy()).astype(np.int64).reshape(len(v), int(length))
        index = Block(rows["id"].to_numpy(), stacked(rows["v"]))
        for start in range(0, len(some), BATCH):
            part = some.iloc[start : start + BATCH]
            floors = part["floor"].astype("float64").fillna(-np.inf).to_numpy()
            found = index.search_many(part["id"].to_numpy(), stacked(part["v"]), k, floors)
            out += [pd.DataFrame({"query_id": q, "vec_id": ids, "score": scores}) for q, (ids, scores) in zip(part["id"], found, strict=True)]
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")


def tiles(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    def run(q: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return search_tile(q, b, k)

    queries, vectors = (x.select(*[F.col(c).alias(c) for c in x.columns]) for x in (queries, vectors))  # both come from one table
    return queries.groupBy("group", "block").cogroup(vectors.groupBy("group", "block")).applyInPandas(run, RESULT)


def top_k(df: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: float = 256.0, block_rows: int = 8192, group_rows: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vector for whose id ``is_query``
    (over column ``id``) holds, its k best others by inner product of the
    integer vectors, ties to the smaller id; all of them if there are fewer.

    Vectors are compared with those of their own length. Which rows take part, and
    what repeated ids count as, is told at ``integer_vectors``. Other columns of ``df``
    are left out. An empty table gives no rows."""
    vectors = written(integer_vectors(df, key, vector, scale), "vectors")
    n, asked = vectors.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    blocks, groups = -(-n // block_rows) or 1, -(-asked // group_rows) or 1
    place = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    vectors = vectors.withColumn("block", place)
    queries = vectors.filter(is_query).withColumn("group", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(groups)).cast("int"))
    every_group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    home = tiles(queries.withColumn("floor", F.lit(None).cast("long")), vectors.withColumn("group", every_group), k)
    home = written(home, "home")
    floors = home.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least")).select("query_id", F.when(F.col("n") >= k, F.col("least")).alias("floor"))
    away = queries.join(floors, queries["id"] == floors["query_id"], "left").select("id", "v", "group", "floor", F.col("block").alias("home"))
    away = away.withColumn("block", every_block).filter("block <> home").select("id", "v", "floor", "group", "block")
    rest = tiles(away, vectors.withColumn("group", every_group), k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return home.unionByName(rest).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
