"""Cross-tokenizer alignment by divide and conquer at shared cuts.

Two tokenisations of the same bytes are two rising lists of token ends. An
interval in which both end together is divided at an end they share: one near the
middle, found by bisecting the other list for the ends around it. Both
halves are divided on; an interval without a shared end inside is a leaf, a
group of tokens of one side against tokens of the other. The intervals of a batch of texts that
have the same depth are divided together, as arrays.

Every pair of tokens whose bytes overlap is a link. How often a pair of ids is linked in
the corpus is counted by Spark. For the second use of the links (each text's
links by their corpus counts) the most frequent id pairs, at most
``common_pairs``, are broadcast; links of all others are few in a text
and are joined as (row, pair) rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import packing
from .common import small_batches, written
from .sentencepiece_codec import MARK, ChunkTable, encode_text
from .sentencepiece_codec import load as load_pieces

PROBES = 8  # ends tried one by one before an interval is searched as a whole
TEXTS = 256  # texts aligned together


@lru_cache(maxsize=1)
def load(ranks_path: str, pattern: str, model_path: str):
    """The two encoders, and the bytes of each of their tokens."""
    enc, sp = packing.load(ranks_path, pattern, 50256), load_pieces(model_path)
    size = sp.get_piece_size()
    b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace(MARK, " ").encode() for i in range(size)]
    a = [enc.decode_single_token_bytes(i) if i < 50256 else packing.SPECIAL.encode() for i in range(50257)]
    return enc, sp, a, b


def common_cuts(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, last_a: np.ndarray, first_b: np.ndarray, last_b: np.ndarray, there: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The leaves of intervals [first, last) of tokens, both lists ending together in each:
    for every leaf the number after its last token of either list, rising. ``there``, if known: the token
    of the second list that the last byte of each token of the first lies in."""
    live = np.stack([first_a, last_a, first_b, last_b])
    there = np.searchsorted(ends_b, ends_a) if there is None else there
    leaves = []
    while live.shape[1]:
        single = (live[1] - live[0] == 1) | (live[3] - live[2] == 1)
        leaves.append(live[[1, 3]][:, single])
        live = live[:, ~single]
        at, match = middle_cut(ends_a, ends_b, live, there)
        leaves.append(live[[1, 3]][:, at < 0])
        live, at, match = live[:, at >= 0], at[at >= 0], match[at >= 0]
        live = np.concatenate([np.stack([live[0], at + 1, live[2], match + 1]), np.stack([at + 1, live[1], match + 1, live[3]])], axis=1)
    out = np.concatenate(leaves, axis=1) if leaves else np.empty((2, 0), dtype=np.int64)
    return np.sort(out[0]), np.sort(out[1])


def middle_cut(ends_a: np.ndarray, ends_b: np.ndarray, live: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each interval a token of the first list, near the middle, whose end the
    second list shares, and the token there; -1 if there is none inside."""
    low, high = live[0], live[1] - 2  # the last token's end closes the interval
    at, match = np.full(live.shape[1], -1), np.full(live.shape[1], -1)
    open_ = np.arange(live.shape[1])
    for step in range(PROBES):
        i = (low[open_] + high[open_]) // 2 + (step + 1) // 2 * (1 if step % 2 else -1)
        inside = (i >= low[open_]) & (i <= high[open_])
        i = i[inside]
        here = there[i]
        shared = ends_b[here] == ends_a[i]
        done = np.flatnonzero(inside)[shared]
        at[open_[done]], match[open_[done]] = i[shared], here[shared]
        left = np.ones(len(open_), dtype=bool)
        left[done] = False
        open_ = open_[left]
        if not len(open_):
            return at, match
    for k in open_[high[open_] - low[open_] + 1 >= PROBES].tolist():  # shorter ones have been searched
        i = np.arange(low[k], high[k] + 1)
        here = there[i]
        shared = np.flatnonzero(ends_b[here] == ends_a[i])
        if len(shared):
            best = shared[np.argmin(np.abs(i[shared] - (low[k] + high[k]) // 2))]
            at[k], match[k] = i[best], here[best]
    return at, match


class Strings:
    """Byte strings that are joined by their numbers."""

    def __init__(self, strings: list[bytes]):
        self.flat = np.frombuffer(b"".join(strings), dtype=np.uint8)
        self.sizes = np.array(list(map(len, strings)), dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def joined(self, numbers: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The strings of ``numbers`` in a row, and where each ends."""
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[numbers] - ends + sizes, sizes)
        at += np.arange(len(at))
        return self.flat[at].tobytes(), ends


class Aligner:
    """Both encoders with the tables for writing groups."""

    def __init__(self, ranks_path: str, pattern: str, model_path: str, table_entries: int):
        self.enc, sp, a, b = load(ranks_path, pattern, model_path)
        self.chunks = ChunkTable(sp, table_entries)
        self.bytes_a, self.bytes_b = Strings(a), Strings(b)
        number = lambda n, a, b: [b"%d%s" % (i, s) for i in range(n) for s in (a, b)]
        self.numbers = Strings([*number(len(a), b",", b"|"), *number(len(b), b",", b";")])  # of A's ids, then of B's

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The ids of both for each text, none if the bytes of either are not " " + text."""
        ids = [np.array(self.enc.encode_ordinary(" " + t) if t else [], dtype=np.int64) for t in texts], [encode_text(self.chunks, t).astype(np.int64) for t in texts]
        want = [b" " + t.encode() if t else b"" for t in texts]
        for own, strings in zip(ids, (self.bytes_a, self.bytes_b), strict=True):
            data, ends = strings.joined(np.concatenate(own))
            stops = np.r_[0, ends][np.cumsum([0, *map(len, own)])].tolist()
            for k, w in enumerate(want):
                if data[stops[k] : stops[k + 1]] != w:
                    want[k] = None
        none = np.empty(0, dtype=np.int64)
        return tuple([none if w is None else x for x, w in zip(own, want, strict=True)] for own in ids)

    def align(self, texts: list[str]) -> Iterator[tuple[int, int, int, str, np.ndarray]]:
        """(n_a, n_b, n_groups, groups, links) of each text."""
        ids = self.encode(texts)
        n_a, n_b = (np.array([len(x) for x in own]) for own in ids)
        a, b = (np.concatenate(own) for own in ids)
        size_a, size_b = self.bytes_a.sizes[a], self.bytes_b.sizes[b]
        ends_a, ends_b = np.cumsum(size_a), np.cumsum(size_b)
        # Both lists have the same bytes: the second's token of each byte tells where the first's start and end.
        of_byte = np.repeat(np.arange(len(b)), size_b)
        low, high = of_byte[ends_a - size_a], of_byte[ends_a - 1]
        stop_a, stop_b = np.cumsum(n_a), np.cumsum(n_b)
        has = n_a > 0
        cut_a, cut_b = common_cuts(ends_a, ends_b, (stop_a - n_a)[has], stop_a[has], (stop_b - n_b)[has], stop_b[has], high)
        # each token's place in the written groups: after the tokens of its own list and those of the other list's groups before
        in_a, in_b = (np.repeat(np.arange(len(c)), np.diff(c, prepend=0)) for c in (cut_a, cut_b))
        closes_a, closes_b = (np.r_[x[1:] != x[:-1], True] if len(x) else np.empty(0, bool) for x in (in_a, in_b))
        out = np.empty(len(a) + len(b), dtype=np.int64)
        before = np.r_[0, cut_b]
        out[np.arange(len(a)) + before[in_a]] = a * 2 + closes_a
        out[np.arange(len(b)) + cut_a[in_b]] = (len(self.bytes_a.sizes) + b) * 2 + closes_b
        numbers, ends = self.numbers.joined(out)
        ends = np.r_[0, ends][np.r_[0, stop_a + stop_b]].tolist()
        # links: a token meets those of the other list from the one its start lies in to the one its end lies in
        met = high - low + 1
        offset = np.cumsum(met) - met
        partner = np.arange(met.sum()) - np.repeat(offset, met) + np.repeat(low, met)
        links = (np.repeat(a, met) * len(self.bytes_b.sizes) + b[partner]).astype(np.int64)
        stops = np.r_[0, np.cumsum(met)]
        groups = np.searchsorted(cut_a, stop_a, "right")
        for k in range(len(texts)):
            text = numbers[ends[k] : max(ends[k], ends[k + 1] - 1)].decode()
            yield int(n_a[k]), int(n_b[k]), int(groups[k] - (groups[k - 1] if k else 0)), text, links[stops[stop_a[k] - n_a[k]] : stops[stop_a[k]]]


def align(df: DataFrame, ranks_path: str, pattern: str, model_path: str, key: str = "doc_id", text: str = "text", table_entries: int = 1 << 18) -> DataFrame:
    """One row per row of ``df``: ``key``, n_a, n_b, n_groups, groups
    ("a1,a2|b1;a3|b2,b3") and links (array of id_a * pieces + id_b, one for each link).

    Texts that are null or empty, or whose tokens of either list do not join to a
    blank and the text (a marker character in it, for one), have no tokens: zeros, an empty
    string and no links. Null and repeated keys stay as they are; other columns are left out."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(ranks_path, pattern, model_path, table_entries)
        for batch in batches:
            at, size, sizes = 0, 0, [len(t.as_buffer()) if t.is_valid else 0 for t in batch.column(1)]
            for k, n in enumerate([*sizes, None]):
                if k > at and (n is None or k - at == TEXTS or size + n > 1 << 22):  # at most 4 MB of texts together, or one text
                    rows = list(aligner.align(batch.column(1)[at:k].to_pylist()))
                    links = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(r[4]) for r in rows)]), pa.int32()), pa.array(np.concatenate([r[4] for r in rows]).astype(np.int64)))
                    yield pa.RecordBatch.from_arrays([batch.column(0)[at:k], *(pa.array([r[c] for r in rows], pa.int64()) for c in range(3)), pa.array([r[3] for r in rows], pa.string()), links], names=["key", "n_a", "n_b", "n_groups", "groups", "links"])
                    at, size = k, 0
                size += n or 0

    docs = df.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    return docs.mapInArrow(run, f"key {kind}, n_a long, n_b long, n_groups long, groups string, links array<long>").withColumnRenamed("key", key)


def pair_counts(aligned: DataFrame, pieces: int) -> DataFrame:
    """(pair, n, best) of every id pair linked anywhere: its links in all rows, and whether no
    other pair of its second id has more."""
    counts = aligned.select(F.explode("links").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    return counts.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy(F.col("pair") % pieces)))


def frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, n, best) of the most frequent pairs, ``most`` or fewer, by pair."""
    step = F.floor(F.log2("n") * 8)
    total, least = 0, None
    for r in sorted(counts.groupBy(step.alias("step")).agg(F.count("*").alias("pairs")).collect(), key=lambda r: -r.step):  # at most 8 a doubling
        total += r.pairs
        if total > most:
            break
        least = r.step
    found = counts.filter(step >= least if least is not None else F.lit(False)).toArrow()
    order = np.argsort(found.column("pair").to_numpy())
    return tuple(found.column(c).to_numpy(zero_copy_only=False)[order] for c in ("pair", "n", "best"))


def count_links(aligned: DataFrame, counts: DataFrame, common_pairs: int = 1 << 20) -> DataFrame:
    """``aligned`` with n_links, n_best (links whose pair is ``best``) and count_sum
    (the corpus counts of its links added up) for its links. ``aligned`` should be a written table:
    its rows are numbered here."""
    sc = aligned.sparkSession.sparkContext
    common = sc.broadcast(frequent(counts, common_pairs))
    rest = [f for f in aligned.schema.fields if f.name != "links"]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pairs, n, best = common.value
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                column = part.column(len(rest))
                links, stops = column.flatten().to_numpy(), np.r_[0, np.cumsum(column.value_lengths().to_numpy())]
                i = np.minimum(np.searchsorted(pairs, links), max(0, len(pairs) - 1))
                known = pairs[i] == links if len(pairs) else np.zeros(len(links), bool)
                add = lambda x: np.diff(np.r_[0, np.cumsum(x)][stops])
                i = i[known]
                counted, is_best = np.zeros(len(links), np.int64), np.zeros(len(links), np.int64)
                counted[known], is_best[known] = n[i], best[i]
                rare = np.flatnonzero(~known)
                rare_stops = np.searchsorted(rare, stops)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in range(len(rest))), pa.array(np.arange(row, row + part.num_rows)), pa.array(np.diff(stops)), pa.array(add(is_best)), pa.array(add(counted)),
                     pa.ListArray.from_arrays(pa.array(rare_stops, pa.int32()), pa.array(links[rare]))],
                    names=[*(f.name for f in rest), "__row", "n_links", "n_best", "count_sum", "__rare"],
                )
                row += part.num_rows

    # A row holds all links of its text: batches of Spark's own length take more than the texts themselves.
    with small_batches(aligned.sparkSession):
        found = written(aligned.select(*[F.col(f"`{f.name}`") for f in rest], "links").mapInArrow(run, f"{kinds}, __row long, n_links long, n_best long, count_sum long, __rare array<long>"), "counted")
    rare = found.select("__row", F.explode("__rare").alias("pair")).join(counts, "pair").groupBy("__row").agg(F.count_if("best").alias("b"), F.sum("n").alias("s"))
    zero = F.lit(0)
    return found.drop("__rare").join(rare, "__row", "left").withColumns({"n_best": F.col("n_best") + F.coalesce("b", zero), "count_sum": F.col("count_sum") + F.coalesce("s", zero)}).drop("__row", "b", "s")
