"""Hierarchical multi-length packing.

Documents are tokenised and routed to context-size tiers (2048, 1024, 512, 256
by default): whole windows of the longest tier are cut off first, the rest goes
to the smallest tier that holds it. Each tier is packed in turn, from the longest: a piece opens
a window of its tier and the gap is filled from the shorter tiers, by the
longest pieces that fit, the last one cut to fit exactly (then from its own
tier). Windows are dealt into step groups of equal token counts, all of one
tier, in snake order of their attention cost, so that groups cost alike.

Every window but the rest of a partition is full. That rest, fewer tokens than
the longest window, goes into windows of falling powers of two, so nothing is
padded. A task packs what it reads, holding at most ``pool_tokens`` and one
batch of texts; nothing is shuffled and no group meets in one task.
"""

from __future__ import annotations

import base64
import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIERS = (2048, 1024, 512, 256)
END_ID = 1
SPECIAL = "<|endoftext|>"


@lru_cache(maxsize=2)
def load(ranks_path: str, pattern: str, special_id: int):
    """The byte-level BPE of ``byte_bpe_50k.json`` from its rank file: the same
    ids as the tokenizers library's, three times as fast (tests hold them
    against each other)."""
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={SPECIAL: special_id})


def token_ids(enc, text: str) -> np.ndarray:
    ids = enc.encode(text, allowed_special="all") if SPECIAL in text else enc.encode_ordinary(text)
    ids.append(END_ID)
    return np.array(ids, dtype="<u4")


class Piece:
    __slots__ = ("doc", "start", "ids", "total")

    def __init__(self, doc, start: int, ids: np.ndarray, total: int):
        self.doc, self.start, self.ids, self.total = doc, start, ids, total

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.start, self.ids[:n], self.total), Piece(self.doc, self.start + n, self.ids[n:], self.total)


class Packer:
    """Packs the pieces of one task. ``windows`` receives (size, pieces)."""

    def __init__(self, tiers=TIERS):
        self.tiers = tuple(sorted(tiers, reverse=True))
        self.pools: dict[int, deque[Piece]] = {t: deque() for t in self.tiers}
        self.windows: list[tuple[int, list[Piece]]] = []
        self.pooled = 0

    def route(self, piece: Piece) -> None:
        """To the smallest tier that holds the piece."""
        self.pools[next(t for t in reversed(self.tiers) if t >= len(piece.ids))].append(piece)
        self.pooled += len(piece.ids)

    def add(self, piece: Piece) -> None:
        longest = self.tiers[0]
        while len(piece.ids) >= longest:
            head, piece = piece.cut(longest)
            self.windows.append((longest, [head]))
        if len(piece.ids):
            self.route(piece)

    def take(self, gap: int, tiers: tuple[int, ...]) -> Piece | None:
        """A piece of the given tiers for a gap: from the longest tier that
        surely fits, else the shortest there is, cut to fit."""
        tier = next((t for t in tiers if t <= gap and self.pools[t]), None) or next((t for t in reversed(tiers) if self.pools[t]), None)
        if tier is None:
            return None
        piece = self.pools[tier].popleft()
        self.pooled -= len(piece.ids)
        if len(piece.ids) > gap:
            piece, rest = piece.cut(gap)
            self.route(rest)
        return piece

    def pack(self) -> None:
        """Fill windows from the pools; what cannot fill one stays pooled."""
        for k, size in enumerate(self.tiers):
            shorter, own = self.tiers[k + 1 :], (size,)
            while self.pools[size]:
                window = [self.take(size, own)]
                gap = size - len(window[0].ids)
                while gap and (piece := self.take(gap, shorter) or self.take(gap, own)):
                    window.append(piece)
                    gap -= len(piece.ids)
                if gap:
                    for piece in window:
                        self.route(piece)
                    return self.regroup()
                self.windows.append((size, window))

    def regroup(self) -> None:
        """What is left is shorter than the window it could not fill: fill the
        windows that it still can, from the longest."""
        left = [p for t in self.tiers for p in self.pools[t]]
        for pool in self.pools.values():
            pool.clear()
        self.pooled = 0
        for size in self.tiers:
            while sum(len(p.ids) for p in left) >= size:
                window, left = split(left, size)
                self.windows.append((size, window))
        for piece in left:
            self.route(piece)

    def finish(self) -> None:
        """The rest, in windows of falling powers of two."""
        self.pack()
        left = [p for t in self.tiers for p in self.pools[t]]
        while left:
            size = 1 << (sum(len(p.ids) for p in left).bit_length() - 1)
            window, left = split(left, size)
            self.windows.append((size, window))


def split(pieces: list[Piece], n: int) -> tuple[list[Piece], list[Piece]]:
    """The first n ids of the pieces, and the others."""
    head = []
    for k, piece in enumerate(pieces):
        if len(piece.ids) > n:
            a, b = piece.cut(n)
            return ([*head, a] if n else head), [b, *pieces[k + 1 :]]
        head.append(piece)
        n -= len(piece.ids)
        if not n:
            return head, pieces[k + 1 :]
    return head, []


def step_groups(sizes: np.ndarray, costs: np.ndarray, step_tokens: int) -> np.ndarray:
    """A group number for each window. A tier's windows, from the costliest,
    are dealt to its groups forth and back."""
    out = np.zeros(len(sizes), dtype=np.int64)
    first = 0
    for size in np.unique(sizes)[::-1]:
        at = np.flatnonzero(sizes == size)
        at = at[np.argsort(-costs[at], kind="stable")]
        groups = -(-len(at) * int(size) // step_tokens)
        turn, place = np.divmod(np.arange(len(at)), groups)
        out[at] = first + np.where(turn % 2 == 0, place, groups - 1 - place)
        first += groups
    return out


SCHEMA = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long"


def pack(df: DataFrame, ranks_path: str, pattern: str, special_id: int = 50256, key: str = "doc_id", text: str = "text",
         tiers=TIERS, step_tokens: int = 1 << 16, pool_tokens: int = 1 << 22) -> DataFrame:
    """One row per piece: ``key``, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, tier (the window's size) and step_group.

    A null text counts as empty: the end id alone. A null key stays null and
    repeated keys or rows are documents of their own. Other columns of ``df``
    are left out. ``sequence_id`` and ``step_group`` are unique but not dense:
    the partition's number stands in the upper bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 36
        enc, packer, done, steps = load(ranks_path, pattern, special_id), Packer(tiers), 0, 0
        kind = pa.int64()

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal done, steps
            windows, packer.windows = packer.windows, []
            if not windows:
                return
            sizes = np.array([s for s, _ in windows])
            costs = np.array([sum(len(p.ids) ** 2 for p in w) for _, w in windows], dtype=np.float64)
            group = step_groups(sizes, costs, step_tokens)
            rows = []
            for k, (size, window) in enumerate(windows):
                offset = 0
                for p in window:
                    rows.append((p.doc, p.start, len(p.ids), zlib.crc32(p.ids.tobytes()), p.total, base + done + k, offset, size, base + steps + int(group[k])))
                    offset += len(p.ids)
            done, steps = done + len(windows), steps + int(group.max()) + 1
            cols = list(zip(*rows, strict=True))
            types = [kind, *[pa.int64()] * 6, pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=[key, *(x.split()[0] for x in SCHEMA.split(", "))])

        for batch in batches:
            kind = batch.schema.field(0).type
            for doc, body in zip(batch.column(0), batch.column(1), strict=True):
                ids = token_ids(enc, body.as_py())
                packer.add(Piece(doc.as_py(), 0, ids, len(ids)))
                if packer.pooled >= pool_tokens or len(packer.windows) * packer.tiers[0] >= pool_tokens:
                    packer.pack()
                    yield from flush()
        packer.finish()
        yield from flush()

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(run, f"`{key}` {kind}, {SCHEMA}")
