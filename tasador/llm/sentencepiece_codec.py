"""SentencePiece encoding and decoding by a distinct-chunk table.

The model's pieces never hold a whitespace marker after another character
(checked when the model is loaded), so no merge crosses from a word into the
marker before the next one. A text, marked (blank -> U+2581, one marker put in
front), therefore splits into chunks "markers + word" that are segmented
independently. Every task keeps a table of the distinct chunks it has met: a
chunk is segmented by the library on its first sight only, and each text's ids
are joined from the table by the chunks' positions. The table holds at most
``table_entries`` chunks and is begun anew beyond that, which costs repeated
segmentation but never changes a result, so a task's memory does not grow with
its input. Texts stay where they were read: nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
CHUNK = re.compile(f"{MARK}+[^{MARK}]*")


@lru_cache(maxsize=2)
def load(model_path: str):
    """The processor, after a check that its pieces respect the markers."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    crossing = [p for i in range(sp.get_piece_size()) if MARK in (p := sp.id_to_piece(i)).lstrip(MARK)]
    if crossing:
        raise ValueError(f"pieces cross whitespace markers: {crossing[:5]}")
    return sp


class ChunkTable(dict):
    """Distinct chunk -> its ids as int32 bytes."""

    def __init__(self, sp, entries: int):
        super().__init__()
        self.sp, self.entries = sp, entries
        self.mark_id = np.int32(sp.piece_to_id(MARK)).tobytes()

    def add(self, chunks: set[str]) -> None:
        """Segment the chunks that the table lacks. The library itself puts one
        marker in front of what it is given, so a chunk goes in without its
        first one; it leaves an empty text alone, so a single marker is looked up."""
        if len(self) + len(chunks) > self.entries:
            self.clear()
        new = [c for c in chunks if c not in self]
        for c, ids in zip(new, self.sp.encode([c[1:] for c in new], num_threads=1), strict=True):
            self[c] = np.array(ids, dtype=np.int32).tobytes() if len(c) > 1 else self.mark_id


def encode_text(table: ChunkTable, text: str) -> np.ndarray:
    if not text:
        return np.empty(0, dtype=np.int32)
    chunks = CHUNK.findall(MARK + text.replace(" ", MARK))
    table.add(set(filterfalse(table.__contains__, chunks)))
    try:
        found = b"".join(map(table.__getitem__, chunks))
    except KeyError:  # the table was begun anew for this text
        table.add(set(chunks))
        found = b"".join(map(table.__getitem__, chunks))
    return np.frombuffer(found, dtype=np.int32)


def encode_decode(df: DataFrame, model_path: str, key: str = "doc_id", text: str = "text", table_entries: int = 1 << 19) -> DataFrame:
    """One row (``key``, ids array<int>, decoded string) per row of ``df``, whose
    other columns are left out. A null text counts as empty: no ids, decoded "".
    A null or repeated key stays as it is. ``decoded`` is the library's decode of
    the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = load(model_path)
        table = ChunkTable(sp, table_entries)
        for batch in batches:
            texts = batch.column(1)
            for at in range(0, len(texts), 256):  # slices keep the lists of ids short
                ids = [encode_text(table, t.as_py()) for t in texts[at : at + 256]]
                offsets = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                decoded = [sp.decode(x.tolist()) if len(x) else "" for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[at : at + 256], pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids))), pa.array(decoded, pa.string())],
                    names=[key, "ids", "decoded"],
                )

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(run, f"`{key}` {kind}, ids array<int>, decoded string")
