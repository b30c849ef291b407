"""Line dedup by levelled sorted runs of line hashes.

A run is a table (key, docs, holder) sorted by ``key``, the 128-bit hash of a
line's normal form: ``docs`` counts the documents of the run's batches that hold
the line, ``holder`` is the largest document id holding it, given by the batch in
which the line was new. Batches come in falling order of document ids. Each is
hashed, reduced to one row a key, and anti-joined with the runs: a key that none
of them has is new and gets its holder; a known key only adds to the count. The
batch is then written as a run of level 0. When a level has ``fanout`` runs, they are
merged into one run of the next level, so a batch meets few runs however many
batches there have been. After the last batch the runs are merged once more.

Lines that repeat in many documents are one row a batch after the first
aggregation (Spark combines them before the shuffle), so a line in a third of all
documents costs no more than another. The texts are read twice, to hash the lines and
to drop them; only hashes and positions are shuffled before that.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_path, utf8, written


class LineRuns:
    """The levelled runs of one dedup, kept in the shared folder."""

    def __init__(self, spark: SparkSession, fanout: int = 2):
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[DataFrame]] = []

    def all(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def write(self, run: DataFrame) -> DataFrame:
        path = shared_path(self.spark, "run")
        run.repartition("key").sortWithinPartitions("key").write.parquet(path)
        return self.spark.read.schema(run.schema).parquet(path)

    @staticmethod
    def merge(runs: list[DataFrame]) -> DataFrame:
        out = runs[0]
        for run in runs[1:]:
            out = out.unionByName(run)
        return out.groupBy("key").agg(F.sum("docs").alias("docs"), F.max("holder").alias("holder")) if len(runs) > 1 else out

    def add(self, lines: DataFrame) -> None:
        """A batch: ``lines`` (key, doc). No document of it may be in the runs,
        and its ids must be below all of theirs."""
        batch = lines.groupBy("key").agg(F.countDistinct("doc").alias("docs"), F.max("doc").alias("holder"))
        known = self.all()
        if known:
            batch = written(batch, "batch")
            seen = known[0].select("key")
            for run in known[1:]:
                seen = seen.unionByName(run.select("key"))
            new = batch.join(seen.hint("merge"), "key", "left_anti").select("key", F.lit(True).alias("new"))
            batch = batch.join(new.hint("merge"), "key", "left").select("key", "docs", F.when(F.col("new"), F.col("holder")).alias("holder"))
        self.push(0, self.write(batch))

    def push(self, level: int, run: DataFrame) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            runs, self.levels[level] = self.levels[level], []
            self.push(level + 1, self.write(self.merge(runs)))

    def total(self) -> DataFrame:
        return self.merge(self.all())


def line_keys(df: DataFrame, key: str, text: str, min_chars: int) -> DataFrame:
    """(doc, pos, key) for the lines of at least ``min_chars`` code points in normal form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in batches:
            at, pos, keys = [], [], []
            for k, text in enumerate(batch.column(1)):
                for p, line in enumerate(text.as_py().split(b"\n")):
                    if len(line) >= min_chars:
                        line = line.strip().lower()  # bytes: the six ASCII blanks and A-Z only
                        if len(line) >= min_chars and (line.isascii() or len(line.decode("utf-8", "replace")) >= min_chars):
                            at.append(k)
                            pos.append(p)
                            keys.append(xxh3_128_digest(line))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(pos, pa.int32()), pa.array(keys, pa.binary())], names=["doc", "pos", "key"])

    return df.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("doc"), utf8(text).alias("text")).mapInArrow(run, "doc long, pos int, key binary")


def repeated_lines(df: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 40, min_docs: int = 5, batches: int = 4, fanout: int = 2) -> DataFrame:
    """(doc, drop): for each document that loses lines, their positions."""
    spark = df.sparkSession
    lines = written(line_keys(df, key, text, min_chars), "lines")
    cuts = lines.approxQuantile("doc", [k / batches for k in range(1, batches)], 0.01) if batches > 1 else []
    bounds = [None, *sorted({int(c) for c in cuts}, reverse=True), None]
    runs = LineRuns(spark, fanout)
    for high, low in zip(bounds, bounds[1:], strict=False):
        batch = lines
        if high is not None:
            batch = batch.filter(F.col("doc") < high)
        if low is not None:
            batch = batch.filter(F.col("doc") >= low)
        runs.add(batch)
    frequent = written(runs.total().filter(F.col("docs") >= min_docs).select("key", "holder"), "frequent")
    lost = lines.join(frequent, "key").filter(F.col("doc") != F.col("holder"))
    # repeated rows of one document have the same lines, so each position counts once
    return lost.groupBy("doc").agg(F.array_sort(F.collect_set("pos")).alias("drop"))


def dedup_lines(df: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 40, min_docs: int = 5, batches: int = 4, fanout: int = 2) -> DataFrame:
    """``df`` with ``kept_text``, ``n_lines`` (before) and ``n_dropped``.

    A text is split at \\n (null or empty: one empty line). A line whose normal
    form (stripped of ASCII blanks, A-Z lower-cased) has at least ``min_chars``
    code points and is held by at least ``min_docs`` documents goes from every
    document but the one with the largest id. Rows with one id are one document;
    rows with a null id are not counted and keep their lines. An input column
    named as a result is replaced, any other stays."""
    lost = written(repeated_lines(df, key, text, min_chars, min_docs, batches, fanout), "lost")
    drop = [c for c in df.columns if c.lower() in ("kept_text", "n_lines", "n_dropped", "__doc", "__drop")]
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)
    lost = lost.select(F.col("doc").alias("__doc"), F.col("drop").alias("__drop")).hint("merge")  # the same plan at every size
    joined = df.drop(*drop).join(lost, F.col(key) == F.col("__doc"), "left")
    kept = F.when(F.col("__drop").isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(F.array_join(F.filter(lines, lambda line, pos: ~F.array_contains("__drop", pos)), "\n"))
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns if c not in drop],
        kept.alias("kept_text"),
        (F.length(F.coalesce(F.col(text), F.lit(""))) - F.length(F.replace(F.coalesce(F.col(text), F.lit("")), F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.coalesce(F.size("__drop"), F.lit(0)).cast("long").alias("n_dropped"),
    )
