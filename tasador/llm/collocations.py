"""Phrase collocations by SETM relational mining.

The occurrence relation R1 holds a row (piece, position, word) for every word,
sorted by piece and position; it is persisted as column blocks ("chunks", whole pieces, about
``chunk_words`` words each). R(k+1) is the merge join of R(k) with R1 on
the same piece and the position after the phrase: both are sorted the same way, so
a chunk joins with itself. Each round then

1. merge-joins, giving the distinct phrases of each chunk with their counts,
2. counts the groups over all chunks: each chunk deals its phrases to buckets by a hash
   of the phrase, Spark shuffles one row a chunk and bucket, and a task counts a
   bucket (a phrase is there at most once a chunk, so a phrase in a third of
   all texts is no hot key; buckets grow in number with the corpus, not in size),
3. keeps the frequent groups and semi-joins the relation with them: the kept groups go
   back to their chunks, where rows of all others leave the relation, which is
   persisted again before the next length.

Phrases are told apart by exact keys (the id of the phrase without its last word, and that
word's id), never by hashes. Ids are given by the count, for each length anew.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, settings, small_batches, written

SEPARATORS = b".,;:!?\x0a\x0b\x0c\x0d"
END = b"\xff"  # of a piece: no byte of UTF-8
FOLD = bytes(255 if c in SEPARATORS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
BUCKET_WORDS = 1 << 19  # occurrences a bucket
BATCH_BYTES = {"spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}
#: A chunk is a row of many MB: readers and Arrow batches take few of them at once, and files have groups
#: of few, whose size the writer looks at after each row (else after 100, which it holds until then).
FEW_CHUNKS = BATCH_BYTES | {"spark.sql.parquet.columnarReaderBatchSize": "4"}
LARGE_ROWS = {"parquet.block.size": 16 << 20, "parquet.page.size.row.check.min": 1}


class Words(dict):
    """The words of one language in one chunk -> their numbers, which all languages share."""

    def __init__(self, lang: str, found: list[tuple[str, bytes]]):
        super().__init__({END: -1})
        self.lang, self.found = lang, found

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.found)
        self.found.append((self.lang, word))
        return n


def occurrences(df: DataFrame, text: str, lang: str, chunk_words: int) -> DataFrame:
    """R1 as chunks: (chunk, langs, totals, of, words, ns, ids), the languages with
    their numbers of words, the distinct words with their language's place in langs and their counts, and
    the number of each occurrence's word in order, -1 after each piece. A text longer than
    a chunk is cut between pieces, a longer piece makes a longer chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 36
        found: list[tuple[str, bytes]] = []
        tables: dict[str, Words] = {}
        parts: list[np.ndarray] = []
        size = 0

        def out() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            ns = np.bincount(ids[ids >= 0], minlength=len(found))
            langs = {x: k for k, x in enumerate(tables)}
            of = np.array([langs[x] for x, _ in found], dtype=np.int32)
            totals = np.bincount(of, weights=ns, minlength=len(langs)).astype(np.int64)
            row = {"chunk": (chunk, pa.int64()), "langs": (list(langs), pa.list_(pa.string())), "totals": (totals, pa.list_(pa.int64())), "of": (of, pa.list_(pa.int32())),
                   "words": ([w for _, w in found], pa.list_(pa.binary())), "ns": (ns.astype(np.int32), pa.list_(pa.int32())), "ids": (ids.tobytes(), pa.binary())}
            return pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in row.values()], names=list(row))

        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                data = text.as_py().translate(FOLD)
                for piece_run in runs(data, chunk_words):
                    table = tables.get(lang) or tables.setdefault(lang, Words(lang, found))
                    words = piece_run.replace(END, b" \xff ").split()
                    words.append(END)
                    parts.append(np.fromiter(map(table.__getitem__, words), dtype=np.int32, count=len(words)))
                    size += len(words)
                    if size >= chunk_words:
                        yield out()
                        chunk, size = chunk + 1, 0
                        found, tables, parts = [], {}, []
        if size:
            yield out()

    docs = df.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"), F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"))
    return docs.mapInArrow(run, "chunk long, langs array<string>, totals array<long>, of array<int>, words array<binary>, ns array<int>, ids binary")


def runs(data: bytes, chunk_words: int) -> Iterator[bytes]:
    """A text in runs of whole pieces, of about ``8 * chunk_words`` bytes at most unless a piece is longer."""
    at, most = 0, 8 * chunk_words
    while len(data) - at > most:
        cut = data.find(END, at + most)
        if cut < 0:
            break
        yield data[at:cut]
        at = cut + 1
    yield data[at:] if at else data


def dealt(buckets: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The order in which a chunk's groups go to their buckets, and where each bucket begins."""
    order = np.argsort(buckets, kind="stable")
    return order, np.searchsorted(buckets[order], np.arange(most + 1))


def packed(chunk: int, buckets: np.ndarray, most: int, n: np.ndarray, keys: dict[str, pa.Array]) -> pa.RecordBatch:
    """A row (bucket, chunk, n, *keys) of lists for each bucket that the chunk has groups for."""
    order, begins = dealt(buckets, most)
    used = np.flatnonzero(np.diff(begins))
    offsets = pa.array(np.r_[begins[used], len(order)], pa.int32())
    lists = {name: pa.ListArray.from_arrays(offsets, x.take(pa.array(order))) for name, x in {"n": pa.array(n, pa.int32()), **keys}.items()}
    return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(np.full(len(used), chunk)), *lists.values()], names=["bucket", "chunk", *lists])


def count_groups(rows: DataFrame, least: int) -> DataFrame:
    """Of ``rows`` (bucket, chunk, n, *keys) the groups with at least ``least`` occurrences, twice: a
    row without a chunk for each bucket, with the groups' gid, f (all occurrences) and keys, and
    a row for each bucket and chunk, with the places (in the chunk's list) and gids of those it holds."""
    keys = [f for f in rows.schema.fields if f.name not in ("bucket", "chunk", "n")]

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        column = lambda name: table.column(name).combine_chunks()
        sizes = column("n").value_lengths().to_numpy()
        values = {f.name: column(f.name).flatten() for f in keys}
        code = np.zeros(int(sizes.sum()), dtype=np.int64)
        for x in values.values():
            x = x.dictionary_encode()
            code = code * max(1, len(x.dictionary)) + x.indices.to_numpy()
        _, first, group = np.unique(code, return_index=True, return_inverse=True)
        f = np.bincount(group, weights=column("n").flatten().to_numpy()).astype(np.int64)
        often = f >= least
        gid = np.where(often, (table.column("bucket")[0].as_py() << 32) + np.cumsum(often) - 1, -1)
        ends = np.cumsum(sizes)
        mine = np.flatnonzero(often[group])
        place = mine - np.repeat(ends - sizes, sizes)[mine]
        one = lambda x, kind: pa.array([x], pa.list_(kind))
        lists = lambda x, kind: pa.ListArray.from_arrays(pa.array(np.r_[0, np.searchsorted(mine, ends)], pa.int32()), pa.array(x, kind))
        chosen = pa.array(first[often])
        bucket = table.column("bucket").combine_chunks()
        groups = [bucket[:1], pa.nulls(1, pa.int64()), one([], pa.int32()), one(gid[often], pa.int64()), one(f[often], pa.int64()), *(pa.ListArray.from_arrays(pa.array([0, len(chosen)], pa.int32()), x.take(chosen)) for x in values.values())]
        marks = [bucket, column("chunk"), lists(place, pa.int32()), lists(gid[group[mine]], pa.int64()), *(pa.nulls(len(sizes), x.type) for x in groups[4:])]
        return pa.concat_tables([pa.table(x, names=["bucket", "chunk", "place", "gid", "f", *values]) for x in (groups, marks)])

    schema = ", ".join(["bucket int, chunk long, place array<int>, gid array<long>, f array<long>", *(f"{f.name} {f.dataType.simpleString()}" for f in keys)])
    return rows.groupBy("bucket").applyInArrow(run, schema)


def groups(kept: DataFrame, *keys: str) -> DataFrame:
    """(gid, f, *keys): one row a group."""
    return kept.filter(F.col("chunk").isNull()).select(F.explode(F.arrays_zip("gid", "f", *keys)).alias("r")).select("r.*")


def word_groups(r1: DataFrame, buckets: int) -> DataFrame:
    """(bucket, chunk, n, lang, word): the distinct words of each chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunk, langs, of, words, n = (batch.column(c)[row] for c in range(5))
                langs, of, words = langs.values, of.values, words.values
                bucket = word_buckets(words, langs.to_pylist(), of.to_numpy(), buckets)
                yield packed(chunk.as_py(), bucket, buckets, n.values.to_numpy(), {"lang": langs.take(of), "word": words})

    return r1.select("chunk", "langs", "of", "words", "ns").mapInArrow(run, "bucket int, chunk long, n array<int>, lang array<string>, word array<binary>")


def word_buckets(words: pa.Array, langs: list[str], of: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each of a chunk's words, by a hash of language and word."""
    seeds = [zlib.crc32(x.encode()) for x in langs]
    return np.fromiter((zlib.crc32(w, seeds[k]) for w, k in zip(words.to_pylist(), of.tolist(), strict=True)), dtype=np.uint32, count=len(of)) % buckets


def merge_join(group: np.ndarray, word: np.ndarray, k: int, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """R(k) with R1 at the next position: (places, keys) of the joined rows. ``group``
    numbers the k-word phrase at each place, ``word`` the word, of ``n_words`` different ones; -1 is
    none, as at the end of a piece, so no phrase runs on into another piece. A key is group * n_words + word."""
    at = np.flatnonzero((group[: len(group) - k] >= 0) & (word[k:] >= 0))
    return at, group[at].astype(np.int64) * n_words + word[at + k]


#: A chunk of R(k): the numbers of the word and of the phrase at each place, and the ids that the
#: chunk's numbers stand for; R1 has no phrases besides its words.
RELATION = "chunk long, word binary, wids binary, grp binary, gids binary"


def as_rows(chunk: int, word: np.ndarray, wids: np.ndarray, group: np.ndarray | None = None, gids: np.ndarray | None = None) -> pa.Table:
    rows = {"chunk": pa.array([chunk], pa.int64())}
    return pa.table(rows | {n: pa.array([x if x is None else x.tobytes()], pa.binary()) for n, x in (("word", word), ("wids", wids), ("grp", group), ("gids", gids))})


def from_row(word, wids, grp, gids) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    read = lambda x, kind: np.frombuffer(x.as_buffer(), dtype=kind)
    word, wids = read(word, np.int32), read(wids, np.int64)
    return (word, wids, read(grp, np.int32), read(gids, np.int64)) if grp.is_valid else (word, wids, word, wids)


def local_groups(word: np.ndarray, wids: np.ndarray, group: np.ndarray, gids: np.ndarray, k: int, buckets: int):
    """Of a chunk's R(k + 1): (places, the distinct phrase at each, the phrases' counts, groups, words and buckets)."""
    at, keys = merge_join(group, word, k, len(wids))
    keys, no, n = np.unique(keys, return_inverse=True, return_counts=True)
    g, w = (x[i] for x, i in zip((gids, wids), np.divmod(keys, max(1, len(wids))), strict=True))
    mixed = (g.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (w.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    return at, no, n, g, w, ((mixed ^ mixed >> np.uint64(29)) * np.uint64(0x165667B19E3779F9) >> np.uint64(32)) % np.uint64(buckets)


def extend(relation: DataFrame, k: int, buckets: int) -> DataFrame:
    """(bucket, chunk, n, g, w): the distinct phrases of k + 1 words of each chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                parts = from_row(*(batch.column(c)[row] for c in range(1, 5)))
                _, _, n, g, w, bucket = local_groups(*parts, k, buckets)
                yield packed(batch.column(0)[row].as_py(), bucket.astype(np.int64), buckets, n, {"g": pa.array(g), "w": pa.array(w)})

    return relation.mapInArrow(run, "bucket int, chunk long, n array<int>, g array<long>, w array<long>")


def renumber(numbers: np.ndarray, buckets: np.ndarray, most: int, own: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of a chunk's groups (-1: none) as numbers of the frequent ones among them, and the
    ids of these. ``buckets`` has each group's bucket, ``own`` the kept places by bucket."""
    order, begins = dealt(buckets, most)
    own = own.combine_chunks()
    places = own.column("place").combine_chunks()
    at = begins[np.repeat(own.column("bucket").to_numpy(), places.value_lengths().to_numpy())] + places.flatten().to_numpy()
    table = np.full(len(buckets) + 1, -1, dtype=np.int32)
    table[order[at]] = np.arange(len(at))
    return table[numbers], own.column("gid").combine_chunks().flatten().to_numpy()  # -1 reads the last entry, which is -1


def semi_join(relation: DataFrame, kept: DataFrame, parts: int, run) -> DataFrame:
    """The relation's chunks, each with the frequent groups that it holds. Dealt to
    a given number of partitions, which Spark leaves as they are: a chunk is large for a row."""
    own = kept.filter(F.col("chunk").isNotNull()).select(F.col("chunk").alias("chunk"), "bucket", "place", "gid")
    return relation.repartition(parts, "chunk").groupBy("chunk").cogroup(own.repartition(parts, "chunk").groupBy("chunk")).applyInArrow(run, RELATION)


def first_relation(r1: DataFrame, kept: DataFrame, buckets: int, parts: int) -> DataFrame:
    """R1 with the frequent words only."""

    def run(rows: pa.Table, own: pa.Table) -> pa.Table:
        ids = np.frombuffer(rows.column("ids")[0].as_buffer(), dtype=np.int32)
        places = word_buckets(rows.column("words")[0].values, rows.column("langs")[0].as_py(), rows.column("of")[0].values.to_numpy(), buckets)
        return as_rows(rows.column("chunk")[0].as_py(), *renumber(ids, places, buckets, own))

    return semi_join(r1.select("chunk", "langs", "of", "words", "ids"), kept, parts, run)


def next_relation(relation: DataFrame, kept: DataFrame, k: int, buckets: int, parts: int) -> DataFrame:
    """R(k + 1) with the frequent phrases only."""

    def run(rows: pa.Table, own: pa.Table) -> pa.Table:
        word, wids, group, gids = from_row(*(rows.column(c)[0] for c in ("word", "wids", "grp", "gids")))
        at, no, *_, places = local_groups(word, wids, group, gids, k, buckets)
        out = np.full(len(word), -1, dtype=np.int32)
        out[at], ids = renumber(no, places.astype(np.int64), buckets, own)
        return as_rows(rows.column("chunk")[0].as_py(), word, wids, out, ids)

    return semi_join(relation, kept, parts, run)


def exact_score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)) in decimals of 38 digits."""
    wide = lambda c, digits: c.cast(f"decimal({digits},0)")
    whole = (wide(F.lit(1000000), 7) * wide(a, 15)) * wide(a, 15)
    return F.call_function("div", whole, wide(left, 18) * wide(right, 18))


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", max_words: int = 3, least: int = 10, covered: int = 50, top: int = 2000, chunk_words: int = 1 << 20) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` collocations
    of 2 to ``max_words`` words, ties by a falling, then phrase rising in UTF-8 order.

    Texts (null: empty) are lower-cased (A-Z) and split at ``.,;:!?`` and line ends into pieces,
    those at blanks and tabs into words; a null language counts as "und". Phrases with a >=
    ``least`` occurrences within pieces (overlaps count) are candidates. l and r
    count the two parts of a candidate at its lowest-scoring cut, ties to the shortest first part. A
    candidate goes if a longer one holds it and has at least ``covered`` % of its occurrences. n
    counts the language's words. Counts must be below 10**15 a phrase. Repeated rows count each; other columns are left out; an
    empty table gives no rows."""
    spark = df.sparkSession
    with small_batches(spark), settings(spark, BATCH_BYTES):
        r1 = written(occurrences(df, text, lang, chunk_words), "occurrences", **LARGE_ROWS)
    sizes = written(r1.select(F.explode(F.arrays_zip("langs", "totals")).alias("r")).groupBy(F.col("r.langs").alias("lang")).agg(F.sum("r.totals").alias("n")), "sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    buckets, parts = 1 + total // BUCKET_WORDS, 1 + total // chunk_words
    with settings(spark, FEW_CHUNKS):
        kept = written(count_groups(word_groups(r1, buckets), least), "words", **LARGE_ROWS)
    names = written(groups(kept, "lang", "word"), "names")
    levels = [names.select("gid", F.array("gid").alias("words"), "f")]
    relation = None
    for k in range(1, max_words):
        with settings(spark, FEW_CHUNKS):
            if k == 1:
                relation = written(first_relation(r1, kept, buckets, parts), "relation1", **LARGE_ROWS)
                discard(r1)
            else:
                shorter, relation = relation, written(next_relation(relation, kept, k - 1, buckets, parts), f"relation{k}", **LARGE_ROWS)
                discard(shorter)
            discard(kept)  # its groups are in ``names`` or ``levels``, its marks in the relation
            kept = written(count_groups(extend(relation, k, buckets), least), f"kept{k + 1}", **LARGE_ROWS)
        shorter = levels[-1].select(F.col("gid").alias("g"), "words")
        found = groups(kept, "g", "w").join(shorter, "g").select("gid", F.concat("words", F.array("w")).alias("words"), "f")
        levels.append(written(found, f"phrases{k + 1}"))
    every, candidates = levels[0], levels[1] if max_words > 1 else levels[0].limit(0)
    for level in levels[1:]:
        every = every.unionByName(level)
    for level in levels[2:]:
        candidates = candidates.unionByName(level)
    size = F.size("words")
    inside = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.slice("words", i, n)))))
    longer = candidates.filter(size > 2).select(F.col("f").alias("g"), inside.alias("words")).groupBy("words").agg(F.max("g").alias("longer"))
    left_over = candidates.join(longer, "words", "left").filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("f") * covered))
    cuts = left_over.select("words", "f", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("words", "f", "k", F.expr("slice(words, 1, k)").alias("first"), F.expr("slice(words, k + 1, size(words) - k)").alias("rest"))
    cuts = cuts.join(every.select(F.col("words").alias("first"), F.col("f").alias("l")), "first").join(every.select(F.col("words").alias("rest"), F.col("f").alias("r")), "rest")
    scored = cuts.select("words", "f", F.struct(exact_score(F.col("f"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r").alias("cut"))
    scored = scored.groupBy("words", "f").agg(F.min("cut").alias("cut"))
    # the words' texts, which also tell the language; only what may be ranked is spelt out
    names = names.select(F.col("gid").alias("wid"), "lang", "word")
    best = scored.select(F.col("f").alias("a"), "cut", F.element_at("words", 1).alias("wid"), "words").join(names.select("wid", "lang"), "wid")
    # ties on (score, a) at the cut are settled by the phrase, so all of them stay until it is known
    w = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"))
    best = best.select("lang", "a", "cut", "words", F.rank().over(w).alias("place")).filter(F.col("place") <= top)
    spelt = best.select("words", F.posexplode("words").alias("i", "wid")).join(names.select("wid", "word"), "wid").groupBy("words").agg(F.array_sort(F.collect_list(F.struct("i", F.col("word").cast("string").alias("word")))).alias("ws"))
    out = best.join(spelt, "words").join(sizes, "lang").select("lang", F.array_join(F.col("ws.word"), " ").alias("phrase"), "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return out.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
