import glob
import random
import re
from collections import Counter

import pyarrow.parquet as pq
import pytest

from tasador.llm import collocations as C


def brute(rows, max_words, least, covered, top):
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            ws = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, max_words + 1):
                f.update((lang, *ws[i : i + k]) for i in range(len(ws) - k + 1))
    candidates = {g: a for g, a in f.items() if len(g) > 2 and a >= least}
    out = []
    for g, a in candidates.items():
        ws = g[1:]
        if any(len(h) > len(g) and h[0] == g[0] and 100 * b >= covered * a and any(h[1 + i : 1 + i + len(ws)] == ws for i in range(len(h) - len(ws))) for h, b in candidates.items()):
            continue
        score, k, left, right = min((1000000 * a * a // (f[g[: 1 + k]] * f[(g[0], *ws[k:])]), k, f[g[: 1 + k]], f[(g[0], *ws[k:])]) for k in range(1, len(ws)))
        out.append((g[0], " ".join(ws), a, left, right, n[g[0]], score))
    ranked, place = [], Counter()
    for r in sorted(out, key=lambda r: (r[0], -r[6], -r[2], r[1].encode())):
        place[r[0]] += 1
        if place[r[0]] <= top:
            ranked.append((r[0], place[r[0]], *r[1:]))
    return ranked


def rows():
    rng = random.Random(5)
    words = ["New", "york", "City", "é", "漢", "a", "b", "the", "x-y", "\x01", "z"]
    out = []
    for k in range(120):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", ";;", "\r", "\x0b!"]) for _ in range(rng.randrange(60)))
        out.append((rng.choice(["en", "en", "de", None]), text))
    out += [("en", None), ("en", ""), ("en", " .,\n"), ("fr", "solo"), ("en", "new york city " * 3000), *out[:5]]
    return out


@pytest.mark.parametrize("chunk_words,max_words,top,bucket_words", [(1 << 21, 3, 2000, 1 << 19), (200, 3, 7, 500), (600, 4, 40, 2000), (400, 2, 2000, 5000)])
def test_against_brute_force(spark, monkeypatch, chunk_words, max_words, top, bucket_words):
    monkeypatch.setattr(C, "BUCKET_WORDS", bucket_words)
    docs = spark.createDataFrame([(k, *r, "c", 1) for k, r in enumerate(rows())], "doc_id long, lang string, text string, phrase string, n int").repartition(3)
    got = C.collocations(docs, max_words=max_words, least=4, covered=50, top=top, chunk_words=chunk_words).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows(), max_words, 4, 50, top))


def test_products_beyond_64_bits(spark):
    big = 10**14
    df = spark.createDataFrame([(big - 1, big, big + 1), (10**14, 10**17, 10**17), (3, 7, 5)], "a long, l long, r long")
    got = [int(x[0]) for x in df.select(C.exact_score(df.a, df.l, df.r)).collect()]
    assert got == [1000000 * a * a // (left * right) for a, left, right in ((big - 1, big, big + 1), (10**14, 10**17, 10**17), (3, 7, 5))]


def test_runs_cut_between_pieces():
    data = b"aaaa bbbb\xffcc\xff" * 40
    parts = list(C.runs(data, 1))
    assert len(parts) > 10 and b"\xff".join(parts) == data
    assert list(C.runs(b"x" * 100, 1)) == [b"x" * 100] and list(C.runs(b"", 1)) == [b""]


def test_few_chunks_are_held_at_once(spark, monkeypatch):
    """Groups of rows of a file, Arrow batches and batches of the file's reader hold few chunks; settings are as before in the end."""
    seen, write, names = {}, C.written, list(C.FEW_CHUNKS)
    before = [spark.conf.get(x) for x in names]

    def spy(df, name, **options):
        inside = [spark.conf.get(x) for x in names]
        seen[name] = write(df, name, **options), inside
        return seen[name][0]

    monkeypatch.setattr(C, "written", spy)
    monkeypatch.setattr(C, "discard", lambda table: None)
    monkeypatch.setattr(C, "LARGE_ROWS", C.LARGE_ROWS | {"parquet.block.size": 1 << 10})
    docs = spark.createDataFrame(rows(), "lang string, text string").coalesce(1)
    C.collocations(docs, least=4, chunk_words=200)
    for name in ("occurrences", "relation1", "relation2"):
        files = [pq.ParquetFile(f) for f in glob.glob(seen[name][0].written_path.removeprefix("file:") + "/*.parquet")]
        assert sum(f.metadata.num_rows for f in files) > 5
        assert all(f.metadata.row_group(k).num_rows == 1 for f in files for k in range(f.num_row_groups))
    assert all(seen[x][1] == list(C.FEW_CHUNKS.values()) for x in ("words", "relation1", "relation2", "kept2", "kept3"))
    assert [spark.conf.get(x) for x in names] == before


def test_empty_table(spark):
    assert C.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0
