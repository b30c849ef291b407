import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from tasador.llm import packing as K
from tasador.llm import sentencepiece_codec as C
from tasador.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def random_texts(extra=()):
    rng = random.Random(1)
    letters = [*" \n\tabcé▁漢🙂\x00　 <s>0x'", "\r\n", "  ", *extra]
    return ["", " ", "  ", "a", " a", "a ", "▁", "▁▁a ▁b"] + ["".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(1500)]


@pytest.mark.parametrize("entries", [1, 50, 1 << 19])
def test_chunks_give_what_the_library_gives(entries):
    sp = C.load(MODEL)
    table = C.ChunkTable(sp, entries)
    for text in random_texts():
        assert C.encode_text(table, text).tolist() == sp.encode(text), repr(text)


def test_pieces_that_cross_markers_are_refused(monkeypatch):
    import sentencepiece

    class Crossing:
        def __init__(self, **_): ...
        def get_piece_size(self):
            return 1

        def id_to_piece(self, _):
            return "a▁b"

    monkeypatch.setattr(sentencepiece, "SentencePieceProcessor", Crossing)
    C.load.cache_clear()
    with pytest.raises(ValueError):
        C.load("any")
    C.load.cache_clear()


def test_documents_and_edges(spark):
    sp = C.load(MODEL)
    texts = [None, "", "x " * 100_000, *random_texts()[:200]]
    docs = spark.createDataFrame([(None if k == 5 else k % 100, t, "clash") for k, t in enumerate(texts)], "doc_id long, text string, ids string").repartition(3)
    got = Counter((r.doc_id, tuple(r.ids), r.decoded) for r in C.encode_decode(docs, MODEL).collect())
    want = Counter((None if k == 5 else k % 100, tuple(sp.encode(t or "")), sp.decode(sp.encode(t or "")) if t else "") for k, t in enumerate(texts))
    assert got == want
    assert C.encode_decode(docs.limit(0), MODEL).count() == 0
    rows = {r.doc_id: r for r in QUERIES["op6_sentencepiece"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        ids = sp.encode(r.text)
        assert rows[r.doc_id].n_tokens == len(ids) and rows[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[r.doc_id].decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def test_token_ids_are_those_of_the_tokenizers_library():
    from tokenizers import Tokenizer

    theirs = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    enc = K.load(RANKS, PATTERN, 50256)
    for text in random_texts(["<|endoftext|>", " <|endoftext|> ", "'s", "ll"]):
        assert K.token_ids(enc, text).tolist() == [*theirs.encode(text, add_special_tokens=False).ids, 1], repr(text)


def check_packing(docs, rows, tiers=K.TIERS):
    enc = K.load(RANKS, PATTERN, 50256)
    seqs, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append(r)
        pieces[r.doc_id].append(r)
    for window in seqs.values():
        at = 0
        for r in sorted(window, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at == window[0].tier and at <= max(tiers) and at & (at - 1) == 0  # full, or of a power of two: no padding
        assert len({(r.tier, r.step_group) for r in window}) == 1
    for doc, text in docs:
        ids, at = K.token_ids(enc, text or ""), 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].astype("<u4").tobytes())
            at += r.length
        assert at == len(ids)
    assert set(pieces) == {d for d, _ in docs}
    return seqs


def test_packing_of_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    seqs = check_packing(docs, QUERIES["op9_packing"](spark, SF).collect())
    sizes = Counter(w[0].tier for w in seqs.values())
    assert sum(n for s, n in sizes.items() if s < 256) <= 8 and {1024, 2048} <= set(sizes)


@pytest.mark.parametrize("pool", [1, 5000, 1 << 22])
def test_packing_edges(spark, pool):
    docs = [(0, None), (1, ""), (2, "x " * 60_000), (3, "short"), *((k, "word " * (k * 13 % 1700)) for k in range(4, 200)), (None, "no id")]
    df = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id long, text string, tier string").repartition(3)
    check_packing(docs, K.pack(df, RANKS, PATTERN, pool_tokens=pool).collect())
    assert K.pack(df.limit(0), RANKS, PATTERN).count() == 0


def test_step_groups_are_balanced():
    rng = np.random.default_rng(0)
    sizes, costs = rng.choice([256, 2048], 4096), rng.random(4096)
    group = K.step_groups(sizes, costs, 1 << 16)
    for size in (256, 2048):
        own = [costs[group == g] for g in np.unique(group[sizes == size])]
        assert max(map(len, own)) - min(map(len, own)) <= 1 and max(len(x) * size for x in own) <= 1 << 16
        assert max(x.mean() for x in own) < 1.1 * min(x.mean() for x in own)
    assert len(set(group[sizes == 256]) & set(group[sizes == 2048])) == 0
