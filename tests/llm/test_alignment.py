import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import sentencepiece
from tokenizers import Tokenizer

from tasador.llm import alignment as A
from tasador.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
FILES = (P.path("byte_bpe_50k.tiktoken"), P.PATTERN, P.path("piece_bpe_32k.model"))


def byte_table():
    """The byte-level alphabet: printable bytes stand for themselves, the others for 256, 257, ..."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in keep]
    return {chr(b): b for b in keep} | {chr(256 + k): b for k, b in enumerate(rest)}


class Brute:
    """Both encodings by the libraries' own files, groups and links by comparing byte ranges."""

    def __init__(self):
        self.a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
        self.table = byte_table()

    def piece(self, i):
        p = self.b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") and i < 259 else p.replace("▁", " ").encode()

    def tokens(self, text):
        if not text:
            return [], []
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        a = [(i, bytes(self.table[c] for c in self.a.id_to_token(i))) for i in a]
        b = [(i, self.piece(i)) for i in self.b.encode(text)]
        want = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == want == b"".join(x for _, x in b) else ([], [])

    def document(self, text):
        a, b = self.tokens(text)
        spans = []
        for side in (a, b):
            at, out = 0, []
            for i, x in side:
                out.append((i, at, at + len(x)))
                at += len(x)
            spans.append(out)
        cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, s, _ in side if low <= s < cut) for side in spans))
            low = cut
        links, j = [], 0
        for i, s, e in spans[0]:
            while spans[1][j][2] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][1] < e:
                links.append((i, spans[1][k][0]))
                k += 1
        return len(a), len(b), len(groups), ";".join(groups), links


def want(texts):
    brute = Brute()
    docs = [brute.document(t) for t in texts]
    n = Counter(p for d in docs for p in d[4])
    best = defaultdict(int)
    for (_, b), c in n.items():
        best[b] = max(best[b], c)
    return [(*d[:4], len(d[4]), sum(n[p] == best[p[1]] for p in d[4]), sum(n[p] for p in d[4])) for d in docs]


def texts():
    rng = random.Random(3)
    letters = [*" \n\tabcdefé▁漢🙂\x00　 <s>0x'", "\r\n", "  ", "<|endoftext|>", "<0x41>", " the", "ing "]
    return [None, "", " ", "a", "▁", "word " * 400, "漢" * 300, "<|endoftext|>", "tion" * 900] + ["".join(rng.choices(letters, k=rng.randrange(80))) for _ in range(300)]


def run(docs, common):
    aligned = A.written(A.align(docs, *FILES), "aligned")
    return A.count_links(aligned, A.pair_counts(aligned, 32000), common)


def test_against_brute_force(spark):
    rows = [(None if k == 4 else k % 200, t, "clash", 5) for k, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, links string, n_a int").repartition(4)
    expected = Counter((r[0], *w) for r, w in zip(rows, want([r[1] for r in rows]), strict=True))
    for common in (0, 40, 1 << 20):
        got = run(docs, common).select("doc_id", "n_a", "n_b", "n_groups", "groups", "n_links", "n_best", "count_sum").collect()
        assert Counter(map(tuple, got)) == expected
    assert run(docs.limit(0), 10).count() == 0


def test_cuts_of_any_shape():
    rng = np.random.default_rng(1)
    for n, shared in [(1, 0), (2, 1), (50, 0), (50, 3), (3000, 1), (3000, 2900), (400, 17)]:
        inner = rng.permutation(4 * n)[: 2 * n] + 1
        a, b = np.sort(np.r_[inner[:n], 4 * n + 9]), np.sort(np.r_[inner[n - shared : 2 * n - shared], 4 * n + 9])
        cuts = np.intersect1d(a, b)
        one = lambda x: np.array([x])
        got = A.common_cuts(a, b, one(0), one(len(a)), one(0), one(len(b)))
        assert (a[got[0] - 1] == cuts).all() and (b[got[1] - 1] == cuts).all() and len(got[0]) == len(cuts)
    corner = np.r_[np.arange(1, 100), np.arange(200, 4000, 2), 9000]  # shared cuts in one corner only
    other = np.r_[np.arange(1, 100), np.arange(201, 4000, 2), 9000]
    got = A.common_cuts(corner, other, one(0), one(len(corner)), one(0), one(len(other)))
    assert corner[got[0] - 1].tolist() == [*range(1, 100), 9000]


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    expected = {d.doc_id: (w[0], w[1], w[2], *w[4:], hashlib.sha256(w[3].encode()).hexdigest() if w[0] else "") for d, w in zip(docs, want([d.text for d in docs]), strict=True)}
    got = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in QUERIES["op12_alignment"](spark, SF).collect()}
    assert got == expected


def test_rows_with_all_their_links_come_in_small_batches(spark, monkeypatch):
    # Before, 10,000 rows with the links of their texts came at once.
    from tasador.llm import alignment, queries

    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", {}
    before = spark.conf.get(name)
    for module in (alignment, queries):
        monkeypatch.setattr(module, "written", lambda df, table, write=module.written: seen.update({table: int(spark.conf.get(name))}) or write(df, table))
    assert queries.op12(spark, "/root/testdata/sf0.001").count()
    assert seen["aligned"] <= 1024 and seen["counted"] <= 1024 and spark.conf.get(name) == before


def test_bytes_and_groups_are_joined_for_all_texts_together(monkeypatch):
    # Before, each text's tokens were joined one by one, three times.
    import public_tokenizers
    a = A.Aligner(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model"), 1 << 10)
    texts = ["", "Hello  wide world", "caf\u00e9 \u2581 mark", "caf\u00e9 <0x41> \U0001f600", "", "x"]
    joins, join = [], A.Strings.joined
    monkeypatch.setattr(A.Strings, "joined", lambda self, n: joins.append(len(n)) or join(self, n))
    got = list(a.align(texts))
    assert len(joins) == 3
    for t, (n_a, n_b, n_groups, groups, links) in zip(texts, got, strict=True):
        ids = [([int(i) for i in x.split(",")] for x in g.split("|")) for g in groups.split(";")] if groups else []
        ids = [tuple(g) for g in ids]
        assert (n_a > 0) == (bool(t) and "\u2581" not in t) and n_groups == len(ids) and len(links) >= max(n_a, n_b)
        want = (" " + t).encode() if n_a else b""
        assert b"".join(a.bytes_a.joined(np.array(g[0]))[0] for g in ids) == b"".join(a.bytes_b.joined(np.array(g[1]))[0] for g in ids) == want
