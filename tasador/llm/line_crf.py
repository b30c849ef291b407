"""Quality rules: line sequence labelling by a linear-chain CRF.

Each line of a text gets features of its form (lengths, letter case, digits,
symbols, repeated words, repeated lines); Viterbi decoding of a two-label
linear-chain conditional random field marks it content or boilerplate. The share
of a text's words that stand in content lines decides whether the document stays.

The field is fitted, by gradient ascent on the conditional likelihood with
forward-backward sums, in one task on a bounded sample of labelled documents
(``sample`` a class), every line taking its document's label. Half of the training
sequences are whole documents, the others join short stretches of good and bad
documents, so that the field sees labels change within a text. The label is
noisy for a line of its own; lines of plain form are mostly seen in good
documents, so the field calls them content where their neighbours leave it open.
Documents are scored where they are read; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import utf8

BLANKS = b" \t\n\x0b\x0c\r"
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
DIGITS = b"0123456789"
SYMBOLS = b"#*$%&|<>"
ENDS = b".!?:;\"')"
PUNCTUATION = b".,;:!?()'\"-"
FEATURES = 13
SEQUENCE = 64  # lines in a training sequence; a longer text makes several


def line_features(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(features, words) of the lines of one text."""
    out, n_words, seen = np.zeros((len(lines), FEATURES)), np.zeros(len(lines)), set()
    for k, line in enumerate(lines):
        words = line.split()
        n = len(words)
        n_words[k] = n
        if not n:
            out[k, 0] = 1
            continue
        size = sum(map(len, words))
        upper, digits, symbols, marks = (size - len(b"".join(words).translate(None, x)) for x in (UPPER, DIGITS, SYMBOLS, PUNCTUATION))
        lower = size - len(b"".join(words).translate(None, LOWER))
        out[k] = (
            0,
            min(n, 50) / 50,
            np.log1p(n),
            min(size / n, 20) / 20,
            upper / (upper + lower + 1),
            digits / size,
            min(1, symbols / n),
            min(1, marks / n),
            1 - len(set(words)) / n,
            line.rstrip()[-1] in ENDS,
            line in seen,
            min(1, line.count(b"!") / n),
            min(1, sum(len(w) == 1 for w in words) / n),
        )
        seen.add(line)
    return out, n_words


def repeat_words(words: list[bytes]) -> int:
    """Words in three-word windows that are found twice or more."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    if len(number) < 1 << 20:
        windows = (ids[:-2] * len(number) + ids[1:-1]) * len(number) + ids[2:]
    else:
        pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
        windows = pairs[:-1] * len(number) + ids[2:]
    _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
    again = times[which] > 1
    covered = np.zeros(len(words), dtype=bool)
    for k in range(3):
        covered[k : len(words) - 2 + k] |= again
    return int(covered.sum())


def base_rules(text: bytes, words: list[bytes], lines: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    full = [line for line in lines if line.strip()]
    joined = b"".join(words)
    return len(words), len(joined.decode("utf-8", "replace")), len(text) - len(text.translate(None, SYMBOLS)), len(full) - len(set(full)), repeat_words(words)


def viterbi(emission: np.ndarray, transition: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The likeliest labels (0 boilerplate, 1 content); ties go to content."""
    a, b = (start + emission[0]).tolist()
    t, back = transition.tolist(), []
    for x, y in emission[1:].tolist():
        from_a, from_b = (a + t[0][0], b + t[1][0]), (a + t[0][1], b + t[1][1])
        back.append((from_a[1] >= from_a[0], from_b[1] >= from_b[0]))
        a, b = max(from_a) + x, max(from_b) + y
    label = int(b >= a)
    out = [label]
    for step in reversed(back):
        label = int(step[label])
        out.append(label)
    return np.array(out[::-1])


def logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def mixed(seqs: list[tuple[np.ndarray, np.ndarray]], seed: int = 11) -> list[tuple[np.ndarray, np.ndarray]]:
    """The lines of ``seqs`` (features, labels) once more, cut into stretches of 1 to 12 lines that are
    shuffled and joined to sequences of at most SEQUENCE lines."""
    rng = np.random.default_rng(seed)
    stretches = []
    for x, y in seqs:
        at = 0
        while at < len(x):
            end = at + int(rng.integers(1, 13))
            stretches.append((x[at:end], y[at:end]))
            at = end
    out, held = [], []
    for k in rng.permutation(len(stretches)):
        if sum(len(y) for _, y in held) + len(stretches[k][1]) > SEQUENCE:
            out.append(held)
            held = []
        held.append(stretches[k])
    return [(np.concatenate([x for x, _ in h]), np.concatenate([y for _, y in h])) for h in [*out, held] if h]


def fit(texts: list[bytes], good: list[int], rounds: int = 120, rate: float = 0.1, decay: float = 1e-3) -> dict:
    """Weights of the field: emission of either label, transitions, start; and
    the features' means and scales."""
    seqs = []
    for text, label in zip(texts, good, strict=True):
        x, _ = line_features(text.split(b"\n"))
        seqs += [(x[k : k + SEQUENCE], np.full(len(x[k : k + SEQUENCE]), label)) for k in range(0, len(x), SEQUENCE)]
    everything = np.concatenate([x for x, _ in seqs])
    mean, scale = everything.mean(0), everything.std(0) + 1e-6
    seqs += mixed(seqs)
    size, length = len(seqs), max(len(x) for x, _ in seqs)
    x, there, label = np.zeros((size, length, FEATURES + 1)), np.zeros((size, length), dtype=bool), np.zeros((size, length), dtype=np.int64)
    for k, (s, y) in enumerate(seqs):
        x[k, : len(s), :-1], x[k, : len(s), -1], there[k, : len(s)], label[k, : len(s)] = (s - mean) / scale, 1, True, y
    # a class counts as much as the other, whatever their shares of the sample; a sequence counts by its lines' mean
    share = [0.5 / max(1, (there & (label == c)).sum()) for c in (0, 1)]
    weight = np.where(label == 1, share[1], share[0])
    weight = (weight * there).sum(1) / np.maximum(1, there.sum(1))
    truth = np.eye(2)[label] * there[..., None]
    params = [np.zeros((FEATURES + 1, 2)), np.zeros((2, 2)), np.zeros(2)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, rounds + 1):
        w, t, s = params
        e = x @ w
        alpha, beta = np.zeros((size, length, 2)), np.zeros((size, length, 2))
        alpha[:, 0] = s + e[:, 0]
        for k in range(1, length):
            new = logsum(alpha[:, k - 1, :, None] + t[None], 1) + e[:, k]
            alpha[:, k] = np.where(there[:, k, None], new, alpha[:, k - 1])
        for k in range(length - 2, -1, -1):
            new = logsum(t[None] + (e[:, k + 1] + beta[:, k + 1])[:, None, :], 2)
            beta[:, k] = np.where(there[:, k + 1, None], new, 0)
        z = logsum(alpha[:, -1], 1)
        node = np.exp(alpha + beta - z[:, None, None]) * there[..., None]
        both = there[:, 1:] & there[:, :-1]
        edge = np.exp(alpha[:, :-1, :, None] + t + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None]) * both[..., None, None]
        gap = (truth - node) * weight[:, None, None]
        grads = [
            np.einsum("skf,skl->fl", x, gap),
            np.einsum("s,ska,skb->ab", weight, truth[:, :-1], truth[:, 1:]) - np.einsum("s,skab->ab", weight, edge),
            gap[:, 0].sum(0),
        ]
        for k, grad in enumerate(grads):
            grad = grad - decay * params[k]
            first[k] = 0.9 * first[k] + 0.1 * grad
            second[k] = 0.999 * second[k] + 0.001 * grad**2
            params[k] = params[k] + rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-9)
    return {"emission": params[0], "transition": params[1], "start": params[2], "mean": mean, "scale": scale}


def line_labels(model: dict | None, features: np.ndarray) -> np.ndarray:
    if model is None:
        return np.ones(len(features), dtype=np.int64)
    x = np.c_[(features - model["mean"]) / model["scale"], np.ones(len(features))]
    return viterbi(x @ model["emission"], model["transition"], model["start"])


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = 500) -> dict | None:
    """The field fitted on at most ``sample`` labelled documents of either class,
    those with the smallest hashes of their keys. Null labels and keys, and labels other
    than 0 and 1, are left out. None if a class is missing."""
    clean = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("good")).filter("k is not null and good in (0, 1)").dropDuplicates(["k"])
    chosen = [clean.filter(f"good = {c}").orderBy(F.xxhash64("k"), "k").limit(sample) for c in (0, 1)]
    ids = chosen[0].unionByName(chosen[1])
    rows = docs.select(F.col(key).alias("k"), utf8(text).alias("text")).join(F.broadcast(ids), "k")  # 2 * sample rows at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = sorted({(k, g, t) for b in batches for k, t, g in zip(*(b.column(c).to_pylist() for c in range(3)), strict=True)})
        if {g for _, g, _ in seen} == {0, 1}:
            m = fit([t for *_, t in seen], [g for _, g, _ in seen])
            yield pa.RecordBatch.from_arrays([pa.array(list(m)), pa.array([v.ravel().tolist() for v in m.values()])], names=["name", "value"])

    fitted = {r.name: np.array(r.value) for r in rows.repartition(1).mapInArrow(run, "name string, value array<double>").collect()}
    if not fitted:
        return None
    return fitted | {"emission": fitted["emission"].reshape(-1, 2), "transition": fitted["transition"].reshape(2, 2)}


SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, content_share double, line_labels array<tinyint>, kept boolean"


def quality(docs: DataFrame, model: dict | None, key: str = "doc_id", text: str = "text", min_share: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: ``key``, the base counts, base_failed,
    content_share (of the words; 1 if there is none), line_labels (1 content, 0
    boilerplate) and kept (base rules passed and content_share >= ``min_share``).

    A null text has no word and one empty line. Keys may be null or repeated.
    Without a model every line is content. Other columns are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part, rows = batch.slice(start, 512), []
                for body in part.column(1):
                    body = body.as_py()
                    lines, words = body.split(b"\n"), body.split()
                    counts = base_rules(body, words, lines)
                    failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
                    features, n = line_features(lines)
                    found = line_labels(model, features)
                    share = float(n[found == 1].sum() / n.sum()) if n.sum() else 1.0
                    rows.append((*counts, failed, share, found.tolist(), not failed and share >= min_share))
                types = [*[pa.int64()] * 5, pa.bool_(), pa.float64(), pa.list_(pa.int8()), pa.bool_()]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True))], names=[key, *(x.split()[0] for x in SCHEMA.split(", "))])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key), utf8(text)).mapInArrow(run, f"`{key}` {kind}, {SCHEMA}")
