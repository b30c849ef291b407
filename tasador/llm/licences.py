"""Licence scan: Aho-Corasick finds statements, a shunting-yard parser evaluates them.

A text is lower-cased (A-Z) and cut into words of ASCII letters, digits and
characters beyond ASCII. One automaton over the words finds identifier tags,
licence names, notices and exception names in a single pass. What follows a tag on
its line is an SPDX-like expression; licence names in running text that only
"and", "or" or "with" joins (at most ``GAP`` words between them) form one too
("under the MIT license or the Apache License, Version 2.0"). Both go through the
same shunting-yard parser, in which "with" binds before "and", "and" before "or".

An expression is evaluated to how much it permits, from 0 (nothing) to 1: "or" lets the
reader choose and takes the larger value, "and" the smaller, "with" an exception moves
the licence half the way to 1. All statements of a text hold at once, so its score is their least
value. A text without a statement grants nothing and scores 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Phrases whose places are counted, with their labels (fixed values).
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Further names and notices with their labels (fixed values).
NAMES = {
    "mit license": "mit",
    "apache license": "apache",
    "apache license 2 0": "apache-2",
    "apache 2 0": "apache-2",
    "bsd license": "bsd",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "isc license": "isc",
    "mozilla public license": "mpl",
    "gnu general public license": "gpl",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "cc0 1 0": "cc0",
    "dedicated to the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}

#: Names of exceptions, for "with" (fixed values).
EXCEPTIONS = {"classpath exception": "classpath-exception", "linking exception": "linking-exception", "llvm exception": "llvm-exception", "gcc runtime library exception": "gcc-exception"}

#: What introduces an expression on the rest of its line (fixed values).
TAGS = ("spdx license identifier", "license identifier", "license expression")

#: What a licence permits, by the longest of these that starts its label (fixed
#: values: 1 nearly all, 0.6 with weak copyleft, 0.4 copyleft, 0.2 no commerce or no
#: changes, 0 nothing); a licence that no row names gets ``UNKNOWN``.
PERMITS = {
    "mit": 1.0, "apache": 1.0, "bsd": 1.0, "isc": 1.0, "cc0": 1.0, "public-domain": 1.0, "unlicense": 1.0, "0bsd": 1.0, "zlib": 1.0,
    "cc-by": 0.9, "mpl": 0.6, "lgpl": 0.6, "epl": 0.6, "cc-by-sa": 0.4, "gpl": 0.4, "agpl": 0.4,
    "cc-by-nc": 0.2, "cc-by-nd": 0.2, "all-rights-reserved": 0.0, "proprietary": 0.0, "none": 0.0,
}
UNKNOWN = 0.5

GAP = 4
LEVEL = {"or": 1, "and": 2, "with": 3}
#: Bytes to bytes: A-Z lower-cased, what is no word character to a blank.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
SYMBOL = re.compile(rb"[()]|[A-Za-z0-9][A-Za-z0-9.+-]*")


def permits(label: str) -> float:
    found = [k for k in PERMITS if label == k or label.startswith(k + "-")]
    return PERMITS[max(found, key=len)] if found else UNKNOWN


def tidy(symbol: str) -> str:
    """An identifier as a label: lower case, without the ".0" and the "-only", "-or-later" or "+" of versions."""
    return re.sub(r"(\.0)?(-only|-or-later|\+)?$", "", symbol.lower()) or symbol.lower()


def postfix(symbols: list[str]) -> list[str]:
    """Shunting-yard: operands ("mit"), "and", "or", "with" and parentheses to postfix.

    Symbols are read as long as they continue an expression; what does not is where
    it ends. Parentheses left open are closed there, and an operator without a right
    side goes."""
    out, stack, operand, depth = [], [], True, 0
    for s in symbols:
        if operand and s == "(":
            stack.append(s)
            depth += 1
        elif operand and s not in LEVEL and s != ")":
            out.append(s)
            operand = False
        elif not operand and s in LEVEL:
            while stack and stack[-1] != "(" and LEVEL[stack[-1]] >= LEVEL[s]:
                out.append(stack.pop())
            stack.append(s)
            operand = True
        elif not operand and s == ")" and depth:
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
            depth -= 1
        else:
            break
    if operand:  # "a or", "a or (": what waits for a right side goes
        while stack and stack[-1] == "(":
            stack.pop()
        if stack:
            stack.pop()
    return out + [s for s in reversed(stack) if s != "("]


def evaluate(symbols: list[str]) -> tuple[float, frozenset[str], str] | None:
    """(value, labels, the expression with all its parentheses) of the expression
    that the symbols begin with; None if they begin with none."""
    stack: list[tuple[float, frozenset[str], str]] = []
    for s in postfix(symbols):
        if s not in LEVEL:
            stack.append((permits(s), frozenset([s]), s))
            continue
        (va, la, ta), (vb, lb, tb) = stack[-2:]
        value = max(va, vb) if s == "or" else min(va, vb) if s == "and" else (1 + va) / 2
        stack[-2:] = [(value, la | lb, f"({ta} {s} {tb})")]
    return stack[0] if stack else None


@lru_cache(maxsize=1)
def automaton():
    """Over " word word ... " as Latin-1 text; values (number of words, kind, label)."""
    import ahocorasick

    found: dict[str, tuple] = {}
    for kind, phrases in (("name", NAMES), ("exception", EXCEPTIONS), ("base", BASE), ("tag", dict.fromkeys(TAGS, ""))):
        for phrase, label in phrases.items():
            found[phrase] = (len(phrase.split()), kind, label)
    out = ahocorasick.Automaton()
    for phrase, value in found.items():
        out.add_word(f" {phrase} ", value)
    out.make_automaton()
    return out


def words(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def scan(text: bytes) -> dict:
    """What a text (UTF-8) says: n_words, bases [(word, label)], statements [(value, labels, expression)]."""
    tokens = words(text)
    line = b" ".join([b"", *tokens, b""]).decode("latin-1")
    hits, at, seen = [], 0, 0
    for end, (n, kind, label) in automaton().iter(line):
        seen += line.count(" ", at, end)  # blanks before ``end``: one before each word
        at = end
        hits.append((seen - n, seen, kind, label))
    bases = [(a, label) for a, _, kind, label in hits if kind == "base"]
    statements, said = [], []
    for b in sorted({b for _, b, kind, _ in hits if kind == "tag"}):  # one tag may end another
        e, n = after_tag(text, b)
        if e:
            statements.append(e)
            said.append((b, b + n))
    # the longest name from each place; a name inside another, or on a tag's line, is part of that
    names = sorted((h for h in hits if h[2] != "tag" and not any(a <= h[0] < b for a, b in said)), key=lambda h: (h[0], -h[1]))
    chain: list[str] = []
    end, last = 0, None
    for a, b, kind, label in names:
        if a < end:
            continue
        joint = [w.decode() for w in tokens[end:a] if w in (b"and", b"or", b"with")] if last and a - end <= GAP else []
        if len(joint) == 1 and (joint[0] == "with") == (kind == "exception"):
            chain += [joint[0], label]
        else:
            if chain and (e := evaluate(chain)):
                statements.append(e)
            chain = [label] if kind != "exception" else []  # an exception alone states nothing
        end, last = b, chain
    if chain and (e := evaluate(chain)):
        statements.append(e)
    return {"n_words": len(tokens), "bases": sorted(bases), "statements": statements}


def after_tag(text: bytes, word: int) -> tuple[tuple[float, frozenset[str], str] | None, int]:
    """The expression after a tag whose last word comes before word number ``word``, and the words on the rest of its line."""
    found = None
    for k, m in enumerate(WORD.finditer(text)):
        if k == word - 1:
            found = m.end()
            break
    rest = text[found:].split(b"\n", 1)[0] if found is not None else b""
    symbols = [s.decode() for s in SYMBOL.findall(rest)]
    return evaluate([s.lower() if s.lower() in LEVEL or s in "()" else tidy(s) for s in symbols]), len(words(rest))


SCHEMA = "n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, expressions array<string>, score double"


def scan_licences(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: ``key``, n_words, n_base (places of a base
    phrase, overlapping ones included), first_word and last_word (their smallest and
    largest start, from 0; null without any), base_labels and labels (distinct,
    sorted; labels holds the base ones too), expressions (each statement, fully
    parenthesised, in the order found, tags first) and score.

    A null text counts as empty. Null and repeated keys stay as they are; other
    columns are left out. Texts are read whole."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t in batch.column(1):
                s = scan(t.as_py())
                base = sorted({label for _, label in s["bases"]})
                own = {label for _, labels, _ in s["statements"] for label in labels}
                places = [a for a, _ in s["bases"]]
                rows.append((
                    s["n_words"], len(places), places[0] if places else None, places[-1] if places else None, base, sorted({*base, *own}),
                    [e for _, _, e in s["statements"]], min((v for v, _, _ in s["statements"]), default=0.0),
                ))
            strings, longs = pa.list_(pa.string()), pa.int64()
            kinds = [longs, longs, longs, longs, strings, strings, strings, pa.float64()]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["key", *(c.split()[0] for c in SCHEMA.split(", "))])

    out = df.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text")).mapInArrow(run, f"key {kind}, {SCHEMA}")
    return out.withColumnRenamed("key", key)
