"""Personal data by candidate gradient boosting, in DataFrame functions alone.

Base patterns find e-mail addresses, IP addresses, card and phone numbers; their
matches are kept whatever follows. Generators of high recall propose further,
overlapping candidates (obfuscated addresses, numbers with other separators or
without a prefix). Boosted trees score a candidate by its format and its
context; a threshold per kind, calibrated on held-out candidates, decides. Those that
pass are kept from the most probable on, unless one kept before or a base match
overlaps. A phone number is proposed as 7 to 15 digits in groups of any length, from
the start of a group to the end of one.

The trees learn from planted texts, since a base match never comes before them. The valid base
matches of a bounded sample of documents (``documents``, by hash of the text) are rewritten to forms that the
base patterns miss (addresses with "(at)" or spaces, numbers with other separators,
without "+" or with 00): positives. Lists, prices, dates, versions and mentions of like form are
written from hashes of the same matches: negatives. Both stand in the matches' own contexts and
in neutral ones. No feature tells what defines a label ("+", "@" as such). A candidate that fails its kind's own
check (Luhn, octets, number of digits) or is part of a longer token is never added, and a kind without both labels among the held-out
candidates gets no additions. The fitted trees become a column expression, so documents are
searched and scored where they are read, in one pass, with nothing shuffled.

Matches are located by splitting the text at a pattern and adding up the lengths of
the pieces and matches in turn; positions count code points. The patterns have no
nested repetition that can backtrack, so they take linear time and no
stack on long runs.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

KINDS = ("email", "ip", "card", "phone")

# The base patterns, each equal to its plain form under leftmost search: a start
# within a run that has failed from its beginning is not tried again (\G lets a run
# begin where the last match ended), and repetitions that nothing could take back
# are possessive. A card is a whole run of 13 to 19 digits.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GENERATORS = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+\s?(?:@|\(at\)|\[at\]|\{at\})\s?[a-z0-9-]{1,63}+(?:\s?(?:\.|\(dot\)|\[dot\]|\{dot\})\s?[a-z0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![0-9])[0-9]{1,3}+(?:\s?(?:\.|\[\.\]|\(\.\)|,)\s?[0-9]{1,3}+){3}+",
    "card": r"(?<![0-9])[0-9](?:[\x20._/-]{0,2}[0-9]){11,22}+",
    "phone": r"(?<![0-9])(?:(?:\+|00)[\x20(]{0,2}|\()?[0-9](?:[\x20./()-]{0,4}[0-9]){6,14}(?![0-9])",
}
CONTEXT = 24  # code points looked at before a candidate
WORDS = {
    "phone": "phone|tel|call|fax|mobile|dial",
    "card": "card|visa|account|pay",
    "email": "mail|contact|write",
    "ip": "ip|host|server|addr",
}
FEATURES = 30
TLD = "com|org|net|edu|gov|info|biz|io|example|test|de|fr|es|it|uk|eu|nl|us|ca|ar|br"
SPAN = "array<struct<kind:int,start:int,end:int>>"


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(x: Column) -> Column:
    """The Luhn check of the digits of ``x``; true for none."""
    d = digits(x)
    n = F.length(d)
    numbers = F.filter(F.split(F.reverse(d), ""), lambda c: c != "")
    doubled = F.transform(numbers, lambda c, k: F.when(k % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") * 2 / 10).cast("int")))
    return (n == 0) | (F.aggregate(doubled, F.lit(0), lambda a, c: a + c) % 10 == 0)


def octets(x: Column, separators: str = r"\.") -> Column:
    """Whether all numbers of ``x`` are at most 255."""
    bare = lambda p: F.regexp_replace(p, "^0+", "")
    return F.forall(F.split(x, separators), lambda p: (F.length(bare(p)) <= 3) & (F.coalesce(bare(p).try_cast("int"), F.lit(0)) <= 255))


def valid(kind: str, x: Column) -> Column:
    n = F.length(digits(x))
    return {"email": F.lit(True), "ip": octets(x), "card": n.between(13, 19) & luhn(x), "phone": n.between(9, 15)}[kind]


#: What a text must hold for a pattern to be tried at all.
HINTS = {
    "base": {"email": lambda t: t.contains("@"), "ip": lambda t: t.rlike("[0-9]"), "card": lambda t: t.rlike("[0-9]"), "phone": lambda t: t.contains("+")},
    "more": {
        "email": lambda t: t.rlike(r"@|(?i)[(\[{]at[)\]}]"),
        "ip": lambda t: t.rlike("[0-9]"),
        "card": lambda t: t.rlike("[0-9]"),
        "phone": lambda t: t.rlike("[0-9]"),
    },
}


CHUNK = 512  # matches folded at once; keeps a text of many matches from being copied over and over


def located(text: Column, pattern: str, hint: Column) -> Column:
    """array<struct<start, end, m, before, after>>: the matches of a pattern with
    their places, up to CONTEXT code points before (back to the match before) and the one after.
    Chunks of matches are placed from 0, then moved by the chunks' lengths before them."""
    kind = "array<struct<start:int,end:int,m:string,before:string,after:string>>"
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    following = F.slice(gaps, 2, F.size(gaps))
    steps = F.zip_with(F.arrays_zip(gaps.alias("gap"), following.alias("next")), matches, lambda g, m: F.struct(g["gap"].alias("gap"), g["next"].alias("next"), m.alias("m")))

    def place(chunk: Column) -> Column:
        start = lambda a, s: a["at"] + F.length(s["gap"])
        end = lambda a, s: start(a, s) + F.length(s["m"])
        span = lambda a, s: F.struct(start(a, s).alias("start"), end(a, s).alias("end"), s["m"].alias("m"), F.substring(s["gap"], -CONTEXT, CONTEXT).alias("before"), F.substring(s["next"], 1, 1).alias("after"))
        return F.aggregate(
            chunk,
            F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out")),
            lambda a, s: F.struct(end(a, s).alias("at"), F.concat(a["out"], F.array(span(a, s))).alias("out")),
        )

    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / CHUNK).cast("int")), lambda i: place(F.slice(steps, i * CHUNK + 1, F.least(F.lit(CHUNK), F.size(matches) - i * CHUNK))))
    moved = F.aggregate(
        chunks,
        F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("out")),
        lambda a, c: F.struct(
            (a["at"] + c["at"]).alias("at"),
            F.concat(a["out"], F.array(F.transform(c["out"], lambda s: F.struct((s["start"] + a["at"]).alias("start"), (s["end"] + a["at"]).alias("end"), s["m"].alias("m"), s["before"].alias("before"), s["after"].alias("after"))))).alias("out"),
        ),
        lambda a: F.flatten(a["out"]),
    )
    return F.when(hint & text.rlike(pattern), moved).otherwise(F.array().cast(kind))


def overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def features(kind: int, c: Column) -> list[Column]:
    """FEATURES numbers (as double) of a candidate's format and context."""
    m, before = F.regexp_replace(c["m"], r"^\+", ""), F.lower(c["before"])
    n = F.length(digits(m))
    groups = F.transform(F.filter(F.split(m, "[^0-9]+"), lambda g: g != ""), lambda g: F.length(g))
    size = F.size(groups)
    separators = F.filter(F.split(m, "[0-9A-Za-z]+"), lambda g: g != "")
    flags = [
        F.lit(kind),
        F.length(m),
        n,
        F.length(m) - n,
        F.length(F.regexp_replace(m, "[^A-Za-z]", "")),
        size,
        luhn(m),
        octets(F.regexp_replace(m, r"[^0-9]+", "."), r"\."),
        *[before.rlike(words) for words in WORDS.values()],
        F.size(F.array_distinct(F.split(digits(m), ""))),
        before.rlike(r"[=/#:]\s?$"),
        m.contains("("),
        F.length(m) - F.length(F.replace(m, F.lit(" "), F.lit(""))),
        m.contains(","),
        m.rlike(r"(?i)[(\[{](at|dot|\.)[)\]}]"),
        F.length(F.regexp_extract(m, "[A-Za-z]*$", 0)),
        m.rlike(f"(?i)[^A-Za-z](?:{TLD})$"),
        m.rlike(r"\s[A-Z][a-z]*$"),
        m.rlike(r"\s@\S"),
        m.rlike(r"(?i)^[0-9]+\s?(@|[(\[{]at)"),
        F.coalesce(F.get(groups, F.lit(0)), F.lit(0)),
        F.coalesce(F.element_at(F.when(size > 0, groups), -1), F.lit(0)),
        F.coalesce(F.array_max(groups), F.lit(0)),
        F.coalesce(F.array_min(groups), F.lit(0)),
        m.startswith("0"),
        F.size(F.array_distinct(separators)),
        m.rlike(r"(?<![0-9])(?:19|20)[0-9]{2}(?![0-9])|(?<![0-9])(?:19|20)[0-9]{2}(?:0[1-9]|1[0-2])[0-3][0-9](?![0-9])"),
    ]
    assert len(flags) == FEATURES
    return [x.cast("double") for x in flags]


def base_matches(t: Column, k: int, kind: str) -> Column:
    found = F.filter(located(t, BASE[kind], HINTS["base"][kind](t)), lambda s: valid(kind, s["m"]))
    return F.transform(found, lambda s: F.struct(F.lit(k).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def candidates(found: Column, base: Column, k: int, kind: str) -> Column:
    """Those of ``found`` that overlap no base match, are no part of a longer token and pass their
    kind's check, with their features."""
    n = lambda c: F.length(digits(c["m"]))
    passes = {
        "email": lambda c: F.lit(True),
        "ip": lambda c: octets(F.regexp_replace(c["m"], r"[^0-9]+", ".")),
        "card": lambda c: n(c).between(13, 19) & luhn(c["m"]),
        "phone": lambda c: n(c).between(7, 15),
    }[kind]

    def one(c):
        x = features(k, c)
        return F.struct(F.lit(k).alias("kind"), c["start"].alias("start"), c["end"].alias("end"), F.array(*x).alias("x"))

    whole = lambda c: ~c["before"].rlike(r"[\p{L}\p{N}_]$") & ~c["after"].rlike(r"^[\p{L}\p{N}_]")
    return F.transform(F.filter(found, lambda c: whole(c) & ~F.exists(base, lambda b: overlap(b, c)) & passes(c)), one)


def with_candidates(df: DataFrame, text: str) -> DataFrame:
    """``df`` with __t (the text, null as empty), __base (the valid base matches of all kinds) and __cand
    (the candidates)."""
    t = F.col("__t")
    df = df.withColumn("__t", F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    for k, kind in enumerate(KINDS):
        df = df.withColumn(f"__b{k}", base_matches(t, k, kind))
    df = df.withColumn("__base", F.concat(*[F.col(f"__b{k}") for k in range(len(KINDS))])).drop(*[f"__b{k}" for k in range(len(KINDS))])
    for k, kind in enumerate(KINDS):
        df = df.withColumn(f"__g{k}", located(t, GENERATORS[kind], HINTS["more"][kind](t)))
        df = df.withColumn(f"__c{k}", candidates(F.col(f"__g{k}"), F.col("__base"), k, kind)).drop(f"__g{k}")
    cand = F.concat(*[F.col(f"__c{k}") for k in range(len(KINDS))])
    return df.withColumn("__cand", cand).drop(*[f"__c{k}" for k in range(len(KINDS))])


@dataclass
class Trees:
    """Boosted trees and the least probability accepted, by kind number."""

    trees: list[tuple[float, tuple]] = field(default_factory=list)
    thresholds: dict[int, float] = field(default_factory=dict)

    def probability(self, x: Column) -> Column:
        """As a column expression over an array of features."""

        def walk(node: tuple) -> Column:
            if len(node) == 1:
                return F.lit(node[0])
            at, threshold, left, right = node
            return F.when(x[at] <= threshold, walk(left)).otherwise(walk(right))

        margin = sum((F.lit(w) * walk(t) for w, t in self.trees), F.lit(0.0))
        return 1 / (1 + F.exp(-2 * margin))

    def threshold(self, kind: Column) -> Column:
        out = F.lit(2.0)
        for k, least in self.thresholds.items():
            out = F.when(kind == k, F.lit(least)).otherwise(out)
        return out


def of_kind(k: int, tree: tuple) -> tuple:
    """The tree for candidates of kind ``k``, nothing for others."""
    return (0, k + 0.5, (0, k - 0.5, (0.0,), tree), (0.0,))


def tree_of(node) -> tuple:
    if node.getClass().getSimpleName() == "LeafNode":
        return (float(node.prediction()),)
    split = node.split()
    return (int(split.featureIndex()), float(split.threshold()), tree_of(node.leftChild()), tree_of(node.rightChild()))


NEUTRAL = ("with ", "of ", "is ", "to ", "from ", "the ", "and ", "see ", "(", "on ")
NOUNS = ("home", "work", "python", "look", "noon", "school", "node", "item", "him", "media", "user", "price")


def planted(kind: Column, m: Column) -> Column:
    """array<struct<kind, s, good>>: texts written from a base match ``m`` of a kind. Positives are forms of
    the match that no base pattern takes, negatives of all kinds are built of its hashes."""
    number = lambda i, low, high: (F.lit(low) + F.pmod(F.xxhash64(m, F.lit(i)), F.lit(high - low + 1))).cast("string")
    two = lambda i, low, high: F.lpad(number(i, low, high), 2, "0")
    word = lambda i: F.element_at(F.array(*map(F.lit, NOUNS)), (F.pmod(F.xxhash64(m, F.lit(i)), F.lit(len(NOUNS))) + 1).cast("int"))
    d, join = digits(m), lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    cut = lambda x, start, size: F.substring(x, start, size)
    local, domain = F.regexp_extract(m, "^[^@]*", 0), F.regexp_extract(m, "[^@]*$", 0)
    dotted = lambda x, by: F.replace(x, F.lit("."), F.lit(by))
    fours = lambda by: F.concat_ws(by, cut(d, 1, 4), cut(d, 5, 4), cut(d, 9, 4), cut(d, 13, 7))
    # ten digits, as numbers of a national plan have; those of the match come last
    ten = F.concat(number(20, 2, 9), F.lpad(F.substring(d, -9, 9), 9, "7"))
    positives = {
        "email": [
            *[join(local, f"{s}{o}at{c}{s}", dotted(domain, f"{s}{o}dot{c}{s}")) for o, c in ("()", "[]", "{}") for s in ("", " ")],
            *[join(local, f"{s}{o}at{c}{s}", domain) for o, c in ("()", "[]") for s in ("", " ")],
            join(local, " @ ", domain),
            join(local, " @ ", dotted(domain, " . ")),
            join(local, "@", dotted(domain, "(dot)")),
        ],
        "ip": [dotted(m, by) for by in ("[.]", "(.)", " . ", " [.] ")],
        "card": [fours(by) for by in (".", "/", "_", "  ", "- ", " .")],
        "phone": [
            join("00", d),
            *[join("00", cut(d, 1, 2), " ", cut(d, 3, area), " ", cut(d, 3 + area, 10)) for area in (2, 3, 4)],
            ten,
            join("(", cut(ten, 1, 3), ") ", cut(ten, 4, 3), "-", cut(ten, 7, 4)),
            *[F.concat_ws(by, cut(ten, 1, 3), cut(ten, 4, 3), cut(ten, 7, 4)) for by in "-. /"],
            join("0", cut(ten, 1, 3), " ", cut(ten, 4, 7)),
            join("0", cut(ten, 1, 3), "/", cut(ten, 4, 7)),
            join("(0", cut(ten, 1, 3), ") ", cut(ten, 4, 7)),
            join("0", cut(ten, 1, 2), "-", cut(ten, 3, 8)),
            join("1-", cut(ten, 1, 3), "-", cut(ten, 4, 3), "-", cut(ten, 7, 4)),
            cut(ten, 1, 7),
        ],
    }
    few, year, day = [number(30 + i, 1, 20) for i in range(8)], number(40, 1950, 2029), [two(41 + i, 1, 28) for i in range(4)]
    month, tens, hundreds = [two(50 + i, 1, 12) for i in range(2)], [number(60 + i, 1, 99) for i in range(9)], [number(70 + i, 100, 999) for i in range(6)]
    octet = [number(80 + i, 0, 255) for i in range(4)]
    half = [join(number(90 + i, 1, 9), ".", number(100 + i, 0, 9)) for i in range(9)]
    negatives = {
        "email": [
            join(tens[0], " @ ", tens[1], ".", tens[2]),
            join(word(1), " @ ", word(2), ". ", F.initcap(word(3))),
            join(word(4), " @ ", word(5), " . ", F.initcap(word(6))),
            join(word(7), " @", word(8), ".", word(9)),
            join(word(10), " (at) ", word(11), ". ", F.initcap(word(12))),
            join(tens[3], " @ ", half[0], " . "),
            join(word(13), " @", word(14), "-", tens[5], ".", word(15)),
        ],
        "ip": [
            *[F.concat_ws(by, *x[:4]) for by in (", ", ",") for x in (few, tens, octet)],
            F.concat_ws(". ", *few[:4]),
            join(half[0], ", ", half[1], " and"),
            join(half[2], ",", half[3], " m"),
            join(half[4], " , ", half[5]),
            join(few[4], ", ", half[6], ", ", few[5]),
        ],
        "card": [
            *[F.concat_ws(" ", *half[:k]) for k in (7, 8, 9)],
            *[F.concat_ws("/", *half[:k]) for k in (7, 8)],
            *[join(year, by, month[0], by, day[0], " ", number(110 + i, 1950, 2029), by, month[1], by, day[1]) for i, by in enumerate("/._")],
            *[F.concat_ws(by, *hundreds[:5]) for by in ("  ", ". ", "/", "_", ".")],
            *[F.concat_ws(by, *tens[:k]) for by in ("  ", ". ", "/") for k in (8, 9)],
        ],
        "phone": [
            *[F.concat_ws(by, year, month[0], day[0]) for by in ("-", "/", ".", "")],
            *[F.concat_ws(by, day[1], month[1], year) for by in ("-", "/", ".")],
            *[join(year, by, number(120, 1950, 2029)) for by in ("-", " - ", "/", " ")],
            join(year, "-", month[1], "-", day[2], " ", tens[0]),
            *[F.concat_ws(by, few[0], hundreds[0], hundreds[1]) for by in (" ", ".")],
            *[F.concat_ws(by, tens[0], hundreds[2], hundreds[3]) for by in (" ", ".")],
            F.concat_ws(" ", tens[1], *hundreds[:3]),
            F.concat_ws(" ", *hundreds[:4]),
            F.concat_ws(" ", *few),
            F.concat_ws(" ", *tens[:6]),
            F.concat_ws("-", *tens[:5]),
            F.concat_ws("/", *tens[:5]),
            F.concat_ws(" ", *half[:5]),
            join(hundreds[0], ".", tens[1], " ", hundreds[1], ".", tens[2]),
            join("978-", number(130, 0, 9), "-", tens[3], "-", hundreds[4], hundreds[5], "-", number(131, 0, 9)),
        ],
    }
    row = lambda k, x, good: F.struct(F.lit(k).alias("kind"), x.alias("s"), F.lit(good).alias("good"))
    own = F.array().cast("array<struct<kind:int,s:string,good:int>>")
    for k, name in enumerate(KINDS):
        own = F.when(kind == k, F.array(*[row(k, x, 1) for x in positives[name]])).otherwise(own)
    return F.concat(own, F.array(*[row(k, x, 0) for k, name in enumerate(KINDS) for x in negatives[name]]))


def examples(df: DataFrame, matches: int) -> DataFrame:
    """(h, kind, x, label) of planted texts of at most ``matches`` base matches of each kind, those of
    the smallest hashes; h is the hash of the match that a text was made of."""
    t, found = F.col("__t"), []
    df = df.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__t"))
    for k, kind in enumerate(KINDS):
        found.append(F.transform(F.filter(located(t, BASE[kind], HINTS["base"][kind](t)), lambda s: valid(kind, s["m"])), lambda s: F.struct(F.lit(k).alias("kind"), s["m"].alias("m"), s["before"].alias("before"), s["after"].alias("after"))))
    rows = written(df.select(F.explode(F.concat(*found)).alias("b")).select("b.*", F.xxhash64("b.m").alias("h")), "matches")
    parts = [rows.filter(F.col("kind") == k).dropDuplicates(["m"]).orderBy("h", "m").limit(matches) for k in range(len(KINDS))]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    neutral = F.element_at(F.array(*map(F.lit, NEUTRAL)), (F.pmod(F.xxhash64("m", "s"), F.lit(len(NEUTRAL))) + 1).cast("int"))
    # within a lambda: as generated code the texts pass 64 KB, and the attempt to compile them takes the driver's memory
    texts = F.flatten(F.transform(F.array(F.struct("kind", "m")), lambda b: planted(b["kind"], b["m"])))
    rows = rows.repartition(16).select("h", "m", "before", "after", F.explode(texts).alias("p")).select("h", "m", "before", "after", "p.*")
    rows = rows.withColumn("lead", F.when(F.pmod(F.xxhash64("s", "m", F.lit(2)), F.lit(2)) == 0, neutral).otherwise(F.col("before")))
    rows = rows.select("h", F.col("kind").alias("planted"), "good", F.length("lead").alias("at"), F.length("s").alias("size"), F.concat("lead", "s", F.when(F.length("after") > 0, F.col("after")).otherwise(F.lit(" "))).alias("text"))
    c = F.col("c")
    rows = with_candidates(rows, "text").select("h", "planted", "good", "at", "size", F.explode("__cand").alias("c")).filter(c["kind"] == F.col("planted"))
    whole = (c["start"] == F.col("at")) & (c["end"] == F.col("at") + F.col("size"))
    meets = (c["start"] < F.col("at") + F.col("size")) & (c["end"] > F.col("at"))
    label = F.when((F.col("good") == 1) & whole, 1.0).when((F.col("good") == 0) & meets, 0.0)
    return rows.select("h", "c.kind", "c.x", label.alias("label")).filter("label is not null")


def fit(df: DataFrame, text: str = "text", documents: int = 50_000, matches: int = 400, rounds: int = 10, depth: int = 4, precision: float = 0.95, bins: int = 50) -> Trees:
    """Trees, ``rounds`` a kind, fitted on the planted texts of at most ``matches`` base matches a kind, found in
    about ``documents`` documents (all, if there are fewer), four fifths of them; on the others the lowest probability is
    found above which at least ``precision`` of a kind's candidates are positives, either label
    weighing the same in sum (and one negative added). A kind without such a probability, or without 5 held-out
    candidates of either label, gets no additions."""
    df = df.select(F.col(f"`{text}`").alias("text"))
    n = df.count()
    if n > documents:
        df = df.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int((1 << 30) * documents / n))
    rows = written(examples(df, matches), "candidates").withColumn("held", F.pmod("h", F.lit(5)) == 0)
    seen = {(r.kind, r.label) for r in rows.filter("not held").select("kind", "label").distinct().collect()}
    trees = Trees()
    for k in range(len(KINDS)):
        if {(k, 0.0), (k, 1.0)} <= seen:
            data = rows.filter(f"not held and kind = {k}").select(array_to_vector("x").alias("features"), "label").coalesce(4)
            model = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=7).fit(data)
            trees.trees += [(w, of_kind(k, tree_of(t._java_obj.rootNode()))) for t, w in zip(model.trees, model.treeWeights, strict=True)]
    if not trees.trees:
        return trees
    level = F.floor(F.transform(F.array("x"), trees.probability)[0] * bins).cast("int")  # as in ``find``, within a lambda: too long for generated code
    counts = rows.filter("held").groupBy("kind", F.least(level, F.lit(bins - 1)).alias("bin")).agg(F.sum("label").alias("good"), F.count("*").alias("n")).collect()
    for kind in {r.kind for r in counts}:
        own = sorted((r for r in counts if r.kind == kind), key=lambda r: -r.bin)
        goods, bads = sum(r.good for r in own), sum(r.n - r.good for r in own)
        if min(goods, bads) < 5:
            continue
        good = bad = 0
        for r in own:
            good, bad = good + r.good, bad + r.n - r.good
            share, wrong = good / goods, (bad + 1) / (bads + 1)
            if share >= precision * (share + wrong):
                trees.thresholds[kind] = r.bin / bins
    return trees


def selected(spans: Column) -> Column:
    """SPAN: those of ``spans`` (kind, start, end, p) kept when they are taken from the
    most probable on (of equal ones the longest) and none may overlap one kept before. The ones that
    overlap nothing are kept without that walk."""
    other = lambda c, d: overlap(c, d) & ((c["kind"] != d["kind"]) | (c["start"] != d["start"]) | (c["end"] != d["end"]))
    bare = lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))
    contested = lambda c: F.exists(spans, lambda d: other(c, d))
    order = F.array_sort(F.transform(F.filter(spans, contested), lambda c: F.struct((-c["p"]).alias("least"), (c["start"] - c["end"]).alias("longest"), c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))))
    kept = F.aggregate(order, F.array().cast(SPAN), lambda a, c: F.when(F.exists(a, lambda d: overlap(c, d)), a).otherwise(F.concat(a, F.array(bare(c))).cast(SPAN)))
    return F.concat(F.transform(F.filter(spans, lambda c: ~contested(c)), bare).cast(SPAN), kept)


def find(df: DataFrame, trees: Trees, text: str = "text") -> DataFrame:
    """``df`` with ``base_spans`` and ``spans`` (array<struct<kind:int, start, end>>,
    kinds numbered as in KINDS, in order of kind and start; code points, end
    exclusive), the base ones and all.

    A null text counts as empty. Keys play no part, so null or repeated ones
    and repeated rows are searched each. Input columns named as results are
    replaced."""
    df = df.drop("base_spans", "spans")
    found = with_candidates(df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(f"`{text}`").alias("text")), "text")
    base = F.col("__base")
    scored = F.transform("__cand", lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), trees.probability(c["x"]).alias("p")))
    found = found.withColumn("__free", F.filter(scored, lambda c: c["p"] >= trees.threshold(c["kind"])) if trees.trees else F.array().cast("array<struct<kind:int,start:int,end:int,p:double>>"))
    return found.select("row.*", F.array_sort(base.cast(SPAN)).alias("base_spans"), F.array_sort(F.concat(base, selected(F.col("__free"))).cast(SPAN)).alias("spans"))


def count(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets. Spans that
    overlap are replaced together, under the name of the first."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"))))
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(
        ordered,
        begin,
        lambda a, s: F.struct(
            F.greatest(a["at"], -s["back"]).alias("at"),
            F.when(s["start"] < a["at"], a["out"]).otherwise(F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), names[s["kind"]])).alias("out"),
        ),
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))),
    )
