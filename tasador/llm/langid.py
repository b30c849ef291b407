"""Language ID by Bayesian fusion of evidence.

For every language l, and for "und" (none of those known),

    P(l | all) ~ P(text | l)^a  P(declared | l)  P(l | host)

* text: byte trigrams in 2^16 buckets, their counts by declared language gathered over all
  documents with a declared language. "und" gives every bucket the same
  probability, so text unlike any language falls to it. ``a`` tempers the
  product, since neighbouring trigrams are not independent.
* declared markup language: how often a document whose text speaks for l
  declares it, nothing, or something else, by a grouped sum of the text posteriors.
* address suffix and host: priors from the same posteriors, summed by host, by
  suffix and overall, each smoothed towards the one above it:
  P(l | suffix) = (n(suffix, l) + k P(l)) / (n(suffix) + k), and so for hosts.

Languages are positions of arrays, and sums have a row a language, so no expression grows with their
number. The grouped sums are combined before their shuffle, so a host with a third of all
rows is one row a task there. The host table joins back as a plain table: Spark
broadcasts it if its measured size allows, else it splits skewed hosts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import utf8, written

BUCKETS = 1 << 16
NONE = "und"
RARE = "rare"  # stands for every tag that too few rows declare; no tag has four letters


def trigrams(text: bytes) -> np.ndarray:
    """The buckets of the text's byte trigrams, A-Z lower-cased, ASCII characters that
    are no letters as blanks."""
    data = np.frombuffer(b" " + text.lower().translate(FOLD) + b" ", dtype=np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.empty(0, dtype=np.uint32)
    code = (data[:-2] * 65599 + data[1:-1]) * 65599 + data[2:]
    code = code[~((data[:-2] == 32) & (data[1:-1] == 32))]  # runs of blanks say nothing
    return (code ^ (code >> 15)) * np.uint32(2654435761) >> 16


FOLD = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def declared_tag(column: Column) -> Column:
    """The primary subtag in lower case; null if there is none of two or three letters."""
    tag = F.lower(F.regexp_extract(F.coalesce(column.cast("string"), F.lit("")), r"^\s*([A-Za-z]{2,3})(?:[-_].*)?\s*$", 1))
    return F.when(tag != "", tag)


def suffix_of(host: Column) -> Column:
    """The last label of a host name; null if it has but one."""
    tail = F.lower(F.regexp_extract(F.coalesce(host.cast("string"), F.lit("")), r"\.([^.]+)$", 1))
    return F.when(tail != "", tail)


class TextModel:
    """Log probabilities of the trigram buckets by language, "und" last."""

    def __init__(self, languages: list[str], logs: np.ndarray):
        self.languages, self.logs = [*languages, NONE], np.vstack([logs, np.full((1, BUCKETS), -np.log(BUCKETS))]).astype(np.float32)

    @classmethod
    def train(cls, df: DataFrame, smoothing: float = 0.05) -> TextModel:
        """From ``df`` (text, declared): counts by declared language, one row a
        language and task."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts: dict[str, np.ndarray] = {}
            for batch in batches:
                for text, tag in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                    own = counts.setdefault(tag, np.zeros(BUCKETS, dtype=np.int64))
                    own += np.bincount(trigrams(text.as_py()), minlength=BUCKETS)
            for tag, own in counts.items():
                at = np.flatnonzero(own)
                yield pa.RecordBatch.from_arrays([pa.array([tag] * len(at)), pa.array(at), pa.array(own[at])], names=["tag", "bucket", "n"])

        sums = df.filter("declared is not null").select(utf8("text"), "declared").mapInArrow(run, "tag string, bucket long, n long")
        # at most 2^16 rows a declared language
        rows = sums.groupBy("tag", "bucket").agg(F.sum("n").alias("n")).toArrow()
        tags = rows.column("tag").to_numpy(zero_copy_only=False)
        languages = sorted(set(tags))
        logs = np.zeros((len(languages), BUCKETS))
        for k, tag in enumerate(languages):
            own = tags == tag
            logs[k, rows.column("bucket").to_numpy()[own]] = rows.column("n").to_numpy()[own]
        logs += smoothing
        return cls(languages, np.log(logs / logs.sum(1, keepdims=True)) if languages else logs)

    def scores(self, text: bytes) -> np.ndarray:
        return self.logs[:, trigrams(text)].sum(1, dtype=np.float64)


def posterior(x: np.ndarray) -> np.ndarray:
    p = np.exp(x - x.max(-1, keepdims=True))
    return p / p.sum(-1, keepdims=True)


def identify(df: DataFrame, text: str = "text", declared: Column | None = None, host: Column | None = None, temper: float = 0.2, unknown: float = 0.01,
             strength: float = 50.0, min_posterior: float = 0.5, least_documents: int = 5) -> DataFrame:
    """``df`` with the columns ``language``, ``posterior``, ``text_posterior`` (of
    that language by the text alone) and ``accepted``: the language is not "und", its
    posterior reaches ``min_posterior``, and the text holds a letter.

    ``declared`` and ``host`` are expressions over ``df``; without one, or where
    it is null, that evidence is left out (a null host takes the overall prior). The languages known
    are the tags that ``least_documents`` rows declare; all rarer tags are one, which speaks for no
    language of its own. A null text counts as empty: the other evidence decides, and it is not accepted.
    Repeated rows count each. Input columns named as results are replaced, all others kept, whatever their names."""
    names = ["language", "posterior", "text_posterior", "accepted"]
    kept = [c for c in df.columns if c.lower() not in names]
    mark = "__"
    while any(c.lower().startswith(mark) for c in df.columns):
        mark += "_"
    TEXT, TAG, HOST, SUFFIX, LOGS, K, P = [mark + c for c in ("text", "tag", "host", "suffix", "logs", "k", "p")]
    KEY, ABOVE, PRIOR, TOLD, FUSED, BEST, AT = [mark + c for c in ("key", "above", "prior", "told", "fused", "best", "at")]
    host = F.lit(None).cast("string") if host is None else host.cast("string")
    base = df.select(
        *[F.col(f"`{c}`") for c in kept],
        utf8(text).alias(TEXT),
        declared_tag(F.lit(None) if declared is None else declared).alias(TAG),
        F.lower(host).alias(HOST),
        suffix_of(host).alias(SUFFIX),
    )
    spark = df.sparkSession
    # tags have two or three letters, so there are 18,252 at most
    often = [r[0] for r in base.filter(F.col(TAG).isNotNull()).groupBy(TAG).count().filter(F.col("count") >= least_documents).collect()]
    base = base.withColumn(TAG, F.when(F.col(TAG).isNull() | F.col(TAG).isin(often), F.col(TAG)).otherwise(F.lit(RARE)))
    model = TextModel.train(base.filter(F.col(TAG) != RARE).select(F.col(TEXT).alias("text"), F.col(TAG).alias("declared")))
    shared = spark.sparkContext.broadcast((model.logs, temper))
    languages = model.languages
    size = len(languages)

    @F.pandas_udf("array<double>")
    def logs(texts):
        import pandas as pd

        table, a = shared.value
        return pd.Series([(table[:, trigrams(t)].sum(1, dtype=np.float64) * a).tolist() for t in texts])

    scored = base.withColumn(LOGS, logs(TEXT))
    top = F.array_max(LOGS)
    added = lambda x: F.aggregate(x, F.lit(0.0), lambda a, b: a + b)
    relative = F.transform(LOGS, lambda x: F.exp(x - top))

    # grouped sums of the text posteriors: a row a (host, suffix, tag) and language
    shares = scored.select(HOST, SUFFIX, TAG, relative.alias(P)).withColumn(ABOVE, added(F.col(P)))
    shares = shares.select(HOST, SUFFIX, TAG, ABOVE, F.posexplode(P).alias(K, P)).withColumn(P, F.col(P) / F.col(ABOVE))
    facts = written(shares.groupBy(HOST, SUFFIX, TAG, K).agg(F.sum(P).alias(P)), "facts")

    def by(*keys: str) -> DataFrame:
        """The sums by ``keys``, an array over the languages in ``P``."""
        sums = facts.filter(F.col(keys[0]).isNotNull()).groupBy(*keys, K).agg(F.sum(P).alias(P))
        rows = sums.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(K, P))).alias(P))  # an entry a language
        return rows.withColumn(P, F.col(f"{P}.{P}"))

    # the table of declared against spoken languages: its rows are language tags, RARE and null
    by_tag: dict[str | None, np.ndarray] = {}
    for tag, k, p in facts.groupBy(TAG, K).agg(F.sum(P)).collect():
        by_tag.setdefault(tag, np.zeros(size))[k] = p
    overall = sum(by_tag.values(), np.zeros(size))
    prior = (overall + 1) / (overall + 1).sum()
    prior = np.append(prior[:-1] / prior[:-1].sum() * (1 - unknown), unknown) if size > 1 else np.ones(1)
    tags = [t for t in by_tag if t is not None]
    spoken = sum((by_tag[t] for t in tags), np.zeros(size))
    told = [(t, np.log((by_tag[t] + 1) / (spoken + len(tags) + 1)).tolist()) for t in tags]
    told = spark.createDataFrame(told, f"`{KEY}` string, `{TOLD}` array<double>")

    # priors: overall, then suffix, then host
    known = F.array(*map(F.lit, prior.tolist()))

    def smoothed(table: DataFrame, above: str, name: str) -> DataFrame:
        """The sums of ``table`` as shares, smoothed towards the array ``above``."""
        total = mark + "total"
        return table.withColumn(total, added(F.col(P))).withColumn(name, F.zip_with(P, above, lambda n, q: (n + strength * q) / (F.col(total) + strength))).drop(P, total)

    suffixes = smoothed(by(SUFFIX).withColumn(PRIOR, known), PRIOR, ABOVE).select(F.col(SUFFIX).alias(KEY), ABOVE)
    hosts = by(HOST, SUFFIX).join(suffixes, F.col(SUFFIX) == F.col(KEY), "left").withColumn(ABOVE, F.coalesce(ABOVE, known))
    hosts = written(smoothed(hosts, ABOVE, PRIOR).select(F.col(HOST).alias(P), F.transform(PRIOR, lambda x: F.log(x)).alias(PRIOR)), "hosts")

    joined = scored.join(hosts, F.col(HOST) == F.col(P), "left").join(F.broadcast(told), F.col(TAG) == F.col(KEY), "left")
    plus = lambda a, b: a + b
    fused = F.zip_with(F.zip_with(LOGS, F.coalesce(PRIOR, F.array(*map(F.lit, np.log(prior).tolist()))), plus), F.coalesce(TOLD, F.array_repeat(F.lit(0.0), size)), plus)
    joined = joined.withColumn(FUSED, fused).withColumn(BEST, F.array_max(FUSED))
    joined = joined.withColumn(AT, F.array_position(FUSED, F.col(BEST)).cast("int"))  # ties: the first tag in alphabetical order
    result = joined.select(
        *[F.col(f"`{c}`") for c in kept],
        F.element_at(F.array(*map(F.lit, languages)), F.col(AT)).alias("language"),
        (1 / added(F.transform(FUSED, lambda x: F.exp(x - F.col(BEST))))).alias("posterior"),
        (F.exp(F.element_at(LOGS, F.col(AT)) - top) / added(relative)).alias("text_posterior"),
        F.col(TEXT).cast("string").rlike(r"\p{L}").alias(mark + "letter"),
    )
    accepted = (F.col("language") != NONE) & (F.col("posterior") >= min_posterior) & F.col(mark + "letter")
    return result.withColumn("accepted", accepted).drop(mark + "letter")
