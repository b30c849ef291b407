"""The corpus pipeline: documents through five operators of tasador.llm.

Rows may have null ids, texts, languages and sources; each stage says what becomes
of them. Tables may have further columns, which a stage keeps where it keeps
rows. Each stage reads what the one before kept, as a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasador.llm import langid, line_dedup, packing, pii, simhash
from tasador.llm.common import read_table, ship_package, written


def with_text(docs: DataFrame, text) -> DataFrame:
    """The documents with another text and its length."""
    out = docs.withColumn("__new", text)
    return out.select(*[{"text": F.col("__new"), "n_chars": F.length("__new").cast("long")}.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no known language, or without a letter, go; ``lang``
    becomes the language found."""
    found = langid.identify(docs, declared=F.col("lang"), host=F.col("source")).filter("accepted")
    return found.select(*[F.col("language" if c == "lang" else f"`{c}`").alias(c) for c in docs.columns if c not in ("language", "posterior", "text_posterior", "accepted")])


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines held by many documents stay in one of them only."""
    deduped = line_dedup.dedup_lines(docs)
    return with_text(deduped, F.col("kept_text")).drop("kept_text", "n_lines", "n_dropped")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group one row stays, that of its least id; of rows that share an id, texts of
    different groups are each judged by their own. Of equal ids and texts one row stays. Rows without
    an id stay."""
    digest = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    keyed = docs.filter("doc_id is not null").select(F.struct(F.col("doc_id").alias("id"), digest.alias("digest")).alias("key"), "text")
    groups = simhash.near_duplicates(keyed, key="key", shingle=3, threshold=2)
    first = written(groups.filter("key = component_id").select(F.col("key.id").alias("__id"), F.col("key.digest").alias("__of")).distinct(), "first")
    named = docs.withColumn("__digest", digest)
    kept = named.join(first.hint("merge"), (F.col("doc_id") == F.col("__id")) & (F.col("__digest") == F.col("__of")), "left_semi")
    return kept.dropDuplicates(["doc_id", "__digest"]).drop("__digest").unionByName(docs.filter("doc_id is null"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to their kind's name in brackets."""
    found = pii.find(docs, pii.fit(docs))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return with_text(found, F.when(F.size("spans") > 0, pii.redact(text, F.col("spans"))).otherwise(text)).drop("base_spans", "spans")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def shipped(stage):
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark.sparkContext.applicationId)
        return stage(spark, docs, sf_dir)

    return run


STAGES = [
    ("language_id", shipped(language_id)),
    ("line_dedup", shipped(drop_repeated_lines)),
    ("simhash", shipped(drop_near_duplicates)),
    ("pii", shipped(redact_personal_data)),
    ("packing", shipped(pack_sequences)),
]

#: SQL cannot express the language model, the fingerprints, the boosted trees or the
#: tokeniser; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
