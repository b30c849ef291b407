"""The registered queries opN_<name> and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, arc_to_warc, bloom_lm, collocations, langid, licences, line_crf, line_dedup, packing, pii, sentencepiece_codec, simhash, topk
from .common import read_table, shared_path, small_batches, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return add


TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
e AS (SELECT vec_id, unnest(v) AS x, unnest(range(len(v))) AS d FROM v),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score
  FROM e q JOIN e c ON q.d = c.d AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@register("op1_topk", TOPK_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


WARC_SQL = """
WITH raw AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages),
digits AS (
  SELECT hex AS h, string_agg(
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, 1 + 10 * (k // 8), 10))::BIGINT >> (35 - 5 * (k % 8))) & 31)::INT, 1), '' ORDER BY k) AS payload_digest
  FROM (SELECT DISTINCT hex FROM raw), range(32) r(k) GROUP BY hex),
kept AS (SELECT html, max(page_id) AS newest FROM raw GROUP BY html)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> newest THEN newest END AS refers_to
FROM raw JOIN digits ON hex = h JOIN kept USING (html)
"""


@register("op2_arc_to_warc", WARC_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = arc_to_warc.pages_to_warc(read_table(spark, sf_dir, "pages"), shared_path(spark, "warc"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op3_bloom_lm")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_lm.score(read_table(spark, sf_dir, "documents"))


LINES_SQL = """
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM docs),
keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
frequent AS (
  SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT k.doc_id, k.pos, k.line, f.key IS NOT NULL AND k.doc_id <> f.holder AS lost FROM keyed k LEFT JOIN frequent f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@register("op4_line_dedup", LINES_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@register("op5_line_crf")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return line_crf.quality(docs, line_crf.train(docs, read_table(spark, sf_dir, "labels"))).drop("line_labels")


@register("op6_sentencepiece")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    coded = sentencepiece_codec.encode_decode(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@register("op9_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@register("op7_langid")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = langid.identify(docs, declared=F.col("lang"), host=F.col("source"))
    return found.select("doc_id", F.col("lang").alias("declared"), "language", "posterior", "text_posterior", F.col("accepted").alias("kept"))


@register("langid_pages")
def langid_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 7 where all its evidence is at hand: the markup's language, the address suffix and the host of each page."""
    pages = read_table(spark, sf_dir, "pages")
    html = F.coalesce("html", F.lit(""))
    visible = pages.withColumn("visible", F.regexp_replace(html, r"(?s)<script.*?</script>|<style.*?</style>|<[^>]*>", " "))
    tag = F.regexp_extract(html, r'<html[^>]*\blang="([^"]*)"', 1)
    found = langid.identify(visible, text="visible", declared=tag, host=F.regexp_extract(F.coalesce("url", F.lit("")), "//([^/:]+)", 1))
    return found.select("page_id", tag.alias("declared"), "language", "posterior", "text_posterior", F.col("accepted").alias("kept"))


@register("op8_simhash")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, threshold=2)


@register("op10_pii")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs))
    counts = [pii.count(F.col("base_spans"), k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.spans_text(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"), pii.spans_text(F.col("spans")).alias("spans"))


PHRASES_SQL = r"""
WITH pieces AS (
  SELECT lang, unnest(pieces) AS piece, unnest(range(doc * 10000000, doc * 10000000 + len(pieces))) AS id FROM (
    SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc,
      string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents)),
split AS (SELECT lang, id, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
words AS (SELECT lang, id, unnest(ws) AS w1, unnest(range(len(ws))) AS pos FROM split),
runs AS (SELECT lang, w1, lead(w1) OVER p AS w2, lead(w1, 2) OVER p AS w3 FROM words WINDOW p AS (PARTITION BY id ORDER BY pos)),
sizes AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
f1 AS (SELECT lang, w1, count(*) AS f FROM runs GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*) AS f FROM runs WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM runs WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
longer AS (
  SELECT lang, w1, w2, max(f) AS f FROM (SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY ALL),
cuts AS (
  SELECT c.lang, c.w1 || ' ' || c.w2 AS phrase, c.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM f2 c JOIN f1 x ON x.lang = c.lang AND x.w1 = c.w1 JOIN f1 y ON y.lang = c.lang AND y.w1 = c.w2
  LEFT JOIN longer o ON o.lang = c.lang AND o.w1 = c.w1 AND o.w2 = c.w2 WHERE o.f IS NULL OR 100 * o.f < 50 * c.f
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, 1, x.f, y.f
  FROM f3 c JOIN f1 x ON x.lang = c.lang AND x.w1 = c.w1 JOIN f2 y ON y.lang = c.lang AND y.w1 = c.w2 AND y.w2 = c.w3
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, 2, x.f, y.f
  FROM f3 c JOIN f2 x ON x.lang = c.lang AND x.w1 = c.w1 AND x.w2 = c.w2 JOIN f1 y ON y.lang = c.lang AND y.w1 = c.w3),
scored AS (SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""


@register("op11_collocations", PHRASES_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"), max_words=3, least=10, covered=50, top=2000)


@register("op12_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    aligned = alignment.align(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, model)
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    with small_batches(spark):
        aligned = written(aligned.select("doc_id", "n_a", "n_b", "n_groups", digest.alias("groups_sha256"), "links"), "aligned")
    counts = written(alignment.pair_counts(aligned, pieces=sentencepiece_codec.load(model).get_piece_size()), "pairs")
    return alignment.count_links(aligned, counts)


@register("op13_licences")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan_licences(read_table(spark, sf_dir, "documents"))
    joined = {c: F.array_join(c, ",").alias(c) for c in ("base_labels", "labels")}
    return found.select(*[joined.get(c, c) for c in found.columns if c != "expressions"], F.array_join("expressions", "; ").alias("expressions"))
