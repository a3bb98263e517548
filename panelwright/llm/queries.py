"""Registered queries of the text operators and their DuckDB statements.

Each query applies its operator with production parameters to its whole
table and derives the result's digest columns from the operator's output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from . import alignment, bpe, exact, packing, projections, repeats, secrets, simhash, token_store, toxicity, variants, viterbi, warc


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    store = token_store.write_store(docs, end_id=2)
    return store.read(token_store.keys_of(docs), with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), words=4, radius=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_tokens and ids_crc32 of the ids; the decoded text's code points and
    SHA-256."""
    made = viterbi.encode(read_table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n_tokens", F.crc32("ids").alias("ids_crc32"), F.length("decoded").cast("long").alias("n_chars"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(read_table(spark, sf_dir, "pages"))
    return archives.read(with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(read_table(spark, sf_dir, "documents"), end_id=0, size=2048)
    return packing.pack(pieces, size=2048).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.exact_groups(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    made = toxicity.score(docs, toxicity.fit(docs, labels))
    return made.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                       F.size("offending").alias("n_offending"))


def op8_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(read_table(spark, sf_dir, "documents"), length=200)


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(read_table(spark, sf_dir, "documents"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))
    base = of(*secrets.BASE)
    count = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in secrets.BASE]
    return found.select("doc_id", *count, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op10_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = projections.near_duplicates(read_table(spark, sf_dir, "embeddings"), threshold=0.95)
    return found.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = variants.count_words(read_table(spark, sf_dir, "documents"), every=31, length=7, least=2)
    return variants.group_variants(words, ratio=10)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read_table(spark, sf_dir, "documents"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = bpe.decode(bpe.encode(read_table(spark, sf_dir, "documents")))
    return made.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


QUERIES = {f.__name__: f for f in (op1_token_store, op2_simhash, op3_sentencepiece, op4_warc, op5_packing, op6_exact_dedup,
                                   op7_toxicity, op8_suffix_array, op9_secrets, op10_projections, op11_spelling_variants,
                                   op12_alignment, op13_bpe)}

ORACLE = {
    "op4_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
q AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS d,
             CASE WHEN octet_length(b) >= 1000 THEN max(page_id) OVER (PARTITION BY b) END AS lead FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN lead IS NULL OR lead = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN lead = page_id THEN NULL ELSE lead END AS refers_to
FROM q""",
    "op6_exact_dedup": r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept,
       sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)""",
    "op10_projections": """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.x, b.x) >= 0.95),
r AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT v.vec_id, (SELECT count(*) FROM l WHERE l.a = v.vec_id) AS n_links, min(r.b) AS component_id, min(r.b) = v.vec_id AS kept
FROM v JOIN r ON r.a = v.vec_id GROUP BY v.vec_id""",
}
