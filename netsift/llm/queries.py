"""The registered queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chunks, decontam, jaccard, langid, lblm, mixing, negatives, quality, repair, tokenstore, toxicity, urlgraph, warc
from .common import table


def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_gear_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chunks.dedupe(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", F.coalesce(F.size("spans"), F.lit(0)).alias("n_spans"), F.coalesce(removed, F.lit(0)).alias("removed_bytes"), "spans", "sources", "text")


def op3_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlgraph.filter_urls(table(spark, sf_dir, "pages"))


def op4_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op6_quality_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly")


def op7_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


def op8_toxicity_nnpu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_language_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op10_logbilinear_nce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lblm.score_texts(table(spark, sf_dir, "documents"))


def op11_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    store = tokenstore.write_store(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return tokenstore.lookup(tokenstore.keys_of(docs), store).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows are damaged by a checksum of their key before they are repaired; nulls in them are one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    damage = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(damage == 1, "").when(damage == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    rows = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.when(damage == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"), F.when(damage == 0, 0).when(damage == 3, 2).otherwise(1).alias("times"),
    )
    return repair.repair(rows)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", moved.alias("label"), F.col("embedding").alias("vector"))
    return negatives.mine(vectors, F.col("vec_id") % 50 == 0)


QUERIES = {f.__name__: f for f in (op1_warc_revisits, op2_gear_chunks, op3_url_trust, op4_latent_decontamination, op5_ngram_jaccard, op6_quality_forest, op7_entropy_mix, op8_toxicity_nnpu, op9_language_cnn, op10_logbilinear_nce, op11_token_index, op12_conversation_repair, op13_hard_negatives)}

ORACLE_SQL = {
    "op1_warc_revisits": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        h AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM h)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
        FROM f""",
    "op13_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS q
                   FROM embeddings WHERE label IS NOT NULL AND len([x for x in embedding if isfinite(x)]) = len(embedding)),
        s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
              FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
        p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS n FROM s WHERE same) WHERE n <= 5),
        r AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
                     CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
              FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 3""",
}
