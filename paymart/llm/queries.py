"""The operators as queries over whole tables, and SQL for those SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from paymart.llm import alignment, bpe_chunks, decontaminate, fingerprints, hard_negatives, html_text, lm_scoring, mixing, near_dedup, quality, secrets, substring_dedup, warc_zip
from paymart.llm.shared import broadcast_if_small, table


def op1_secret_scans(spark, sf_dir):
    """Every candidate of every text; the value itself is given as a digest."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256")
    return found.select("doc_id", "start", "length", digest, "probability", "is_secret")


def op2_substring_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return substring_dedup.kept_digest(substring_dedup.remove_repeats(docs, length=20, start=10, stop=20))


def op3_fingerprints(spark, sf_dir):
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op4_source_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return mixing.mix_sources(docs, mixing.word_count(F.col("text"))).select(
        "doc_id", "source", "size", "source_size", "target", "epochs", "taken"
    )


def op5_lm_scoring(spark, sf_dir):
    """All documents, against those labelled good and not toxic."""
    good = table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0").select("doc_id").distinct()
    good = broadcast_if_small(good.withColumn("is_good", F.lit(True)), row_bytes=16)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").join(good, "doc_id", "left")
    return lm_scoring.cross_entropy_difference(docs, F.col("is_good"))


def op6_warc_zip(spark, sf_dir):
    archives = warc_zip.write_archives(table(spark, sf_dir, "pages"))
    return warc_zip.read_records(archives, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op7_decontamination(spark, sf_dir):
    return decontaminate.benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_near_duplicates(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85, shingle=3)


def op9_html_text(spark, sf_dir):
    return html_text.main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op10_quality_classifier(spark, sf_dir):
    """Good is labelled of quality and not toxic."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.score_documents(docs, quality.train(docs, labels, quality.is_good()))


def op11_bpe_chunks(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return bpe_chunks.with_digests(bpe_chunks.encoded(docs, public_tokenizers.path("word_bpe_49k.json")))


def op12_token_alignment(spark, sf_dir):
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.alignment_counts(table(spark, sf_dir, "documents"), *paths)


def op13_hard_negatives(spark, sf_dir):
    """Anchors are every hundredth id; every seventh id gets a wrong label first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


QUERIES = {
    "op1_secret_scans": op1_secret_scans,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_fingerprints": op3_fingerprints,
    "op4_source_mixing": op4_source_mixing,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_warc_zip": op6_warc_zip,
    "op7_decontamination": op7_decontamination,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_html_text": op9_html_text,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_bpe_chunks": op11_bpe_chunks,
    "op12_token_alignment": op12_token_alignment,
    "op13_hard_negatives": op13_hard_negatives,
}
