"""The registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from remitspark.llm import divergence, embedding_dedup, fingerprints, line_dedup, merkle, minhash_dedup, mixing, packing, pii, quality, substring_dedup, toxicity, warc_zip
from remitspark.llm.common import table
from remitspark.session import scratch_folder

Query = Callable[[SparkSession, str], DataFrame]


def op1_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer=tokenizer)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.remove_boilerplate(table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "clean_text", "n_lines", "n_removed")


def op3_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("row.doc_id", "log_ratio", "log_weight", "kept")


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op5_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder = scratch_folder(spark, "archives")
    warc_zip.write_archives(warc_zip.roles(pages, "page_id", "html", "url"), folder)
    kind = pages.schema["page_id"].dataType
    return warc_zip.read_archives(spark, folder).select(
        F.col("page_id").cast(kind),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind),
    )


def op6_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_versions(table(spark, sf_dir, "documents"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=2)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "clean_text", "removed", "n_removed")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    altered = {"text": F.when(hit, merkle.lowered(text)).otherwise(text)}
    return merkle.manifest(table(spark, sf_dir, "documents"), altered=altered)


QUERIES: dict[str, Query] = {
    "op1_pack_sequences": op1_pack_sequences,
    "op2_line_dedup": op2_line_dedup,
    "op3_quality_resampling": op3_quality_resampling,
    "op4_mix_sources": op4_mix_sources,
    "op5_warc_round_trip": op5_warc_round_trip,
    "op6_toxic_spans": op6_toxic_spans,
    "op7_document_fingerprints": op7_document_fingerprints,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_source_divergence": op11_source_divergence,
    "op12_personal_data": op12_personal_data,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": line_dedup.ORACLE,
    "op5_warc_round_trip": warc_zip.ORACLE,
    "op11_source_divergence": divergence.ORACLE,
    "op13_merkle_manifest": merkle.ORACLE,
}
