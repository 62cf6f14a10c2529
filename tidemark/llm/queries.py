"""Queries of this folder's operators: thin, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, filter_audit, fingerprints, html_text, langid, licenses, lm, minhash, packing, pii, quality, variants, warc
from .common import read_table, stored


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(read_table(spark, sf_dir, "documents"))


def op2_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(read_table(spark, sf_dir, "documents"))
    return packing.pack(stored(pieces, "pieces"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(read_table(spark, sf_dir, "pages"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(read_table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_documents(read_table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(read_table(spark, sf_dir, "documents"), keep_ids=False)


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(read_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    terms = pii.listed(F.col("terms"), F.lit("term"))
    base = pii.listed(F.col("base"))
    return found.select(F.col("id").alias("doc_id"), *map(count, pii.PATTERNS), F.sha2(base, 256).alias("base_sha256"), F.concat_ws(",", F.when(base != "", base), F.when(terms != "", terms)).alias("spans"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents")).drop("root", "tid")


def op10_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.responses(read_table(spark, sf_dir, "pages")))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read_table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_lm_score, op2_pack_sequences, op3_html_text, op4_fingerprints, op5_license_scan, op6_byte_bpe, op7_personal_data, op8_quality_rules, op9_near_duplicates, op10_warc_derivatives, op11_language_id, op12_filter_audit, op13_spelling_variants]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    """The others hash, parse or tokenize, which has no SQL form; tests hold each against brute force."""
    return {"op12_filter_audit": filter_audit.ORACLE_SQL, "op13_spelling_variants": variants.ORACLE_SQL}
