"""The queries of this subpackage, each over whole tables, and their SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import exact_dedup, fill_in_middle, fingerprints, jaccard_join, language_id, license_scan, mixing, packing, quality_classifier, quality_rules, sharding, spelling, url_filter
from .common import table


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(spark, table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(spark, table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(spark, table(spark, sf_dir, "documents"), windows=True)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(spark, docs, language_id.train(docs))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(spark, table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers  # where it is missing, only this query is

    return packing.pack_documents(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(spark, table(spark, sf_dir, "pages"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_classifier.score_quality(spark, docs, quality_classifier.train(docs, table(spark, sf_dir, "labels")))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(spark, table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents")))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(spark, table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(spark, table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_jaccard_join, op2_mixing, op3_license_scan, op4_quality_rules, op5_language_id, op6_sharding, op7_packing, op8_url_filter, op9_quality_classifier, op10_exact_dedup, op11_fill_in_middle, op12_fingerprints, op13_spelling_variants)}
ORACLE_SQL = {
    "op1_jaccard_join": jaccard_join.ORACLE_SQL,
    "op2_mixing": mixing.ORACLE_SQL,
    "op3_license_scan": license_scan.ORACLE_SQL,
    "op4_quality_rules": quality_rules.ORACLE_SQL,
    "op10_exact_dedup": exact_dedup.ORACLE_SQL,
    "op11_fill_in_middle": fill_in_middle.ORACLE_SQL,
    "op13_spelling_variants": spelling.ORACLE_SQL,
}
