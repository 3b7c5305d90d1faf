"""The registered queries of the operators: (query, SQL or None) by name."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from opsmetrics.llm.common import documents
from opsmetrics.llm.fingerprints import fingerprint_report
from opsmetrics.llm.jaccard_join import jaccard_components
from opsmetrics.llm.license_scan import LICENCE_SQL, scan_licences
from opsmetrics.llm.mixing import MIX_SQL, mixed_sizes
from opsmetrics.llm.packing import pack_documents
from opsmetrics.llm.phrase_index import CONTAMINATION_SQL, contamination_report
from opsmetrics.llm.pivot_clustering import CLUSTER_SQL, cluster_report
from opsmetrics.llm.ppm_scores import scored_documents
from opsmetrics.llm.quality_classifier import quality_scores
from opsmetrics.llm.quality_rules import quality_report
from opsmetrics.llm.secret_scan import secret_report
from opsmetrics.llm.token_alignment import alignment_report
from opsmetrics.llm.warc_archives import archived_pages


def op1_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_sizes(documents(spark, sf_dir))


def op3_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op4_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op5_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_report(documents(spark, sf_dir))


def op6_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_documents(documents(spark, sf_dir))


def op7_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(documents(spark, sf_dir))


def op8_jaccard_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))


def op9_licence_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(documents(spark, sf_dir))


def op10_linked_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(documents(spark, sf_dir))


def op11_pivot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_report(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_report(
        documents(spark, sf_dir),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


def op13_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(
        documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    )


QUERIES = {
    "op1_quality_nbsvm": (op1_quality_nbsvm, None),
    "op2_source_mix": (op2_source_mix, MIX_SQL),
    "op3_packed_sequences": (op3_packed_sequences, None),
    "op4_zip_warc": (op4_zip_warc, None),
    "op5_bottom_k": (op5_bottom_k, None),
    "op6_ppm_scores": (op6_ppm_scores, None),
    "op7_quality_outliers": (op7_quality_outliers, None),
    "op8_jaccard_trie": (op8_jaccard_trie, None),
    "op9_licence_digests": (op9_licence_digests, LICENCE_SQL),
    "op10_linked_secrets": (op10_linked_secrets, None),
    "op11_pivot_clusters": (op11_pivot_clusters, CLUSTER_SQL),
    "op12_token_alignment": (op12_token_alignment, None),
    "op13_phrase_index": (op13_phrase_index, CONTAMINATION_SQL),
}
