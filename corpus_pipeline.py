"""A training corpus from the table `documents`, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before
kept; all but the last return the columns of `documents`. Missing texts have no
words and go in the first stage; an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsmetrics.llm.common import attach, documents, staged
from opsmetrics.llm.jaccard_join import jaccard_components
from opsmetrics.llm.mixing import mix_sources
from opsmetrics.llm.packing import pack_documents
from opsmetrics.llm.quality_rules import judge_documents
from opsmetrics.llm.secret_scan import redacted, scan_secrets

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

# Near duplicates: five-word shingles, a similarity of 0.8 or more.
SHINGLE = 5
LINK = (80, 100)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that fail the base rule or lie outside their group."""
    return judge_documents(docs, COLUMNS).filter("kept").select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest doc_id.

    doc_id is taken for a key: rows that share one stay or go together, and of
    wholly equal rows one stays.
    """
    found = staged(jaccard_components(docs.select("doc_id", "text"), SHINGLE, LINK), "pipeline-groups")
    of_id = found.groupBy("doc_id").agg(
        F.max(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("_stays"),
        F.count(F.lit(1)).alias("_rows"),
    )
    # Only documents that go, or occur more than once, are looked up.
    marked = staged(of_id.filter("NOT _stays OR _rows > 1"), "pipeline-marked")
    kept = attach(docs.select(COLUMNS), marked, ["doc_id"]).filter(
        F.coalesce("_stays", F.lit(True))
    )
    if marked.filter("_stays AND _rows > 1").isEmpty():
        return kept.select(COLUMNS)
    single = F.coalesce("_rows", F.lit(1)) == 1
    repeated = kept.filter(~single).select(COLUMNS).dropDuplicates()
    return kept.filter(single).select(COLUMNS).unionByName(repeated)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, each secret replaced by a mark."""
    found = F.size("secrets") > 0
    cleaned = scan_secrets(docs.select(COLUMNS)).select(
        "doc_id", redacted(F.col("text"), F.col("secrets")).alias("text"), "lang", "source",
        "n_chars", found.alias("_found"),
    )
    length = F.when(F.col("_found"), F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", length).select(COLUMNS)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, each as often as it does."""
    mixed = mix_sources(docs.select(COLUMNS)).filter("copies > 0")
    return mixed.select(*COLUMNS, F.explode(F.sequence(F.lit(1), F.col("copies")))).select(COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the sequences."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scans", secret_scans),
    ("source_mixing", source_mixing),
    ("packing", packing),
]

# SQL expresses neither the estimates nor the tokenizer: see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
