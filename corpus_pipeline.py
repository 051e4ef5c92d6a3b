"""The corpus pipeline: quality rules, exact dedup, SimHash near-dedup, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm.common import materialise, read_table
from ledgerlake.llm.exact_dedup import drop_exact
from ledgerlake.llm.mixing import mix_documents
from ledgerlake.llm.packing import pack
from ledgerlake.llm.quality import fit_quality, keep_quality
from ledgerlake.llm.simhash import drop_near


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return keep_quality(docs, fit_quality(docs, read_table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return drop_exact(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of fingerprints within 2 bits (3-word shingles) the smallest doc_id stays."""
    return drop_near(docs, shingle=3, max_bits=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: repeated, once, or not at all."""
    return mix_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed documents' pieces with their bins."""
    return pack(docs)


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact_dedup), ("simhash_near_dedup", simhash_near_dedup),
          ("mix_sources", mix_sources), ("best_fit_packing", best_fit_packing)]

# Boosted trees, SimHash and best-fit search are not SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
