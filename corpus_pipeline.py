"""A training-data pipeline over ``documents``, each stage one operator of ``emberfold.llm``.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; its result is
written as Parquet in the shared folder and read back for the next one. The stages return the
columns of documents, the last one the packed pieces.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from emberfold.llm import best_fit_packing, jaccard_join, line_simjoin, risk_quality, source_schedule
from emberfold.llm.common import table
from emberfold.session import cut_lineage, delete_scratch, drop_tables, scratch_tables

# Scratch tables that the latest stage has left.
_left: list[str] = []


def stage(function):
    """A stage that first deletes the scratch tables of the stage before.

    A stage's result is written and reread before the next one begins, so nothing depends on them then.
    """

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        delete_scratch(spark, _left)
        _left.clear()
        before = set(scratch_tables())
        out = function(spark, docs, sf_dir)
        _left.extend(path for path in scratch_tables() if path not in before)
        return out

    return run_stage


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the risk-controlled quality rules."""
    return risk_quality.keep_good(docs, table(spark, sf_dir, "labels"))


@stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier one."""
    return line_simjoin.dedup_lines(docs)


@stage
def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8."""
    return jaccard_join.one_of_each(docs, width=5, percent=80)


@stage
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row per document and pass over its source, so up to three of a document."""
    return source_schedule.mixed_documents(docs)


@stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place in it."""
    return best_fit_packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("mixing sources to target weights", source_mix),
    ("best-fit packing", packing),
]
# Tokenising and packing have no SQL form; the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, function) in enumerate(STAGES):
        read, docs = docs, cut_lineage(function(spark, docs, sf_dir))
        if number:
            drop_tables(read)
    return docs
