"""A training-data pipeline over ``documents``: each stage works on what its predecessor kept."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import webgraph_spark
from webgraph_spark.llm import mixing, near_dup, packing, quality_rules, secret_scan
from webgraph_spark.llm.queries import documents, tokenizer_path
from webgraph_spark.session import cut_lineage

# Python workers get the operators with the task; the package need not be installed there.
cloudpickle.register_pickle_by_value(webgraph_spark)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the limits nor the robust estimates reject."""
    return quality_rules.filter_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dup.deduplicate(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced by a mark."""
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.take(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents, each with its place in a sequence."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality_rules", keep_good),
    ("near_dedup", drop_near_copies),
    ("secret_scans", hide_secrets),
    ("mixing", mix_sources),
    ("packing", pack),
]

# Robust estimates and tokens cannot be written in SQL; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each one's rows are written before the next reads them."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
