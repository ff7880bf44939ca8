"""The corpus pipeline: toxic documents go, one of each group of near copies stays, secrets are blotted out, and
what is left is packed into sequences. Every stage is a written table that the next one reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierflow.llm import minhash, packing, secret_scan, toxicity
from tierflow.llm.common import stage, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: five words to a shingle, similarity 0.8."""
    return minhash.keep_one(docs, k=5, threshold=0.8)


def blot_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; secrets in their texts are replaced by a mark."""
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each token piece of each document goes."""
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_copies), ("secrets", blot_secrets), ("packing", pack)]

# A trained classifier, likelihoods and a linear program are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
