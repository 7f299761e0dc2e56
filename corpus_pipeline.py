"""A training corpus from raw documents: classify, clean, deduplicate, mix, encode.

Each stage takes (spark, docs, folder of the tables) and returns a DataFrame; all but the last
return the columns of the documents. ``run`` writes the result of each stage to the shared
folder and gives it to the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakezones.llm import bpe, mixing, near_dedup, quality_classifier, quality_rules
from lakezones.llm.queries import table, tokenizer
from lakezones.llm.shipping import prepared
from lakezones.session import stage


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier accepts; it learns from those given here."""
    spark = prepared(spark)
    return quality_classifier.accepted_documents(docs, table(spark, sf_dir, "labels"))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the quality rules, without the lines that fail them."""
    prepared(spark)
    return quality_rules.passing_documents(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity from 0.8."""
    prepared(spark)
    return near_dedup.one_of_each_group(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    prepared(spark)
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The number of tokens of each document, and digests of its ids and of the decoded text."""
    prepared(spark)
    return bpe.round_trip_digests(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", classify),
    ("quality_rules", clean),
    ("minhash_near_dedup", deduplicate),
    ("mixing", mix),
    ("bpe_round_trip", encode),
]

# The classifier's model and the tokenizer are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    spark = prepared(spark)
    docs = table(spark, sf_dir.rstrip("/"), "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir.rstrip("/")), name)
    return docs
