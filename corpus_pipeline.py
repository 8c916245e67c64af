"""A pipeline that makes packed training sequences from raw documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet to the shared folder and read again as the next stage's
documents.  All stages but the last return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from covaria.llm import decontaminate, packing, simhash, templates, toxicity
from covaria.session import cut_lineage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go; the model is fitted on the labelled ones among `docs`."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_civil(docs, toxicity.train(toxicity.labelled(docs, labels)))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates and recurring short lines go from all documents but the first; no document goes."""
    return templates.drop_templates(docs, short=True)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints one row stays, that of the smallest id."""
    return simhash.keep_one(docs, by_row=True)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go, each row by its own text."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), by_id=False)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as one or more pieces, each with its place in a bin."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("best_fit_packing", pack_sequences),
]
# Trained trees and a greedy packing are beyond SQL: the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
