"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallycart.llm import line_dedup, minhash_dedup, packing, quality_crf, tiling
from tallycart.llm.encoder import vocabulary
from tallycart.session import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose content lines hold enough of their words."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    field = quality_crf.fit(quality_crf.sample_lines(docs, labels))
    return quality_crf.keep_content(docs, field)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that another document keeps for them."""
    return line_dedup.dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return minhash_dedup.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return tiling.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the token sequences."""
    return packing.pack_documents(docs, vocabulary())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", drop_lines),
    ("near_dedup", near_duplicates),
    ("decontamination", decontaminate),
    ("packing", pack),
]

# Labelling lines, tiling and token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
