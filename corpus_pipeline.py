"""The training-data pipeline: five stages over ``documents``, each written and read again.

The result is the packed training data: a row for each piece of a document with its token
ids, its sequence and its place there. A null text is rejected by the first stage; equal
rows are near-duplicates of each other, so one of them is left before the mix repeats
any; an empty table gives no pieces; further columns go through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexiforge.llm import mixing, packing, quality, simhash, suffix_dedup
from lexiforge.staging import discard, staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.drop_repeats(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.resample(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_with_ids(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("source_mix", source_mix),
    ("best_fit_packing", packed_sequences),
]

#: The stages' hashing, tokenising and rounding are not expressible in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, staged(stage(spark, docs, sf_dir), name)
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
