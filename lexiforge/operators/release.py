"""Packaging a build: compressed copies, a manifest of checksums, and a gate on the validator's count."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sequence import number_rows


def compress(df: DataFrame, folder: str, column: str = "value") -> None:
    """Lines as gzip text parts."""
    df.select(column).write.mode("overwrite").option("compression", "gzip").text(folder)


def checksums(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(digest, name, n_bytes): the SHA-256 of each file below a folder, markers left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    return files.where(~name.rlike(r"^[._]")).select(F.sha2("content", 256).alias("digest"), name.alias("name"), F.col("length").alias("n_bytes"))


def manifest(sums: DataFrame) -> DataFrame:
    """One line a file, digest and name, in the order of names."""
    return sums.orderBy("name").select(F.concat("digest", F.lit("  "), "name").alias("value"))


def gate(invalid: int, floor: int) -> None:
    """Refuse a build with more invalid entries than the baseline has."""
    if invalid > floor:
        raise ValueError(f"{invalid} entries are invalid; the baseline allows {floor}")


def batches(df: DataFrame, order: list, size: int, out: str = "batch") -> DataFrame:
    """Rows dealt into batches of ``size`` in order, numbered from 0."""
    return number_rows(df, order, "__n").withColumn(out, F.floor((F.col("__n") - 1) / size).cast("long")).drop("__n")
