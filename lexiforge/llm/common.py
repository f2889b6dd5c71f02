"""What the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six white-space bytes that separate words.
SPACE_CLASS = r"[\x09-\x0D\x20]"
WORD_CLASS = r"[^\x09-\x0D\x20]"
SPACES = "\t\n\x0b\x0c\r "

LEAST = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: str | Column = "doc_id", of: int = 5) -> Column:
    """crc32 of the id as text, modulo ``of``; a null id counts as the empty text."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit(""))) % of


def word_array(text: Column) -> Column:
    """The words of a text, in order; none for a null or blank text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+"))


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_CLASS + "+")).cast("long")


def row_key(*columns: Column) -> Column:
    """128 bits of a SHA-256 over columns, nulls told from empty texts: the identity of a row's content."""
    told = [F.concat(F.when(c.isNull(), "n").otherwise(F.concat(F.lit("v"), F.octet_length(c.cast("string")).cast("string"), F.lit(":"))), F.coalesce(c.cast("string"), F.lit(""))) for c in columns]
    return F.substring(F.unhex(F.sha2(F.concat(*told), 256)), 1, 16)
