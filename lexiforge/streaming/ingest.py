"""Streaming ingest (an extension): new dictionary files are scanned as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.dictionary import scan_files


def stream_files(spark: SparkSession, folder: str, out: str, checkpoint: str, patches: list[dict] | None = None):
    """Scan the XML files of ``folder`` into a Parquet table of node rows; one micro-batch at a time."""
    raw = spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", "*.xml").load(folder)
    files = raw.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))

    def write(batch: DataFrame, _: int) -> None:
        scan_files(batch, patches).write.mode("append").parquet(out)

    return files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
