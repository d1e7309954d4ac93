"""Stages that need nothing but a row, and exact copies inside a watermark, on a stream of documents.

Healing, near copies and families look at the whole corpus and stay batch work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.operators import clean, quality, redact


def curated_stream(docs: DataFrame, arrived: str, late: str = "1 day", language: str = "en") -> DataFrame:
    """A stream of (doc_id, source_file, text, lang, arrived) to redacted chunks, first copies within the watermark only."""
    kept = clean.cleaned(docs.withWatermark(arrived, late), language=language).where("reason is null")
    cut = kept.select("doc_id", "source_file", arrived, F.posexplode(clean.X.chunks("text")).alias("idx", "text"))
    cut = cut.withColumn("chunk_id", F.concat("doc_id", F.lit("__"), F.col("idx").cast("string"))).withColumn("hash", F.sha2("text", 256))
    good = cut.dropDuplicatesWithinWatermark(["hash"]).where(quality.quality_reason("text").isNull())
    return redact.redacted(quality.tagged(good)).drop("hash", "examples")


def write_stream(stream: DataFrame, path: str, checkpoint: str):
    """Append to parquet, exactly once, whatever is there now."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
