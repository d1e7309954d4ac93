"""Cleaning documents: normal form, length and language filters, chunks, and the record of a stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.functions import text as X


def adapted(documents: DataFrame) -> DataFrame:
    """The documents table in the engine's shape: string ids, a file name, text and language."""
    return documents.select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.coalesce("source_file", F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".pdf"))).alias("source_file"),
        F.coalesce("text", F.lit("")).alias("text"),
        "lang",
    )


def clean_reason(text: Column, lang: Column, least: int = 200, language: str = "en") -> Column:
    """Why a normalised document is dropped: too short before not in the language; null where it is kept."""
    return F.when(F.length(text) < least, "too_short").when(F.coalesce(lang, F.lit("unknown")) != language, "non_english")


def cleaned(docs: DataFrame, least: int = 200, language: str = "en") -> DataFrame:
    """All documents, normalised, with char_count and the reason for which they are dropped."""
    own = docs.withColumn("text", X.normalize("text"))
    return own.withColumn("char_count", F.length("text")).withColumn("reason", clean_reason(F.col("text"), F.col("lang"), least, language))


def chunked(docs: DataFrame, size: int = 180, least: int = 120) -> DataFrame:
    """One row a chunk: (chunk_id, doc_id, source_file, year, idx, text); idx counts kept chunks only."""
    cut = docs.select("doc_id", "source_file", X.document_year("doc_id", "text").alias("year"), F.posexplode(X.chunks("text", size, least)).alias("idx", "text"))
    return cut.select(F.concat("doc_id", F.lit("__"), F.col("idx").cast("string")).alias("chunk_id"), "doc_id", "source_file", "year", "idx", "text")


def rank(year: str = "year", doc: str = "doc_id", idx: str = "idx") -> Column:
    """The order chunks are visited in, newest document first, as a struct that compares; no global sort is needed."""
    return F.struct((-F.col(year)).alias("older"), F.col(doc).alias("doc"), F.col(idx).alias("idx"))


def stage_record(stage: str, before: DataFrame, reason: str = "reason", known: tuple[str, ...] = ()) -> DataFrame:
    """One row: rows in, out and removed, and the count of each reason; reasons in `known` are there even at 0."""
    counts = before.groupBy(F.col(reason).alias("reason")).agg(F.count("*").alias("n"))
    if known:
        zero = before.sparkSession.createDataFrame([(k, 0) for k in known], "reason string, n bigint")
        counts = counts.unionByName(zero).groupBy("reason").agg(F.sum("n").alias("n"))
    return counts.agg(
        F.lit(stage).alias("stage"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("docs_in"),
        F.coalesce(F.sum(F.when(F.col("reason").isNull(), F.col("n"))), F.lit(0)).alias("docs_out"),
        F.coalesce(F.sum(F.when(F.col("reason").isNotNull(), F.col("n"))), F.lit(0)).alias("removed"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("reason").isNotNull(), F.struct("reason", "n"))))).alias("reason_counts"),
    )
