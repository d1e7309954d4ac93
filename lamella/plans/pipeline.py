"""The whole curation as one plan: clean, heal, cut into chunks, deduplicate, filter, tag, redact, curate."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamella.functions import text as X
from lamella.functions.joins import prefix_sums
from lamella.operators import clean, dedup, filters, heal, quality, redact
from lamella.session import written
from lamella.sources import files


@dataclass
class Curated:
    records: DataFrame
    chunks: DataFrame
    healed: DataFrame
    stages: list[DataFrame] = field(default_factory=list)

    def summary(self) -> list[dict]:
        """One dict a stage, in order; each is one small row."""
        return [s.first().asDict(recursive=True) for s in self.stages]


class EmptyStage(RuntimeError):
    """A stage let nothing through."""


def some(rows: DataFrame, stage: str, stop: bool) -> DataFrame:
    """rows, which are written; where `stop` is set and there are none, EmptyStage."""
    if stop and rows.isEmpty():
        raise EmptyStage(f"{stage} let nothing through")
    return rows


def curate(docs: DataFrame, language: str = "en", furniture: dict | None = None, keywords: list[str] = quality.KEYWORDS, cache: DataFrame | None = None, people=None, pages: DataFrame | None = None, compare: bool = False, stop: bool = False) -> Curated:
    """Documents (doc_id, source_file, text, lang) to curated records; a stage that lets nothing through raises EmptyStage where `stop` is set.

    Documents are the unit up to healing, chunks from deduplication on. Stages that a later one reads more than once are
    written to the shared folder, so nothing is computed twice and a lost executor costs no stage.
    """
    one = clean.cleaned(docs, language=language)
    kept = some(written(one.where("reason is null").drop("reason"), "cleaned"), "clean_langid", stop)
    well = written(heal.healed(kept.select("doc_id", "source_file", "text"), **(furniture or {})).select("doc_id", "source_file", "text"), "healed")
    two = written(dedup.deduplicated(clean.chunked(well)), "deduplicated")
    three = written(two.where("reason is null").drop("reason").withColumn("reason", quality.quality_reason("text")), "judged")
    some(two.where("reason is null"), "dedup", stop)
    good = some(three.where("reason is null").drop("reason"), "quality_filter", stop)
    tagged = quality.with_signal(quality.tagged(good, keywords), cache)
    if pages is not None:
        from lamella.operators.pages import located

        tagged = located(tagged, pages)
    safe = written(redact.redacted(tagged, people), "redacted")
    if compare:
        safe = safe.withColumn("failed_filters", filters.failed_filters("text"))
    stages = [
        clean.stage_record("clean_langid", one, known=("too_short", "non_english")),
        clean.stage_record("dedup", two, known=("exact_duplicate", "cross_doc_boilerplate", "intra_doc_near_duplicate")),
        clean.stage_record("quality_filter", three),
        clean.stage_record("pii_redact", safe.withColumn("reason", F.lit(None).cast("string"))),
    ]
    return Curated(files.curated(safe), safe, well, stages)


def drilldown(docs: DataFrame, chunks: DataFrame, kept: DataFrame, safe: DataFrame) -> DataFrame:
    """(doc_id, source_file, chunks, kept_chunks, pii_chunks): documents with three counts, 0 where a document has none."""
    a = chunks.groupBy("doc_id").agg(F.count("*").alias("chunks"))
    b = kept.groupBy("doc_id").agg(F.count("*").alias("kept_chunks"))
    c = safe.where("pii_redacted").groupBy("doc_id").agg(F.count("*").alias("pii_chunks"))
    own = docs.select("doc_id", "source_file")
    return own.join(a, "doc_id", "left").join(b, "doc_id", "left").join(c, "doc_id", "left").fillna(0, ["chunks", "kept_chunks", "pii_chunks"])


def residual(records: DataFrame) -> DataFrame:
    """(doc_id, entity_type) that redaction would still find in curated records."""
    again = redact.redacted(records.select(F.col("metadata.chunk_id").alias("doc_id"), "text"))
    return again.select("doc_id", F.explode("entities").alias("entity_type", "n")).select("doc_id", "entity_type")


def joined_documents(records: DataFrame, most: int = 8_000_000) -> DataFrame:
    """(source_file, part, text): the chunks of each file joined by a space, in order, in parts that begin at every `most` code points.

    A file, however large, is so many rows, none of which is larger than `most` and a chunk. Chunk numbers are numbered on
    over a file's documents in order of their ids.
    """
    idx = F.try_element_at(F.split("metadata.chunk_id", "__"), F.lit(-1)).cast("int")
    own = records.select(F.col("metadata.source_file").alias("source_file"), F.col("metadata.doc_id").alias("doc_id"), idx.alias("i"), "text").withColumn("n", F.length("text") + 1)
    sizes = own.groupBy("source_file", "doc_id").agg(F.sum("n").alias("all"))
    begin = F.coalesce(F.sum("all").over(Window.partitionBy("source_file").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = prefix_sums(own, ["source_file", "doc_id"], "i", "n").join(sizes.select("source_file", "doc_id", begin.alias("begin")), ["source_file", "doc_id"])
    placed = placed.withColumn("at", F.col("begin") + F.col("before")).withColumn("part", F.floor(F.col("at") / most))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda c: c["text"]), " ")
    return placed.groupBy("source_file", "part").agg(text.alias("text"))


def kept_share(stage: DataFrame) -> DataFrame:
    """A stage record with the share it let through, null where nothing came in."""
    return stage.withColumn("kept_share", F.try_divide("docs_out", "docs_in"))


def purity_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two rows, before and after healing."""
    return heal.purity(before).withColumn("side", F.lit("before")).unionByName(heal.purity(after).withColumn("side", F.lit("after")))


def normalised(docs: DataFrame) -> DataFrame:
    return docs.withColumn("text", X.normalize("text"))
