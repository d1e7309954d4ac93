"""Healing of page splices: recurring page furniture, words split by kerning, and purity before and after."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamella.functions import text as X
from lamella.operators import dedup
from lamella.session import written


def lines(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, line, sig, n_lines)."""
    split = docs.select("doc_id", F.split("text", "\n", -1).alias("ls")).select("doc_id", F.size("ls").alias("n_lines"), F.posexplode("ls").alias("pos", "line"))
    return split.withColumn("sig", X.signature("line"))


def line_stats(docs: DataFrame, least_chars: int = 8) -> DataFrame:
    """(doc_id, sig, occurrences, mean_gap, gap_cv, span) of each line signature that comes at least twice in a document."""
    own = lines(docs).where(F.length(F.regexp_replace("sig", " ", "")) >= least_chars)
    by = Window.partitionBy("doc_id", "sig").orderBy("pos")
    gaps = own.withColumn("gap", F.col("pos") - F.lag("pos").over(by))
    stats = gaps.groupBy("doc_id", "sig").agg(
        F.count("*").alias("occurrences"),
        F.avg("gap").alias("mean_gap"),
        F.try_divide(F.stddev_pop("gap"), F.avg("gap")).alias("gap_cv"),
        ((F.max("pos") - F.min("pos")) / F.max("n_lines")).alias("span"),
    )
    return stats.where("occurrences > 1")


def furniture(docs: DataFrame, repeats: int = 8, span: float = 0.5, cv: float = 0.5, least_gap: float = 10, most_gap: float = 150, least_chars: int = 8) -> DataFrame:
    """Signatures that come about once a page throughout a document."""
    s = line_stats(docs, least_chars)
    return s.where((F.col("occurrences") >= repeats) & (F.col("span") >= span) & (F.col("gap_cv") <= cv) & F.col("mean_gap").between(least_gap, most_gap))


def without_furniture(docs: DataFrame, found: DataFrame) -> DataFrame:
    """docs without the lines whose signature is furniture of that document; other documents are not taken apart at all."""
    hit = docs.join(found.select("doc_id").distinct(), "doc_id", "left_semi")
    kept = lines(hit).join(found.select("doc_id", "sig"), ["doc_id", "sig"], "left_anti")
    text = kept.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n").alias("healed"))
    flagged = docs.join(text, "doc_id", "left").join(found.select("doc_id").distinct().withColumn("_hit", F.lit(True)), "doc_id", "left")
    return flagged.withColumn("text", F.when(F.col("_hit"), F.coalesce("healed", F.lit(""))).otherwise(F.col("text"))).drop("healed", "_hit")


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): words of letters a to z, in lower case, over all documents."""
    return docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


_LETTERS = re.compile("[A-Za-z]+")


def joined_splits(text: str, good: set[str]) -> tuple[str, list[str]]:
    """A text with pairs of words that `good` names ("f inancial") joined, left to right, and what was joined."""
    found, out, done = [], [], 0
    tokens = [m.span() for m in _LETTERS.finditer(text)]
    skip = False
    for (a, b), (c, d) in zip(tokens, tokens[1:]):
        if skip:
            skip = False
            continue
        if text[b:c] == " " and f"{text[a:b]} {text[c:d]}".lower() in good:
            out += [text[done:b]]
            done, skip = c, True
            found.append(f"{text[a:b]} {text[c:d]} -> {text[a:b]}{text[c:d]}")
    return "".join(out) + text[done:], found


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, notes = [], []
        for t, pairs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            new, found = joined_splits(t, set(pairs)) if pairs else (t, [])
            texts.append(new)
            notes.append(found)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(notes, pa.list_(pa.string()))], ["doc_id", "text", "repairs"])


def repaired(docs: DataFrame, merged_least: int = 3, fragment_most: int = 2) -> DataFrame:
    """docs with kerning splits joined and the `repairs` made: where the joined word is frequent and a part is rare.

    The pairs of a document meet the vocabulary in joins on words, whatever its size; only the pairs that hold come back.
    """
    vocab = vocabulary(docs)
    spaced = F.regexp_extract_all(F.col("text"), F.lit("(?<![A-Za-z])(?=([A-Za-z]+ [A-Za-z]+))"), F.lit(1))
    pairs = docs.select("doc_id", F.explode(F.array_distinct(F.transform(spaced, lambda p: F.lower(p)))).alias("pair"))
    pairs = pairs.withColumn("a", F.split("pair", " ")[0]).withColumn("b", F.split("pair", " ")[1]).withColumn("ab", F.concat("a", "b"))
    common = vocab.where(F.col("n") >= merged_least).select(F.col("word").alias("ab"))
    held = pairs.join(common, "ab", "left_semi").join(vocab.select(F.col("word").alias("a"), F.col("n").alias("na")), "a", "left").join(vocab.select(F.col("word").alias("b"), F.col("n").alias("nb")), "b", "left")
    held = held.where(F.least(F.coalesce("na", F.lit(0)), F.coalesce("nb", F.lit(0))) <= fragment_most)
    mine = held.groupBy("doc_id").agg(F.collect_set("pair").alias("pairs"))
    fixed = docs.join(mine, "doc_id").select("doc_id", "text", "pairs").mapInArrow(_repair, "doc_id string, text string, repairs array<string>")
    return docs.join(fixed.withColumnRenamed("text", "_new"), "doc_id", "left").withColumn("text", F.coalesce("_new", "text")).withColumn("repairs", F.coalesce("repairs", F.array().cast("array<string>"))).drop("_new")


def healed(docs: DataFrame, **options) -> DataFrame:
    """Furniture removed first, in all documents; then splits repaired by the vocabulary of what is left."""
    return repaired(without_furniture(docs, furniture(docs, **options))).withColumn("char_count", F.length("text"))


def purity(docs: DataFrame) -> DataFrame:
    """One row: chunks, those with Devanagari or a page marker, PIN-shaped spans, copies, characters.

    Copies are exact and near ones by the rule of deduplication, chunks being visited in order of document and place.
    """
    marker = r"(?i)\bP ?age\s*(\|\s*)?[0-9]+(\s+of\s+[0-9]+)?"
    cut = docs.select("doc_id", F.posexplode(X.chunks("text")).alias("idx", "chunk"))
    own = cut.agg(
        F.count("*").alias("chunks"),
        F.count_if(F.col("chunk").rlike(r"[\x{900}-\x{97F}]")).alias("chunks_with_devanagari"),
        F.count_if(F.col("chunk").rlike(marker)).alias("chunks_with_page_marker"),
        F.coalesce(F.sum(F.regexp_count("chunk", F.lit(r"(?<![\p{L}\p{N}_])[1-9][0-9]{5}(?![\p{L}\p{N}_])"))), F.lit(0)).alias("pincode_spans"),
    )
    # no document goes before another one, so the order has no year
    seen = written(dedup.exact(cut.select("doc_id", "idx", F.lit(0).alias("year"), F.col("chunk").alias("text"))), "copies")
    near = dedup.greedy(dedup.banded(seen.where("kept").select("rank", "text")))
    copies = seen.agg(F.count_if(~F.col("kept")).alias("exact")).crossJoin(near.agg(F.count_if(~F.col("kept")).alias("near")))
    copies = copies.select((F.col("exact") + F.col("near")).alias("duplicate_chunks"))
    return own.crossJoin(copies).crossJoin(docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("total_chars")))
