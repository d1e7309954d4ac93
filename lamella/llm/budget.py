"""Token budgets per source, language and domain.

Texts are hashed and deduplicated, each distinct text is tokenized once, its count is joined back to all its copies, and
the counts are summed by slice. The tokenizer is a public one, or "words": stretches without white space.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.functions.joins import spread_join
from lamella.llm import flat
from lamella.llm.encoding import TOKENIZERS, ranks, vocabulary_file

#: Published word pattern of the byte-level vocabularies.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _counts(path: str):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        code = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks(path), special_tokens={})
        for batch in batches:
            n = [len(code.encode_ordinary(t)) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["t1", "t2", "tokens"])

    return go


def with_counts(rows: DataFrame, text: str, by: str, tokenizer: str = "byte_bpe_50k", tokenizers: str = TOKENIZERS) -> DataFrame:
    """rows without their text, with its number of tokens as tokens; a null text has 0. Each distinct text is counted once.

    Texts are told apart by 128 bits of hash; the join back spreads over the hash, and rows of a text that has many over the
    hash of the column `by`.
    """
    keyed = rows.withColumn("t1", F.xxhash64(text)).withColumn("t2", F.xxhash64(F.lit(1), text))
    distinct = keyed.where(F.col(text).isNotNull()).select("t1", "t2", F.col(text).alias("text")).dropDuplicates(["t1", "t2"])
    if tokenizer == "words":
        counted = distinct.select("t1", "t2", F.regexp_count("text", F.lit(flat.NOT_WHITE_CLASS + "+")).cast("long").alias("tokens"))
    else:
        counted = distinct.mapInArrow(_counts(vocabulary_file(tokenizer, tokenizers)), "t1 bigint, t2 bigint, tokens bigint")
    # a null text's hash is its seed, which no text is counted for
    return spread_join(keyed.drop(text), counted, ["t1", "t2"], "left", F.col(by)).drop("t1", "t2").withColumn("tokens", F.coalesce("tokens", F.lit(0)))


def recount(chunks: DataFrame) -> DataFrame:
    """(run_id, source_file, chunks, tokens): distinct chunk_ids and the words of their texts, each chunk_id once.

    A null text is a chunk without words; a chunk_id with several texts counts the longest by words. Null keys are a
    group of their own.
    """
    counted = with_counts(chunks.select("run_id", "source_file", "chunk_id", "text"), "text", "chunk_id", "words")
    once = counted.groupBy("run_id", "source_file", "chunk_id").agg(F.max("tokens").alias("tokens"))
    return once.groupBy("run_id", "source_file").agg(F.count("chunk_id").alias("chunks"), F.sum("tokens").alias("tokens"))


def disagreeing(stats: DataFrame, chunks: DataFrame) -> DataFrame:
    """(run_id, source_file) of records whose chunks or tokens is null or isn't what the texts give; each once."""
    own = stats.select("run_id", "source_file", "chunks", "tokens").distinct().alias("s")
    true = recount(chunks).alias("r")
    same = F.col("s.run_id").eqNullSafe(F.col("r.run_id")) & F.col("s.source_file").eqNullSafe(F.col("r.source_file"))
    wrong = F.col("s.chunks").isNull() | F.col("s.tokens").isNull() | (F.col("s.chunks") != F.coalesce("r.chunks", F.lit(0))) | (F.col("s.tokens") != F.coalesce("r.tokens", F.lit(0)))
    return own.join(true, same, "left").where(wrong).select("s.run_id", "s.source_file").distinct()


def budget(documents: DataFrame, labels: DataFrame, tokenizer: str = "byte_bpe_50k", tokenizers: str = TOKENIZERS) -> DataFrame:
    """(source, lang, domain, docs, texts, tokens, distinct_tokens): totals of each slice.

    docs counts rows, texts those with a text; distinct_tokens counts each distinct text of the slice once. The domain
    is the document's own or else its file's label (the smallest in lower case, should a file have several). Nulls are
    slices of their own.
    """
    label = labels.where(F.col("source_file").isNotNull()).groupBy("source_file").agg(F.min(F.lower(F.trim("label"))).alias("label"))
    own = documents.select("source", "lang", "domain", "source_file", "text", F.xxhash64("text").alias("of"), F.col("text").isNotNull().alias("has"), F.monotonically_increasing_id().alias("row"))
    counted = with_counts(own, "text", "row", tokenizer, tokenizers).drop("row")
    named = counted.join(label, "source_file", "left").withColumn("domain", F.coalesce("domain", "label"))
    # copies are summed before slices: one row a distinct text and slice
    once = named.groupBy("source", "lang", "domain", "of").agg(F.count("*").alias("docs"), F.sum(F.col("has").cast("long")).alias("texts"), F.sum("tokens").alias("tokens"), F.max("tokens").alias("one"))
    return once.groupBy("source", "lang", "domain").agg(F.sum("docs").alias("docs"), F.sum("texts").alias("texts"), F.sum("tokens").alias("tokens"), F.sum("one").alias("distinct_tokens"))
