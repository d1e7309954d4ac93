"""Token statistics by source file."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.functions import text as X


def word_count(text: str | Column) -> Column:
    """Stretches without white space: the count that needs no tokenizer."""
    return F.size(X.words(text)).cast("bigint")


def counter(encode: Callable[[str], list[int]]) -> Callable[[Column], Column]:
    """A tokenizer's count as an Arrow UDF."""

    @F.pandas_udf("bigint")
    def count(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: len(encode(t)) if t else 0)

    return count


def tokenizer(name: str) -> tuple[Callable[[Column], Column], str]:
    """(count, name): words, or a file of a public byte-level vocabulary; one that can't be read counts words, and says so in the name."""
    if name == "words":
        return word_count, "words"
    try:
        import tiktoken
        from tiktoken.load import load_tiktoken_bpe

        ranks = load_tiktoken_bpe(name)
    except (ImportError, OSError, ValueError):
        return word_count, "words"
    pattern = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    def encode(text: str) -> list[int]:
        if "code" not in made:
            made["code"] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        return made["code"].encode_ordinary(text)

    made: dict[str, object] = {}
    return counter(encode), name.replace("\\", "/").rsplit("/", 1)[-1].removesuffix(".tiktoken")


def token_stats(chunks: DataFrame, count: Callable[[Column], Column] = word_count, name: str = "words") -> DataFrame:
    """(source_file, chunks, tokens, tokenizer)."""
    own = chunks.select("source_file", count(F.col("text")).alias("t"))
    return own.groupBy("source_file").agg(F.count("*").alias("chunks"), F.coalesce(F.sum("t"), F.lit(0)).alias("tokens")).withColumn("tokenizer", F.lit(name))


def total(stats: DataFrame) -> DataFrame:
    return stats.agg(F.count("*").alias("files"), F.sum("chunks").alias("chunks"), F.sum("tokens").alias("tokens"))
