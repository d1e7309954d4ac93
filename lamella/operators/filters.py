"""Comparison filters after the published Gopher rules (Rae et al. 2021, appendix A1), and how their verdicts overlap with ours.

The definitions are this engine's own reading of those rules; words are stretches without white space.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamella.functions import text as X

# The names of the filters and the own reason that looks at the same property.
FILTERS = {
    "word_count": "too_few_words", "non_alpha_numeric": "low_alpha_ratio", "symbols_to_words": "high_symbol_ratio", "numbers": None,
    "words_without_alphabets": None, "mean_word_length": None, "top_2grams": "low_lexical_diversity", "top_3grams": "low_lexical_diversity",
    "top_4grams": "low_lexical_diversity", "dup_5grams": "low_lexical_diversity", "boilerplate": None,
}
BOILERPLATE = ["terms of use", "privacy policy", "cookie policy", "uses cookies", "use of cookies", "use cookies", "lorem ipsum", "javascript"]


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def top_shares(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Of runs of 2, 3 and 4 words: characters of the most frequent one, all its places, by characters of all words; 0 where none comes again.

    Counting inside a row has no built-in expression that isn't quadratic, so this one runs in Arrow batches.
    """

    def shares(text: str | None) -> list[float]:
        w = (text or "").split()
        size = sum(map(len, w)) or 1
        out = []
        for n in (2, 3, 4):
            counts = Counter(zip(*(w[i:] for i in range(n))))
            most = max(counts.values(), default=0)
            longest = max((sum(map(len, g)) for g, c in counts.items() if c == most), default=0) if most > 1 else 0
            out.append(most * longest / size)
        return out

    for batch in texts:
        yield batch.map(shares)


def failed_filters(text: str | Column = "text") -> Column:
    """All filters a text fails, in the order of FILTERS."""
    text = X.col(text)
    # a Python function can't stand inside a lambda, so its result is bound beside it
    return X.let(F.struct(X.words(text).alias("w"), top_shares(text).alias("top")), lambda x: _failed(text, x["w"], x["top"]))


def _failed(text: Column, w: Column, top: Column) -> Column:
    n = F.size(w)
    size = F.greatest(F.length(text), F.lit(1))
    letters_digits = F.length(F.regexp_replace(text, r"[^\p{L}\p{N}]", ""))
    spaces = F.length(F.regexp_replace(text, X.NOT_SPACE, ""))
    digits = F.length(F.regexp_replace(text, r"[^\p{Nd}]", ""))
    symbols = F.regexp_count(text, F.lit(r"#|\.\.\.|\x{2026}"))
    lettered = F.size(F.filter(w, lambda x: x.rlike(r"\p{L}")))
    mean = (F.length(text) - spaces) / F.greatest(n, F.lit(1))
    five = F.when(n >= 5, X.windows(w, 5)).otherwise(F.array().cast("array<string>"))
    repeated = X.let(five, lambda g: 1 - F.try_divide(F.size(F.array_distinct(g)), F.size(g)))
    rules = {
        "word_count": ~n.between(50, 100_000),
        "non_alpha_numeric": (F.length(text) - letters_digits - spaces) / size > 0.25,
        "symbols_to_words": symbols / F.greatest(n, F.lit(1)) > 0.1,
        "numbers": digits / size > 0.15,
        "words_without_alphabets": lettered / F.greatest(n, F.lit(1)) < 0.8,
        "mean_word_length": ~mean.between(3, 10),
        "top_2grams": top[0] > 0.20,
        "top_3grams": top[1] > 0.18,
        "top_4grams": top[2] > 0.16,
        "dup_5grams": F.coalesce(repeated, F.lit(0.0)) > 0.15,
        "boilerplate": F.lower(text).rlike("|".join(BOILERPLATE)),
    }
    return F.filter(F.array(*[F.when(rules[k], F.lit(k)) for k in FILTERS]), lambda x: x.isNotNull())


def per_filter(chunks: DataFrame) -> DataFrame:
    """(filter, removed, also_removed_by_ours) of chunks with failed_filters and our own reason; every filter has a row."""
    names = chunks.sparkSession.createDataFrame([(k,) for k in FILTERS], "filter string")
    flat = chunks.select(F.explode("failed_filters").alias("filter"), F.col("reason").isNotNull().cast("int").alias("ours"))
    n = flat.groupBy("filter").agg(F.count("*").alias("removed"), F.sum("ours").alias("also_removed_by_ours"))
    return names.join(n, "filter", "left").fillna(0).orderBy(F.desc("removed"), "filter")


def overlap(chunks: DataFrame) -> DataFrame:
    """One row: chunks in, removed by both, only by the filters, only by our rules."""
    theirs, ours = F.size("failed_filters") > 0, F.col("reason").isNotNull()
    return chunks.agg(F.count("*").alias("chunks"), F.count_if(theirs & ours).alias("both"), F.count_if(theirs & ~ours).alias("only_filters"), F.count_if(~theirs & ours).alias("only_own"))


def by_document(chunks: DataFrame) -> DataFrame:
    """(doc_id, filters, own): removed chunks of each document on either side."""
    theirs = chunks.where(F.size("failed_filters") > 0).groupBy("doc_id").agg(F.count("*").alias("filters"))
    ours = chunks.where(F.col("reason").isNotNull()).groupBy("doc_id").agg(F.count("*").alias("own"))
    return theirs.join(ours, "doc_id", "full").fillna(0)
