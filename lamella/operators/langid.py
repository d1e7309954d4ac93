"""Language of a text by the frequencies of its letter trigrams (after Cavnar and Trenkle 1994), fitted on labelled texts.

The subpackage for training data has a finer detector; this one is built-in expressions only, and needs no vocabulary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamella.functions import text as X


def trigrams(text: str | Column, chars: int | None = None) -> Column:
    """Runs of three code points of the text in lower case, all but letters and their marks being one space; of the first `chars` code points where given."""
    own = X.col(text) if chars is None else F.substring(X.col(text), 1, chars)
    flat = F.regexp_replace(F.lower(own), r"[^\p{L}\p{M}]+", " ")
    return X.let(F.filter(F.split(flat, "", -1), lambda c: c != ""), lambda c: F.when(F.size(c) >= 3, F.transform(F.sequence(F.lit(1), F.size(c) - 2), lambda i: F.array_join(F.slice(c, i, 3), ""))).otherwise(F.array().cast("array<string>")))


def profiles(labelled: DataFrame, most: int = 1000) -> DataFrame:
    """(lang, g, weight, floor): of each language of (text, lang) its `most` most frequent trigrams; weight is what one adds to the log-likelihood above the floor's.

    Counts are over all labelled texts; the table has at most languages x `most` rows.
    """
    counts = labelled.where("text is not null and lang is not null").select("lang", F.explode(trigrams("text")).alias("g")).groupBy("lang", "g").agg(F.count("*").alias("n"))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    top = counts.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "g"))).where(F.col("r") <= most)
    return top.join(F.broadcast(totals), "lang").select("lang", "g", F.log(F.col("n") + 1.0).alias("weight"), (-F.log(F.col("total") + F.lit(float(most)))).alias("floor"))


def detected(texts: DataFrame, key: str, text: str, profile: DataFrame, chars: int = 3000) -> DataFrame:
    """(key, lang): the language that explains the first `chars` code points best, the first in order of equals; "unknown" where no trigram is known or the text is null.

    One row for each row of texts; keys must differ.
    """
    own = texts.select(F.col(key).alias("_key"), F.explode(trigrams(text, chars)).alias("g")).groupBy("_key", "g").agg(F.count("*").alias("n"))
    size = own.groupBy("_key").agg(F.sum("n").alias("all"))
    # the profiles are a bounded table
    met = own.join(F.broadcast(profile.select("lang", "g", "weight")), "g").groupBy("_key", "lang").agg(F.sum(F.col("n") * F.col("weight")).alias("above"))
    floors = F.broadcast(profile.groupBy("lang").agg(F.first("floor").alias("floor")))
    scored = met.join(size, "_key").join(floors, "lang").withColumn("score", F.round(F.col("above") + F.col("all") * F.col("floor"), 6))
    best = scored.groupBy("_key").agg(F.min(F.struct((-F.col("score")).alias("loss"), "lang")).alias("b")).select(F.col("_key").alias(key), F.col("b.lang").alias("lang"))
    return texts.select(key).join(best, key, "left").select(key, F.coalesce("lang", F.lit("unknown")).alias("lang"))
