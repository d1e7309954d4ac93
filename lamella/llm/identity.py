"""Equal texts, told by an id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def identified(records: DataFrame, key: str, text: str, *more: Column) -> DataFrame:
    """(key, text, text_id, more) of records with neither null; equal ids mean equal texts.

    Ids are 64 bits of hash; those that two texts share, told by 64 other bits, are a list about as long as n * n / 2**65, and
    get the hash of all 128.
    """
    own = records.where(F.col(key).isNotNull() & F.col(text).isNotNull())
    own = own.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("text_id"), F.xxhash64(F.lit(1), text).alias("_more"), *more)
    clash = [r[0] for r in own.groupBy("text_id").agg(F.min("_more").alias("lo"), F.max("_more").alias("hi")).where("lo < hi").select("text_id").collect()]
    if clash:
        own = own.withColumn("text_id", F.when(F.col("text_id").isin(clash), F.xxhash64("text_id", "_more")).otherwise(F.col("text_id")))
    return own.drop("_more")


def one_text_each(own: DataFrame, asked: DataFrame) -> DataFrame:
    """asked, (text_id, ...) with each id once, with the text.

    It is fetched where the least key of a text has it, so that copies, however many, are spread over all partitions.
    """
    least = own.groupBy("text_id").agg(F.min("key").alias("key"))
    return own.select("text_id", "key", "text").join(asked.join(least, "text_id"), ["text_id", "key"]).dropDuplicates(["text_id"]).drop("key")
