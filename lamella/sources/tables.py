"""Reading the tables the engine works on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a data folder; columns and filters are pushed into the scan by Catalyst."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
