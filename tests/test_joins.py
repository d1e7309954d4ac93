from pyspark.sql import functions as F

from lamella.functions.joins import hot_keys, spread_join
from lamella.session import settings


def test_hot_keys_are_spread(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k")).unionByName(spark.createDataFrame([(-1, None)], "id long, k string"))
    told = rows.select("k").distinct().withColumn("v", F.length("k"))
    assert [r.k for r in hot_keys(rows, ["k"]).collect()] == ["hot"]
    with_none = spread_join(rows, told, ["k"], "left", F.col("id"))
    assert sorted(map(tuple, with_none.collect()), key=str) == sorted(map(tuple, rows.join(told, "k", "left").select(*with_none.columns).collect()), key=str)
    assert spread_join(rows, told, ["k"], "inner", F.col("id")).count() == 3000
    # no partition of the shuffle holds the third of the rows that share a key
    with settings(spark, spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="30"):
        hot = spread_join(rows, told.hint("merge"), ["k"], "inner", F.col("id")).where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(hot) > 10 and max(r["count"] for r in hot) < 300
    assert spread_join(rows.limit(0), told, ["k"], "left", F.col("id")).count() == 0
