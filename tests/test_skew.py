"""A third of all rows on one key: results stay whole and the hot group is
cut down before the shuffle."""

from pyspark.sql import functions as F

from tenderlake.operators import quality
from tenderlake.operators.dedup import latest_per_key
from tenderlake.sinks.warehouse import upsert_frame


def _skewed(spark, n=30_000):
    ids = spark.range(n).withColumn("k", F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")))
    return ids.withColumn("v", (F.col("id") * 7919) % 100_003).repartition(8)


def test_latest_per_key_under_skew(spark):
    df = _skewed(spark)
    out = latest_per_key(df, ["k"], [F.col("v").desc(), F.col("id")])
    p = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in p
    hot = out.where(F.col("k") == "HOT").collect()
    best = df.where(F.col("k") == "HOT").orderBy(F.col("v").desc(), "id").first()
    assert len(hot) == 1 and hot[0]["id"] == best["id"]
    assert out.count() == df.select("k").distinct().count()


def test_key_profile_and_upsert_under_skew(spark):
    df = _skewed(spark)
    row = quality.key_profile(df, "k").first()
    assert (row["n_rows"], row["max_rows_per_key"]) == (30_000, 10_000)
    batch = spark.createDataFrame([("HOT", 1, 1)], "k string, id long, v long")
    out = upsert_frame(df.select("k", "id", "v"), batch, "k")
    assert out.count() == 20_001
