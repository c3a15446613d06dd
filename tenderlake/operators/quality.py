"""Table checks: not empty, unique key."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_not_empty(df: DataFrame) -> DataFrame:
    """DQ-1: one row ``n_rows``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def key_profile(df: DataFrame, key: str) -> DataFrame:
    """Row count and largest rows-per-key in one pass: the per-key counts are
    partial aggregates (a hot key collapses map-side), the final reduction is
    a global sum / max over them.  NULL keys count as one key."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows"),
                       F.coalesce(F.max("n"), F.lit(0)).cast("bigint").alias("max_rows_per_key"))


def check_unique_key(df: DataFrame, key: str) -> DataFrame:
    """DQ-2: one row ``max_rows_per_key`` (0 for an empty table)."""
    return key_profile(df, key).select("max_rows_per_key")


def quality_report(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """DQ-3: both checks for each ``name -> (frame, key)``; one row per table.

    All keys go through one tagged aggregation, so the number of jobs does not
    grow with the number of tables.  An empty table has no key to show; its row
    comes from the list of names.
    """
    spark = next(iter(tables.values()))[0].sparkSession
    names = spark.createDataFrame(list(enumerate(tables)), "table_no int, table_name string")
    # a number instead of the name: every key is shuffled and hashed with it
    keys = reduce(DataFrame.unionByName, [
        df.select(F.lit(no).alias("checked"), F.col(key).cast("string").alias("key"))
        for no, (df, key) in enumerate(tables.values())])
    per_key = keys.groupBy("checked", "key").agg(F.count(F.lit(1)).alias("n"))
    seen = per_key.groupBy("checked").agg(F.sum("n").alias("rows"), F.max("n").alias("most"))
    out = (names.join(F.broadcast(seen), F.col("table_no") == F.col("checked"), "left")  # a row per table
           .select("table_name", F.coalesce("rows", F.lit(0)).cast("bigint").alias("n_rows"),
                   F.coalesce("most", F.lit(0)).cast("bigint").alias("max_rows_per_key")))
    return out.withColumn("passed", (F.col("n_rows") > 0) & (F.col("max_rows_per_key") <= 1))


class QualityError(ValueError):
    pass


def assert_quality(report: DataFrame) -> list[dict]:
    """Raise when a table is empty or has a duplicated key.  The report has
    one row per checked table, so collecting it is bounded."""
    rows = [r.asDict() for r in report.collect()]
    bad = [r for r in rows if not r["passed"]]
    if bad:
        raise QualityError("; ".join(
            f"{r['table_name']}: " + ("no rows" if r["n_rows"] == 0 else f"{r['max_rows_per_key']} rows share a key")
            for r in bad))
    return rows
