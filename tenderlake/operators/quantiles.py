"""Exact quantiles of one or many columns without gathering a column into one task.

``percentile`` is exact but buffers every value of the group in one
aggregation buffer, which does not survive a global group at scale.  Here

1. one pass turns every row into (column, value) pairs, counts every distinct
   pair (map-side combined, so a value that half of all rows share is one row
   per task) and writes the counts, range-partitioned by column and value, to
   the shared folder;
2. the totals per partition and column go to the driver (at most one row per
   shuffle partition and column) and tell where which rank lies;
3. a running count inside just those partitions picks the values.

The number of jobs is fixed, whatever the values are and however many columns
are asked for.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from tenderlake.session import drop_scratch, materialize, scratch_path


def select_ranks(df: DataFrame, columns: Sequence[str], probs: list[float]) -> list[tuple[int, dict[int, float]]]:
    """Per column: (number of non-NULL values, exact value at each 0-based rank the quantiles need).

    Values are compared as doubles, which keeps their order.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "value-counts")
    pairs = F.array(*[F.struct(F.lit(i).alias("col"), F.col(c).cast("double").alias("v"))
                      for i, c in enumerate(columns)])
    try:
        counts = (df.select(F.inline(pairs)).where(F.col("v").isNotNull())
                  .groupBy("col", "v").agg(F.count("*").alias("c"))
                  .repartitionByRange("col", "v").withColumn("part", F.spark_partition_id()))
        stored = materialize(counts, "value-counts", path)
        runs: list[list[Row]] = [[] for _ in columns]
        for r in stored.groupBy("col", "part").agg(F.sum("c").alias("c")).collect():
            runs[r["col"]].append(r)
        totals, asked = [], []
        for col, run in enumerate(runs):
            run.sort(key=lambda r: r["part"])  # range partitions are numbered in the order of their values
            starts = [0, *accumulate(r["c"] for r in run)]
            totals.append(starts[-1])
            for rank in sorted(set(interpolation_ranks(starts[-1], probs))) if run else []:
                i = bisect_right(starts, rank) - 1
                asked.append((col, run[i]["part"], rank - starts[i], rank))
        picked: list[dict[int, float]] = [{} for _ in columns]
        if asked:
            # ranks relative to their partition; a running count in each partition that holds one
            w = Window.partitionBy("col", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
            held = (stored.where(F.col("part").isin(sorted({part for _, part, _, _ in asked})))
                    .withColumn("upto", F.sum("c").over(w)))
            ranks = spark.createDataFrame(asked, "col int, part int, at long, rank long")
            hits = held.join(ranks, ["col", "part"]).where(
                (F.col("at") >= F.col("upto") - F.col("c")) & (F.col("at") < F.col("upto")))
            for r in hits.select("col", "rank", "v").collect():
                picked[r["col"]][r["rank"]] = r["v"]
        return list(zip(totals, picked))
    finally:
        drop_scratch(spark, path)


def interpolation_ranks(n: int, probs: list[float]) -> list[int]:
    return [k for p in probs for k in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))]


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: list[float]) -> list[list[float | None]]:
    """Linear-interpolated quantiles (the same definition as Spark's ``percentile`` and SQL ``quantile_cont``) of
    the non-NULL values of each column; a column without any has NULL quantiles."""
    return [_interpolate(total, picked, probs) for total, picked in select_ranks(df, columns, probs)]


def exact_quantiles(values: DataFrame, column: str, probs: list[float]) -> list[float | None]:
    """The quantiles of one column."""
    return column_quantiles(values, [column], probs)[0]


def _interpolate(total: int, picked: dict[int, float], probs: list[float]) -> list[float | None]:
    if total == 0:
        return [None for _ in probs]
    out = []
    for p in probs:
        pos = p * (total - 1)
        lo, hi = math.floor(pos), math.ceil(pos)
        a, b = picked[lo], picked[hi]
        out.append(a + (pos - lo) * (b - a))
    return out
