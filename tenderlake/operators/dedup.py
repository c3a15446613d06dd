"""Keep-one-row-per-key de-duplication shared by the contract, award and
statement transforms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """First row of each key group under ``order``.

    Written as ``row_number() = 1`` so Catalyst plans a WindowGroupLimit:
    each map task keeps only its best row per key *before* the shuffle, so a
    hot key (one value holding a large share of rows) reaches the window
    stage as at most one row per input partition.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def asc(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]
