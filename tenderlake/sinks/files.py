"""Delimited-file export."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_delimited(df: DataFrame, path: str, sep: str = "|", header: bool = True, mode: str = "errorifexists") -> None:
    """SNK-3: CSV with a chosen one-character delimiter, one file per task
    (never funnelled through one writer)."""
    (df.write.mode(mode)
     .option("sep", sep[0]).option("header", header).option("quote", '"').option("escape", '"')
     .option("quoteAll", False)
     .csv(path))
