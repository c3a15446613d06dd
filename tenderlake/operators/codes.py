"""Goods/services classification codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cpv_refresh(codes: DataFrame) -> DataFrame:
    """The dwh copy of the codes table: same rows, same columns."""
    return codes.select("codecpv", "description")


def cpv_clean(raw: DataFrame, code_col: str = "CODE", text_col: str = "EN") -> DataFrame:
    """Published code list -> (codecpv, description): drop dashes, keep the
    first 8 characters (``03000000-1`` -> ``03000000``)."""
    code = F.substring(F.replace(F.col(code_col), F.lit("-"), F.lit("")), 1, 8)
    return raw.select(code.alias("codecpv"), F.col(text_col).alias("description"))
