"""Delimited (CSV) sources."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tenderlake.sources.spans import lines, quoted_records


def _shape_error(line: Column, sep: str, fields: int, fill_missing: bool) -> Column:
    """What is wrong with a record's shape, NULL when nothing is.

    Quoted fields are taken out first; separators left over are real ones, and
    a field that still starts with a quote was never closed.
    """
    d = re.escape(sep)
    bare = F.regexp_replace(line, rf'(^|{d})"[^"]*+(?:""[^"]*+)*+"(?={d}|$)', "$1")
    found = F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1
    wrong = found > fields if fill_missing else found != fields
    return (F.when(bare.rlike(rf'(^|{d})"'), F.lit("open quote"))
            .when(wrong, F.concat(found.cast("string"), F.lit(f" fields instead of {fields}"))))


def _checked(record: Column, line: Column, error: Column) -> Column:
    return F.when(error.isNotNull(), F.raise_error(F.concat(F.lit("malformed record, "), error, F.lit(": "), line))
                  ).otherwise(record)


def read_delimited(spark: SparkSession, path: str, schema: StructType, sep: str = ",", header: bool = True,
                   fill_missing: bool = False, multi_line: bool = False) -> DataFrame:
    """SRC-6: CSV with a declared all-text schema.

    Only the first character of ``sep`` is used.  Loads are fail-fast: a row
    with missing or surplus fields or with a quote that is never closed aborts
    the job.  ``fill_missing`` lets missing trailing fields read as NULL and
    forgives nothing else.  Quoted fields may hold the delimiter and doubled
    quotes, with ``multi_line`` newlines too.  Files stay splittable either
    way; blank lines are no records.
    """
    sep = sep[0]
    if multi_line:
        records = quoted_records(spark, path, header)
    else:
        records = lines(spark, path, header).select(F.rtrim("value", F.lit("\r")).alias("line"))
    records = records.where(F.trim("line") != "")
    error = _shape_error(F.col("line"), sep, len(schema.fields), fill_missing)
    record = F.from_csv(F.col("line"), schema.simpleString()[len("struct<"):-1].replace(":", " "),
                        {"sep": sep, "quote": '"', "escape": '"', "maxCharsPerColumn": "-1"})
    return records.select(_checked(record, F.col("line"), error).alias("_record")).select("_record.*")


def csv_header_scan(spark: SparkSession, path: str) -> DataFrame:
    """SRC-8: header CSV read with no schema (every column text)."""
    return spark.read.option("header", True).csv(path)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))
