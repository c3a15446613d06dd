"""Column profiling of any table (the exploration notebooks as Spark jobs).

Every profile is a fixed number of aggregation passes, for any number of
columns; results are small frames (one row, or one row per column / value /
month).
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlake.functions import year_month
from tenderlake.operators.quality import check_unique_key
from tenderlake.operators.quantiles import column_quantiles

QUARTILES = [0.25, 0.5, 0.75]

# Fixed values from the exploration notebooks: amounts from 100 M are outliers;
# dates after 2021 are in the future; decades are counted from 1900.
OUTLIER_AMOUNT = 1e8
LAST_EXPECTED_YEAR = 2021
DECADE_ORIGIN = 1900


def row_count(df: DataFrame) -> DataFrame:
    """PRF-1."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def null_share(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """PRF-2: share of NULLs per column, highest first; one pass for all columns."""
    cols = list(columns or df.columns)
    shares = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in cols])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_share")) for c in cols])
    return (shares.select(F.inline(pairs))
            .orderBy(F.col("null_share").desc(), F.col("column_name")))


def key_uniqueness(df: DataFrame, key: str) -> DataFrame:
    """PRF-3: distinct non-NULL keys over rows; unique when the ratio is 1."""
    out = df.agg(F.count_distinct(F.col(key)).alias("n_distinct"), F.count(F.lit(1)).alias("n_rows"))
    ratio = F.col("n_distinct") / F.col("n_rows")
    return out.select("n_distinct", "n_rows", ratio.alias("ratio"), (ratio == 1).alias("is_unique"))


def max_rows_per_key(df: DataFrame, key: str) -> DataFrame:
    """PRF-4: largest group size of ``key``."""
    return check_unique_key(df, key)


def numeric_summaries(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """PRF-5 for many columns, a row each in the given order: count, mean, sample std, min, exact quartiles, max
    (NULLs ignored).  The number of jobs doesn't grow with the columns."""
    quartiles = column_quantiles(df, columns, QUARTILES)
    base = _first_of_each(df, columns, n=F.count, mean=F.avg, std=F.stddev_samp, min=F.min, max=F.max)
    rows = [(c, b["n"], b["mean"], b["std"], _f(b["min"]), *q, _f(b["max"]))
            for c, b, q in zip(columns, base, quartiles)]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, n long, mean double, std double, min double, p25 double, p50 double, p75 double,"
              " max double")


def numeric_summary(df: DataFrame, column: str) -> DataFrame:
    """PRF-5 for one column."""
    return numeric_summaries(df, [column]).drop("column_name")


def _first_of_each(df: DataFrame, columns: Sequence[str], **aggregates: Callable[[Column], Column]) -> list[dict]:
    """The named aggregates of every column, from one pass over the rows."""
    got = df.agg(*[fn(F.col(c)).alias(f"{name}_{i}") for i, c in enumerate(columns)
                   for name, fn in aggregates.items()]).first()
    return [{name: got[f"{name}_{i}"] for name in aggregates} for i in range(len(columns))]


def _f(x):
    return None if x is None else float(x)


def box_stats_of(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """PRF-6 for many columns: the numbers a box plot draws: quartiles, whiskers (furthest values within 1.5 IQR of
    the box) and the count of points beyond them.  Columns without values have no row."""
    boxes = [(c, *q) for c, q in zip(columns, column_quantiles(df, columns, QUARTILES)) if q[0] is not None]
    aggs = []
    for i, (c, q1, _, q3) in enumerate(boxes):
        inside = F.col(c).between(F.lit(q1 - 1.5 * (q3 - q1)), F.lit(q3 + 1.5 * (q3 - q1)))
        aggs += [F.min(F.when(inside, F.col(c))).cast("double").alias(f"low_{i}"),
                 F.max(F.when(inside, F.col(c))).cast("double").alias(f"high_{i}"), F.count_if(~inside).alias(f"n_{i}")]
    far = df.agg(*aggs).first() if aggs else {}
    return df.sparkSession.createDataFrame(
        [(c, q1, med, q3, q3 - q1, far[f"low_{i}"], far[f"high_{i}"], far[f"n_{i}"])
         for i, (c, q1, med, q3) in enumerate(boxes)],
        "column_name string, q1 double, median double, q3 double, iqr double, lower_whisker double,"
        " upper_whisker double, n_outliers long")


def box_stats(df: DataFrame, column: str) -> DataFrame:
    """PRF-6 for one column."""
    return box_stats_of(df, [column]).drop("column_name")


def amount_outliers(df: DataFrame, column: str = "montant", huge: float = OUTLIER_AMOUNT) -> DataFrame:
    """PRF-7: rows at or above ``huge`` and rows equal to 0, tagged ``kind``."""
    c = F.col(column)
    kind = F.when(c >= huge, F.lit("huge")).when(c == 0, F.lit("zero"))
    return df.withColumn("kind", kind).where(F.col("kind").isNotNull())


def date_coerce(df: DataFrame, column: str) -> DataFrame:
    """PRF-8: parse text as a date, unparsable -> NULL; share of NULL after parsing."""
    d = F.coalesce(F.try_to_date(F.col(column).cast("string"), "yyyy-MM-dd"),
                   F.try_to_date(F.col(column).cast("string")))
    parsed = df.select(d.alias("d"))
    return parsed.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("d").isNull()).alias("n_null"),
                      F.avg(F.col("d").isNull().cast("int")).alias("null_share"))


def date_summaries(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """PRF-9 for many columns, a row each in the given order: count, mean, min, quartiles, max.  The mean is in days
    since 1970-01-01; quartiles are interpolated in days and shown as the date of their whole-day part."""
    days = df.select(*[F.unix_date(F.col(c)).alias(f"d{i}") for i, c in enumerate(columns)])
    quartiles = column_quantiles(days, days.columns, QUARTILES)
    base = _first_of_each(days, days.columns, n=F.count, mean_day=F.avg, lo=F.min, hi=F.max)
    rows = [(c, b["n"], b["mean_day"], b["lo"], *q, b["hi"]) for c, b, q in zip(columns, base, quartiles)]
    out = df.sparkSession.createDataFrame(
        rows, "column_name string, n long, mean_day double, lo int, q1 double, q2 double, q3 double, hi int")
    shown = {"lo": "min", "q1": "p25", "q2": "p50", "q3": "p75", "hi": "max"}
    return out.select("column_name", "n", "mean_day", *[
        F.date_from_unix_date(F.floor(F.col(k)).cast("int")).alias(name) for k, name in shown.items()])


def date_summary(df: DataFrame, column: str) -> DataFrame:
    """PRF-9 for one column."""
    return date_summaries(df, [column]).drop("column_name")


def future_dates(df: DataFrame, column: str, after_year: int = LAST_EXPECTED_YEAR) -> DataFrame:
    """PRF-10: rows dated after ``after_year`` (a date bound, so it reaches the scan)."""
    return df.where(F.col(column) >= datetime.date(after_year + 1, 1, 1))


def monthly_histogram(df: DataFrame, column: str, first_year: int | None = None,
                      last_year: int | None = None) -> DataFrame:
    """PRF-11: rows per ``<year>-<MM>``, oldest month first; optional year window."""
    d = F.col(column)
    rows = df.where(d.isNotNull())
    if first_year is not None:
        rows = rows.where(d >= datetime.date(first_year, 1, 1))
    if last_year is not None:
        rows = rows.where(d < datetime.date(last_year + 1, 1, 1))
    return (rows.groupBy(year_month(d).alias("year_month")).agg(F.count(F.lit(1)).alias("n"))
            .orderBy("year_month"))


def value_counts(df: DataFrame, column: str, k: int | None = None) -> DataFrame:
    """PRF-12: frequency per non-NULL value, most frequent first (ties by
    value); ``k`` keeps the top k (a top-k report)."""
    out = (df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
           .agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col("value")))
    return out.limit(k) if k else out


def null_share_by_category(df: DataFrame, category: str, measure: str) -> DataFrame:
    """PRF-13: share of NULL ``measure`` per category (NULL category dropped)."""
    return (df.where(F.col(category).isNotNull()).groupBy(category)
            .agg(F.avg(F.col(measure).isNull().cast("int")).alias(f"{measure}_pct_null"))
            .orderBy(category))


def decade_histogram(df: DataFrame, column: str) -> DataFrame:
    """PRF-15: rows per founding decade 1900 + 10*floor((year-1900)/10),
    in decade order (missing decade first)."""
    year = F.year(F.try_to_date(F.col(column).cast("string")))
    decade = (F.lit(DECADE_ORIGIN) + F.lit(10) * F.floor((year - DECADE_ORIGIN) / 10)).cast("bigint")
    return (df.groupBy(decade.alias("decade")).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("decade").asc_nulls_first()))


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """PRF-16: ``n`` pseudo-random rows, reproducible for a seed: rows ordered
    by an md5 of ``key || '#' || seed`` (NULL key hashed as ''), then by key.

    A first pass counts rows per leading four hex digits (65,536 at most) and
    gives the digits up to which at least ``n`` rows lie; the sample is the
    top ``n`` of those, so the final merge sees about ``n`` rows and not ``n``
    per task.  md5 (not xxhash64) so any SQL engine can name the same
    sample."""
    h = F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f"#{int(seed)}")))
    lead = F.substring(h, 1, 4)
    seen, last = 0, "ffff"
    for row in sorted(df.groupBy(lead.alias("lead")).agg(F.count("*").alias("n")).collect()):
        seen += row["n"]
        if seen >= n:
            last = row["lead"]
            break
    return df.where(lead <= last).orderBy(h, F.col(key).asc_nulls_last()).limit(n)


def first_rows(df: DataFrame, n: int = 1000) -> DataFrame:
    """PRF-16: ``n`` rows to look at, whichever come first."""
    return df.limit(n)
