"""The three warehouse reports.

Contracts are aggregated per company *before* the company dimension is
joined (Catalyst does not push an aggregate below a join by itself), and the
per-company totals are shared by both spend reports.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.operators.contracts import SUSPICIOUS_AMOUNT

# The notification-year window of the monthly report.
REPORT_FIRST_YEAR = 2018
REPORT_LAST_YEAR = 2021


def siren_totals(marches: DataFrame, titulaires: DataFrame) -> DataFrame:
    """Spend and contract count per company.

    Contracts of 99 M or more and contracts without amount are left out;
    a contract with several winners counts in full for each of them.
    The join shuffles both fact tables on ``decp_uid`` once; the aggregate is
    partial (map-side) then final, so a hot siren never sits whole in one
    task's hash map before combining.
    """
    m = marches.where(F.col("montant") < SUSPICIOUS_AMOUNT).select("decp_uid", "montant")
    t = titulaires.where(F.col("siren").isNotNull()).select("decp_uid", "siren")
    return (m.join(t, "decp_uid")
            .groupBy("siren")
            .agg(F.sum("montant").alias("total_amount"), F.count(F.lit(1)).alias("n_contract")))


def _by_amount(df: DataFrame, ordered: bool) -> DataFrame:
    return df.orderBy(F.col("total_amount").desc_nulls_first()) if ordered else df


def fact_per_suppliername(totals: DataFrame, companies: DataFrame, ordered: bool = True) -> DataFrame:
    """Spend per company name, largest first.  Companies missing from the
    registry drop out; companies sharing a name (including the empty name)
    are summed together.  ``ordered=False`` leaves out the global sort (a
    range-partitioning shuffle) for results written to a table, which keeps
    no row order; the order is applied when the table is read."""
    names = companies.select("siren", "sirenname").where(F.col("sirenname").isNotNull())
    return _by_amount(totals.join(names, "siren")
                      .groupBy("sirenname")
                      .agg(F.sum("total_amount").alias("total_amount"), F.sum("n_contract").alias("n_contract")),
                      ordered)


def fact_per_ess(totals: DataFrame, companies: DataFrame, ordered: bool = True) -> DataFrame:
    """Spend per social-economy flag; companies without a registry row or
    without a flag form the NULL group."""
    flags = companies.select("siren", F.col("economieSocialeSolidaireUniteLegale").alias("ess"))
    return _by_amount(totals.join(flags, "siren", "left")
                      .groupBy("ess")
                      .agg(F.sum("total_amount").alias("total_amount"), F.sum("n_contract").alias("n_contract")),
                      ordered)


def contracts_year_month(marches: DataFrame, time: DataFrame, ordered: bool = True) -> DataFrame:
    """Contracts notified per month of 2018-2021, oldest month first.

    Contracts are first counted per notification day (partial aggregate,
    output bounded by the number of distinct days), so the calendar join and
    the final grouping work on day counts instead of contract rows.  The
    calendar's ``year`` is ``year(date)``, so its year window is also stated
    as a date range on the contracts: that predicate reaches the parquet scan
    (row-group pruning) instead of waiting for the join.
    """
    d = F.col("datenotification")
    first = F.make_date(F.lit(REPORT_FIRST_YEAR), F.lit(1), F.lit(1))
    after = F.make_date(F.lit(REPORT_LAST_YEAR + 1), F.lit(1), F.lit(1))
    per_day = (marches.where(d.isNotNull() & (d >= first) & (d < after))
               .groupBy(F.col("datenotification").alias("date"))
               .agg(F.count(F.lit(1)).alias("n")))
    cal = (time.where((F.col("year") >= REPORT_FIRST_YEAR) & (F.col("year") <= REPORT_LAST_YEAR))
           .select("date", "year", "year_month"))
    out = (per_day.join(cal, "date")
           .groupBy("year", "year_month")
           .agg(F.sum("n").alias("n_contracts")))
    return out.orderBy("year_month") if ordered else out
