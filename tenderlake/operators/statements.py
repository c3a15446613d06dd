"""Financial-statement transforms (two fiscal years per landed row)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlake.functions import french_vat_number
from tenderlake.operators.companies import of_interest
from tenderlake.operators.dedup import latest_per_key
from tenderlake.operators.prefilter import WORDS, hash_bits, may_hold

LONG_COLUMNS = ["millesime", "date_de_cloture", "duree", "tranche_ca_millesime", "ca", "resultat", "effectif"]


def statements_long(staging: DataFrame) -> DataFrame:
    """One row per (company, fiscal year) in a single scan: both year blocks
    become an array of same-named structs, ``inline`` expands it; rows whose
    year text is not 4 characters are dropped."""
    def block(i: int):
        return F.struct(
            F.col(f"millesime_{i}").alias("millesime"),
            F.col(f"date_de_cloture_exercice_{i}").alias("date_de_cloture"),
            F.col(f"duree_{i}").alias("duree"),
            F.col(f"tranche_ca_millesime_{i}").alias("tranche_ca_millesime"),
            F.col(f"ca_{i}").alias("ca"),
            F.col(f"resultat_{i}").alias("resultat"),
            F.col(f"effectif_{i}").alias("effectif"))
    return (staging.select("siren", F.inline(F.array(block(1), block(2))))
            .where(F.length("millesime") == 4))


def statements_unpivot(staging: DataFrame) -> DataFrame:
    """The long form without exact duplicates."""
    return statements_long(staging).distinct()


def statements_normalized(long: DataFrame) -> DataFrame:
    """Key = md5 of the *text* parts siren, year, closing date, duration
    (NULL if any part is NULL); measures typed, bad values become NULL."""
    key = F.md5(F.concat("siren", "millesime", "date_de_cloture", "duree"))
    return long.select(
        key.alias("infogreffe_uid"), "siren",
        F.col("millesime").try_cast("int").alias("millesime"),
        F.col("date_de_cloture").try_cast("date").alias("date_de_cloture"),
        F.col("duree").try_cast("int").alias("duree"),
        "tranche_ca_millesime",
        F.col("ca").try_cast("double").alias("ca"),
        F.col("resultat").try_cast("double").alias("resultat"),
        F.col("effectif").try_cast("double").alias("effectif"))


def statements_unique(normalized: DataFrame) -> DataFrame:
    """One row per key: longest duration, then latest closing date (missing
    first); remaining columns break ties.  All NULL-key rows form one group
    and only one of them survives."""
    order = [F.col("duree").desc_nulls_first(), F.col("date_de_cloture").desc_nulls_first(),
             F.col("siren").asc_nulls_last(), F.col("millesime").asc_nulls_last(),
             F.col("ca").desc_nulls_last(), F.col("resultat").desc_nulls_last(),
             F.col("effectif").desc_nulls_last(), F.col("tranche_ca_millesime").desc_nulls_last()]
    return latest_per_key(normalized, ["infogreffe_uid"], order)


def datalake_statements(staging: DataFrame) -> DataFrame:
    """Keep-one per key needs no distinct before it (a shuffle of whole rows saved)."""
    return statements_unique(statements_normalized(statements_long(staging)))


def statements_per_year(statements: DataFrame) -> DataFrame:
    """Full-year (12 month) statements only; latest closing per company-year.
    The group is ``siren || year`` as text, so NULL parts share one group."""
    order = [F.col("date_de_cloture").desc_nulls_first()] + [
        F.col(c).asc_nulls_last() for c in ("infogreffe_uid", "siren", "millesime", "tranche_ca_millesime", "ca",
                                            "resultat", "effectif")]
    return latest_per_key(_full_year(statements), [_company_year()], order)


def _full_year(statements: DataFrame) -> DataFrame:
    return statements.where(F.col("duree") == 12)


def _company_year() -> Column:
    return F.concat(F.col("siren"), F.col("millesime").cast("string"))


def near_interest(datalake: DataFrame, used: DataFrame, words: int = WORDS) -> DataFrame:
    """The full-year statements of every company-year group that holds a company of ``used``, and of a few more.

    Whole groups stay or go, since groups of different companies can share
    one text; the choice per group and the exact semi-join are still to
    follow.  Two filters of fixed size are broadcast (the companies, then the
    groups that may hold one of them), so what the choice shuffles are the
    statements near the companies of interest instead of all.
    """
    full = _full_year(datalake)
    companies = hash_bits(used, F.col("siren"), words)
    groups = hash_bits(may_hold(full.select("siren", "millesime"), F.col("siren"), companies, words),
                       _company_year(), words)
    return may_hold(full, _company_year(), groups, words)


def statements_standardized(per_year: DataFrame) -> DataFrame:
    return per_year.select("infogreffe_uid", "siren", french_vat_number(F.col("siren")).alias("euvat"),
                           *LONG_COLUMNS)


def dwh_statements(datalake: DataFrame) -> DataFrame:
    return statements_standardized(statements_per_year(datalake))


def statements_of_interest(standardized: DataFrame, used: DataFrame) -> DataFrame:
    """Statements of companies that won a contract, columns by name in table order."""
    return of_interest(standardized, used).select("infogreffe_uid", "siren", "euvat", *LONG_COLUMNS)


def dwh_statements_of_interest(datalake: DataFrame, used: DataFrame) -> DataFrame:
    """The same rows from the landed statements, most others dropped before any shuffle."""
    return statements_of_interest(dwh_statements(near_interest(datalake, used)), used)
