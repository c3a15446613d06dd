"""Company registry transforms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.functions import french_vat_number

NAME_PARTS = ["nomUniteLegale", "nomUsageUniteLegale", "denominationUniteLegale",
              "denominationUsuelle1UniteLegale"]


def siren_standardized(registry: DataFrame) -> DataFrame:
    """VAT number and display name (the four name columns glued together,
    missing parts as empty, so the name is never NULL) of each company."""
    name = F.concat(*[F.coalesce(F.col(c), F.lit("")) for c in NAME_PARTS])
    return registry.select(
        "siren", french_vat_number(F.col("siren")).alias("euvat"), name.alias("sirenname"),
        "economieSocialeSolidaireUniteLegale", "trancheEffectifsUniteLegale",
        F.col("categorieEntreprise").alias("categorieentreprise"))


def of_interest(df: DataFrame, used: DataFrame) -> DataFrame:
    """Rows whose ``siren`` won at least one contract (left semi join: the
    used-company list only filters, it never duplicates or adds columns)."""
    return df.join(used.select("siren"), on="siren", how="left_semi")


def siren_of_interest(standardized: DataFrame, used: DataFrame) -> DataFrame:
    return of_interest(standardized, used)
