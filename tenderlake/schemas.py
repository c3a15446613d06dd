"""Declared schemas of every landed and typed table (never inferred)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DateType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType)


def _strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


# --- contracts -----------------------------------------------------------

BUYER = StructType([StructField("id", StringType()), StructField("nom", StringType())])

AWARDEE = StructType([
    StructField("id", StringType()),
    StructField("denominationSociale", StringType()),
    StructField("typeIdentifiant", StringType()),
])

# One element of the ``marches`` array of a contracts document.
CONTRACT = StructType([
    StructField("uid", StringType()),
    StructField("source", StringType()),
    StructField("id", StringType()),
    StructField("_type", StringType()),
    StructField("nature", StringType()),
    StructField("procedure", StringType()),
    StructField("objet", StringType()),
    StructField("codeCPV", StringType()),
    StructField("dureeMois", IntegerType()),
    StructField("dateNotification", StringType()),
    StructField("datePublicationDonnees", StringType()),
    StructField("montant", DoubleType()),
    StructField("formePrix", StringType()),
    StructField("acheteur", BUYER),
    StructField("titulaires", ArrayType(AWARDEE)),
])

CONTRACT_DOCUMENT = StructType([StructField("marches", ArrayType(CONTRACT))])

# The same element as landed: every value as text (lists and objects as their
# JSON), so that one odd value never hides the rest of its document.
LANDED_CONTRACT = _strings(*CONTRACT.fieldNames())
LANDED_DOCUMENT = StructType([StructField("marches", ArrayType(LANDED_CONTRACT))])
CORRUPT = "_corrupt_record"

STAGING_MARCHES = StructType([
    StructField("decp_uid", StringType()),
    StructField("source", StringType()),
    StructField("decp_id", StringType()),
    StructField("type", StringType()),
    StructField("nature", StringType()),
    StructField("procedure", StringType()),
    StructField("objet", StringType()),
    StructField("codecpv", StringType()),
    StructField("dureemois", IntegerType()),
    StructField("datenotification", StringType()),
    StructField("datepublicationdonnees", StringType()),
    StructField("montant", DoubleType()),
    StructField("formeprix", StringType()),
    StructField("acheteur_id", StringType()),
    StructField("acheteur_name", StringType()),
])

DATALAKE_MARCHES = StructType([
    StructField(f.name, DateType() if f.name in ("datenotification", "datepublicationdonnees") else f.dataType)
    for f in STAGING_MARCHES.fields
])

# As stored: with the landed publication date, which orders the versions of a
# contract in every later load, batch or stream.
STORED_MARCHES = StructType([*DATALAKE_MARCHES.fields, StructField("publication_text", StringType())])

DWH_MARCHES = StructType(DATALAKE_MARCHES.fields + [StructField("suspicious_amount", IntegerType())])

STAGING_TITULAIRES = _strings("decp_uid", "titulaire_id", "titulaire_name", "titulaire_typeidentifiant")

DATALAKE_TITULAIRES = _strings("decp_bridge_uid", "decp_uid", "titulaire_id", "titulaire_name",
                               "titulaire_typeidentifiant")

DWH_TITULAIRES = _strings("decp_bridge_uid", "decp_uid", "euvat", "siren", "siret", "titulaire_name",
                          "titulaire_iso_country")

SIREN_USED = _strings("siren")

TIME = StructType([
    StructField("date", DateType()),
    StructField("day", IntegerType()),
    StructField("month", IntegerType()),
    StructField("year", IntegerType()),
    StructField("year_month", StringType()),
])

# --- company registry ----------------------------------------------------

# Column names of the published company-registry file, in file order.
REGISTRY_COLUMNS = (
    "siren", "statutDiffusionUniteLegale", "unitePurgeeUniteLegale", "dateCreationUniteLegale", "sigleUniteLegale",
    "sexeUniteLegale", "prenom1UniteLegale", "prenom2UniteLegale", "prenom3UniteLegale", "prenom4UniteLegale",
    "prenomUsuelUniteLegale", "pseudonymeUniteLegale", "identifiantAssociationUniteLegale",
    "trancheEffectifsUniteLegale", "anneeEffectifsUniteLegale", "dateDernierTraitementUniteLegale",
    "nombrePeriodesUniteLegale", "categorieEntreprise", "anneeCategorieEntreprise", "dateDebut",
    "etatAdministratifUniteLegale", "nomUniteLegale", "nomUsageUniteLegale", "denominationUniteLegale",
    "denominationUsuelle1UniteLegale", "denominationUsuelle2UniteLegale", "denominationUsuelle3UniteLegale",
    "categorieJuridiqueUniteLegale", "activitePrincipaleUniteLegale", "nomenclatureActivitePrincipaleUniteLegale",
    "nicSiegeUniteLegale", "economieSocialeSolidaireUniteLegale", "caractereEmployeurUniteLegale",
)
REGISTRY = _strings(*REGISTRY_COLUMNS)

DWH_SIREN = _strings("siren", "euvat", "sirenname", "economieSocialeSolidaireUniteLegale",
                     "trancheEffectifsUniteLegale", "categorieentreprise")

# --- financial statements --------------------------------------------------

STATEMENT_MEASURES = ("millesime", "date_de_cloture_exercice", "duree", "tranche_ca_millesime", "ca", "resultat",
                      "effectif")
STAGING_STATEMENTS = _strings("siren", *[f"{m}_{y}" for y in (1, 2) for m in STATEMENT_MEASURES])

DATALAKE_STATEMENTS = StructType([
    StructField("infogreffe_uid", StringType()),
    StructField("siren", StringType()),
    StructField("millesime", IntegerType()),
    StructField("date_de_cloture", DateType()),
    StructField("duree", IntegerType()),
    StructField("tranche_ca_millesime", StringType()),
    StructField("ca", DoubleType()),
    StructField("resultat", DoubleType()),
    StructField("effectif", DoubleType()),
])

DWH_STATEMENTS = StructType(DATALAKE_STATEMENTS.fields[:2] + [StructField("euvat", StringType())]
                            + DATALAKE_STATEMENTS.fields[2:])

# --- goods / services codes ------------------------------------------------

CPV = _strings("codecpv", "description")

# Declared byte widths applied at load (everything else is unbounded text).
CPV_WIDTHS = {"codecpv": 8}

# --- reports -----------------------------------------------------------------

FACT_PER_SUPPLIERNAME = StructType([
    StructField("sirenname", StringType()),
    StructField("total_amount", DoubleType()),
    StructField("n_contract", LongType()),
])

FACT_PER_ESS = StructType([StructField("ess", StringType()), *FACT_PER_SUPPLIERNAME.fields[1:]])

CONTRACTS_YEAR_MONTH = StructType([
    StructField("year", IntegerType()),
    StructField("year_month", StringType()),
    StructField("n_contracts", LongType()),
])


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with exactly the columns and types of a target table, by name.

    Raises on a column the table doesn't have or the frame lacks; values are
    cast with the session's (strict) rules.
    """
    if set(df.columns) != set(schema.fieldNames()):
        raise ValueError(f"columns {sorted(df.columns)} instead of {sorted(schema.fieldNames())}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
