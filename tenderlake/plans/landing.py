"""Land fixtures as the files the pipeline ingests (JSON documents, CSV).

Everything is written by Spark tasks into the shared folder; no file passes
through the driver.  Contract documents hold about ``DOC_SIZE`` contracts each
(a hash of the contract's uid deals them), one document per line, so a
document never grows with the data.  They are compressed, in files of at most
``FILE_DOCS`` documents, so that a task that reads one has a bounded share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.plans.fixtures import fixture
from tenderlake.schemas import REGISTRY_COLUMNS

DOC_SIZE = 1000
FILE_DOCS = 256


def contract_documents(marches: DataFrame, titulaires: DataFrame) -> DataFrame:
    """Nested documents ``{"marches": [...]}`` from the staging fixtures.

    The supplier list rides on the first version (``objet`` ending ``v0``) of
    each contract; later versions carry an empty list or no list at all.
    """
    documents = max(1, -(-marches.count() // DOC_SIZE))
    contract = F.struct(
        F.col("decp_uid").alias("uid"), "source", F.col("decp_id").alias("id"), F.col("type").alias("_type"),
        "nature", "procedure", "objet", F.col("codecpv").alias("codeCPV"), F.col("dureemois").alias("dureeMois"),
        F.col("datenotification").alias("dateNotification"),
        F.col("datepublicationdonnees").alias("datePublicationDonnees"), "montant",
        F.col("formeprix").alias("formePrix"),
        F.struct(F.col("acheteur_id").alias("id"), F.col("acheteur_name").alias("nom")).alias("acheteur"))
    award = F.struct(F.col("titulaire_id").alias("id"), F.col("titulaire_name").alias("denominationSociale"),
                     F.col("titulaire_typeidentifiant").alias("typeIdentifiant"))
    # contracts and awards meet in the document's partition: one shuffle instead of one per join side and grouping
    both = (marches.select("decp_uid", contract.alias("contract"))
            .unionByName(titulaires.where(F.col("decp_uid").isNotNull()).select("decp_uid", award.alias("award")),
                         allowMissingColumns=True)
            .withColumn("doc", F.pmod(F.xxhash64("decp_uid"), F.lit(documents))).repartition("doc"))
    per_uid = both.groupBy("doc", "decp_uid").agg(F.collect_list("contract").alias("contracts"),
                                                  F.collect_list("award").alias("awards"))
    c = F.col("contract")
    lists = (F.when(c["objet"].endswith(" v0"), F.when(F.size("awards") > 0, F.col("awards")))
             .when(c["id"].cast("bigint") % 2 == 0, F.array().cast("array<struct<id:string,denominationSociale:string,"
                                                                   "typeIdentifiant:string>>")))
    return (per_uid.select("doc", F.explode("contracts").alias("contract"), "awards")
            .groupBy("doc").agg(F.collect_list(c.withField("titulaires", lists)).alias("marches"))
            .select("marches"))


def land_contracts(spark: SparkSession, sf: str, path: str) -> str:
    docs = contract_documents(fixture(spark, sf, "fx_marches"), fixture(spark, sf, "fx_titulaires"))
    docs.write.mode("errorifexists").option("maxRecordsPerFile", FILE_DOCS).json(path, compression="gzip")
    return path


def land_contract_files(spark: SparkSession, sf: str, path: str) -> str:
    """The form in which contracts are published: files of one pretty-printed document each."""
    docs = contract_documents(fixture(spark, sf, "fx_marches"), fixture(spark, sf, "fx_titulaires"))
    (docs.select(F.to_json(F.struct("marches"), {"pretty": "true"}).alias("value"))
     .write.mode("errorifexists").option("maxRecordsPerFile", 1).text(path, compression="gzip"))
    return path


def registry_frame(spark: SparkSession, sf: str, newlines: bool = False) -> DataFrame:
    """All 33 registry columns; a quoted comma and doubled quotes (and, if asked for, a newline) planted in
    ``denominationUsuelle2UniteLegale``."""
    fx = fixture(spark, sf, "fx_siren")
    parts = [F.lit('Denom, "'), F.col("siren"), F.lit('"')] + [F.lit("\nsecond line")] * newlines
    planted = {"denominationUsuelle2UniteLegale": F.concat(*parts)}
    cols = []
    for c in REGISTRY_COLUMNS:
        if c in fx.columns:
            cols.append(F.col(c))
        elif c in planted:
            cols.append(planted[c].alias(c))
        else:
            cols.append(F.lit(None).cast("string").alias(c))
    return fx.select(*cols)


def land_registry(spark: SparkSession, sf: str, path: str, newlines: bool = False) -> str:
    (registry_frame(spark, sf, newlines).write.mode("errorifexists")
     .option("header", True).option("quote", '"').option("escape", '"').csv(path))
    return path


def statement_lines(spark: SparkSession, sf: str) -> DataFrame:
    """``;``-separated statement lines without header; rows of companies with
    siren divisible by 7 are cut after ``resultat_2``; the tail of the
    others stays as written (blank for NULL)."""
    fx = fixture(spark, sf, "fx_infogreffe")
    fields = [F.coalesce(F.col(c), F.lit("")) for c in fx.columns]
    full = F.concat_ws(";", *fields)
    short = F.concat_ws(";", *fields[:-1])
    cut = F.col("siren").cast("bigint") % 7 == 0
    return fx.select(F.when(cut, short).otherwise(full).alias("value"))


def land_statements(spark: SparkSession, sf: str, path: str) -> str:
    statement_lines(spark, sf).write.mode("errorifexists").text(path)
    return path


def land_codes(spark: SparkSession, sf: str, path: str) -> str:
    """The code list as published (``NNNNNNNN-N`` codes), ``|``-separated."""
    from tenderlake.sinks.files import write_delimited
    raw = fixture(spark, sf, "fx_cpv_raw").select(F.col("CODE").alias("codecpv"), F.col("EN").alias("description"))
    write_delimited(raw, path, sep="|")
    return path


def land_all(spark: SparkSession, sf: str, base: str) -> dict[str, str]:
    """Every landed input of the pipeline under ``base``."""
    return {
        "contracts": land_contracts(spark, sf, f"{base}/contracts"),
        "registry": land_registry(spark, sf, f"{base}/registry"),
        "statements": land_statements(spark, sf, f"{base}/statements"),
        "codes": land_codes(spark, sf, f"{base}/codes"),
    }
