"""Registered queries: one per operator of the inventory.

Every query reads the driver tables of ``sf_dir`` through the fixtures and
runs the library operators on all of it.  ``ORACLE[name]`` is the matching
DuckDB SQL when the result can be value-checked.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import LongType, StructField, StructType

from tenderlake import schemas, sinks, sources
from tenderlake.functions import french_vat_number, truncate_utf8
from tenderlake.operators import codes, companies, contracts, profile, quality, reports, statements
from tenderlake.plans import landing
from tenderlake.plans.fixtures import fixture, read_table
from tenderlake.plans.oracle import sql_with
from tenderlake.session import materialize, scratch_path
from tenderlake.sinks import Warehouse
from tenderlake.sources.delimited import row_count

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = sql_with(oracle)
        return fn
    return deco


def money(c: str) -> Column:
    """Double sums are order-dependent in the last bits: compare at cents."""
    return F.round(F.col(c), 2).alias(c)


# --- shared plan fragments -----------------------------------------------------

def dwh_marches(spark: SparkSession, sf: str) -> DataFrame:
    return contracts.marches_prepared(contracts.marches_unique(fixture(spark, sf, "fx_marches")))


def datalake_titulaires(spark: SparkSession, sf: str) -> DataFrame:
    return contracts.titulaires_unique(fixture(spark, sf, "fx_titulaires"))


def dwh_titulaires(spark: SparkSession, sf: str) -> DataFrame:
    return contracts.dwh_titulaires(datalake_titulaires(spark, sf))


def siren_used(spark: SparkSession, sf: str) -> DataFrame:
    return contracts.siren_used(dwh_titulaires(spark, sf))


def dwh_siren(spark: SparkSession, sf: str) -> DataFrame:
    return companies.siren_of_interest(companies.siren_standardized(fixture(spark, sf, "fx_siren")),
                                       siren_used(spark, sf))


def datalake_statements(spark: SparkSession, sf: str) -> DataFrame:
    return statements.datalake_statements(fixture(spark, sf, "fx_infogreffe"))


# --- contracts -----------------------------------------------------------------

@register("marches_unique", "SELECT * FROM marches_unique")
def q_marches_unique(spark, sf):
    return contracts.marches_unique(fixture(spark, sf, "fx_marches"))


@register("award_uid", "SELECT * FROM titulaires_keyed")
def q_award_uid(spark, sf):
    return contracts.award_uid(fixture(spark, sf, "fx_titulaires"))


@register("titulaires_unique", "SELECT * FROM titulaires_unique")
def q_titulaires_unique(spark, sf):
    return datalake_titulaires(spark, sf)


@register("titulaires_trimmed_ids", "SELECT * FROM titulaires_trimmed")
def q_titulaires_trimmed(spark, sf):
    return contracts.titulaires_trimmed(datalake_titulaires(spark, sf))


@register("titulaires_valid_ids", "SELECT * FROM titulaires_valid")
def q_titulaires_valid(spark, sf):
    return contracts.titulaires_valid(contracts.titulaires_trimmed(datalake_titulaires(spark, sf)))


@register("titulaires_standardized", "SELECT * FROM dwh_titulaires")
def q_titulaires_standardized(spark, sf):
    return dwh_titulaires(spark, sf)


@register("marches_prepared", "SELECT * FROM dwh_marches")
def q_marches_prepared(spark, sf):
    return dwh_marches(spark, sf)


@register("siren_used", "SELECT * FROM siren_used")
def q_siren_used(spark, sf):
    return siren_used(spark, sf)


@register("time_dimension", "SELECT * FROM time_dim")
def q_time_dimension(spark, sf):
    return contracts.time_dimension(dwh_marches(spark, sf))


@register("french_vat_number",
          "SELECT titulaire_id AS siren, 'FR' || lpad(CAST((12 + 3 * (TRY_CAST(titulaire_id AS INTEGER) % 97)) % 97"
          " AS VARCHAR), 2, '0') || titulaire_id AS euvat FROM fx_titulaires")
def q_french_vat_number(spark, sf):
    ids = fixture(spark, sf, "fx_titulaires").select(F.col("titulaire_id").alias("siren"))
    return ids.select("siren", french_vat_number(F.col("siren")).alias("euvat"))


# --- companies, statements, codes -------------------------------------------------

@register("siren_standardized", "SELECT * FROM siren_std")
def q_siren_standardized(spark, sf):
    return companies.siren_standardized(fixture(spark, sf, "fx_siren"))


@register("siren_of_interest", "SELECT * FROM dwh_siren")
def q_siren_of_interest(spark, sf):
    return dwh_siren(spark, sf)


@register("statements_unpivot", "SELECT * FROM st_unpivot")
def q_statements_unpivot(spark, sf):
    return statements.statements_unpivot(fixture(spark, sf, "fx_infogreffe"))


@register("statements_normalized",
          "SELECT infogreffe_uid, siren, millesime, date_de_cloture, duree, tranche_ca_millesime,"
          " ca, resultat, effectif FROM st_normalized")
def q_statements_normalized(spark, sf):
    return statements.statements_normalized(statements.statements_unpivot(fixture(spark, sf, "fx_infogreffe")))


@register("statements_unique", "SELECT * FROM st_unique")
def q_statements_unique(spark, sf):
    return datalake_statements(spark, sf)


@register("statements_per_year", "SELECT * FROM st_per_year")
def q_statements_per_year(spark, sf):
    return statements.statements_per_year(datalake_statements(spark, sf))


@register("statements_standardized", "SELECT * FROM st_standardized")
def q_statements_standardized(spark, sf):
    return statements.dwh_statements(datalake_statements(spark, sf))


@register("statements_of_interest", "SELECT * FROM dwh_statements")
def q_statements_of_interest(spark, sf):
    return statements.dwh_statements_of_interest(materialize(datalake_statements(spark, sf), "statements"),
                                                 materialize(siren_used(spark, sf), "siren_used"))


@register("cpv_refresh", "SELECT * FROM fx_cpv")
def q_cpv_refresh(spark, sf):
    return codes.cpv_refresh(fixture(spark, sf, "fx_cpv"))


@register("cpv_clean", "SELECT left(replace(CODE, '-', ''), 8) AS codecpv, EN AS description FROM fx_cpv_raw")
def q_cpv_clean(spark, sf):
    return codes.cpv_clean(fixture(spark, sf, "fx_cpv_raw"))


# --- reports ---------------------------------------------------------------------

_SPEND = "round(sum(total_amount), 2) AS total_amount, CAST(sum(n_contract) AS BIGINT) AS n_contract"

_RPT_SUPPLIER = f"""
SELECT sirenname, {_SPEND} FROM dwh_siren JOIN siren_totals USING (siren) WHERE sirenname IS NOT NULL GROUP BY ALL
"""

_RPT_ESS = f"""
SELECT economieSocialeSolidaireUniteLegale AS ess, {_SPEND} FROM siren_totals LEFT JOIN dwh_siren USING (siren)
GROUP BY ALL
"""

_RPT_MONTH = """
SELECT CAST(year(datenotification) AS INTEGER) AS year, strftime(datenotification, '%Y-%m') AS year_month,
       count(*) AS n_contracts
FROM dwh_marches WHERE datenotification BETWEEN DATE '2018-01-01' AND DATE '2021-12-31' GROUP BY ALL
"""


def _totals(spark, sf):
    return reports.siren_totals(dwh_marches(spark, sf), dwh_titulaires(spark, sf))


@register("fact_per_suppliername", _RPT_SUPPLIER)
def q_fact_per_suppliername(spark, sf):
    out = reports.fact_per_suppliername(_totals(spark, sf), dwh_siren(spark, sf))
    return out.select("sirenname", money("total_amount"), "n_contract")


@register("fact_per_ess", _RPT_ESS)
def q_fact_per_ess(spark, sf):
    out = reports.fact_per_ess(_totals(spark, sf), dwh_siren(spark, sf))
    return out.select("ess", money("total_amount"), "n_contract")


@register("contracts_year_month", _RPT_MONTH)
def q_contracts_year_month(spark, sf):
    m = dwh_marches(spark, sf)
    return reports.contracts_year_month(m, contracts.time_dimension(m))


# --- sources: landed files read back ----------------------------------------------

def _landed_contracts(spark, sf):
    path = landing.land_contracts(spark, sf, scratch_path(spark, "contracts-json"))
    return sources.read_contracts(spark, path)


_CONTRACTS_ORACLE = """
SELECT decp_uid AS uid, source, decp_id AS id, type AS _type, nature, procedure, objet, codecpv AS codeCPV,
       CAST(dureemois AS INTEGER) AS dureeMois, datenotification AS dateNotification,
       datepublicationdonnees AS datePublicationDonnees, CAST(montant AS DOUBLE) AS montant, formeprix AS formePrix,
       acheteur_id, acheteur_name,
       CAST(CASE WHEN ends_with(objet, ' v0') THEN n.n WHEN CAST(decp_id AS BIGINT) % 2 = 0 THEN 0 END AS INTEGER)
         AS n_titulaires
FROM fx_marches LEFT JOIN (SELECT decp_uid, count(*) AS n FROM fx_titulaires GROUP BY ALL) n USING (decp_uid)
"""


def _contract_values(rows: DataFrame) -> DataFrame:
    return rows.select(*[c for c in rows.columns if c not in ("acheteur", "titulaires")],
                       F.col("acheteur.id").alias("acheteur_id"), F.col("acheteur.nom").alias("acheteur_name"),
                       F.when(F.col("titulaires").isNotNull(), F.size("titulaires")).alias("n_titulaires"))


@register("contracts_from_json", _CONTRACTS_ORACLE)
def q_contracts_from_json(spark, sf):
    return _contract_values(_landed_contracts(spark, sf))


@register("contracts_from_whole_documents", _CONTRACTS_ORACLE)
def q_contracts_from_whole_documents(spark, sf):
    path = landing.land_contract_files(spark, sf, scratch_path(spark, "contracts-documents"))
    return _contract_values(sources.read_contracts(spark, path, multi_line=True))


@register("contract_rows", "SELECT * FROM fx_marches")
def q_contract_rows(spark, sf):
    return sources.contract_rows(_landed_contracts(spark, sf))


@register("award_rows", "SELECT * FROM fx_titulaires")
def q_award_rows(spark, sf):
    return sources.award_rows(_landed_contracts(spark, sf))


@register("strip_escapes",
          "SELECT doc_id, replace(replace(text, chr(9), ''), chr(10), '') AS text FROM documents")
def q_strip_escapes(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    return sources.strip_escapes(docs, ["text"])


@register("json_by_name", "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def q_json_by_name(spark, sf):
    events = read_table(spark, sf, "events")
    return sources.json_fields(events, "props", StructType([StructField("k", LongType())]), keep=["event_id"])


_REGISTRY_ORACLE = """
SELECT siren, nomUniteLegale, nomUsageUniteLegale, denominationUniteLegale,
       'Denom, "' || siren || '"' AS denominationUsuelle2UniteLegale,
       economieSocialeSolidaireUniteLegale, trancheEffectifsUniteLegale, categorieEntreprise, dateDebut
FROM fx_siren
"""


_REGISTRY_READ = ["siren", "nomUniteLegale", "nomUsageUniteLegale", "denominationUniteLegale",
                  "denominationUsuelle2UniteLegale", "economieSocialeSolidaireUniteLegale",
                  "trancheEffectifsUniteLegale", "categorieEntreprise", "dateDebut"]


@register("read_delimited", _REGISTRY_ORACLE)
def q_read_delimited(spark, sf):
    path = landing.land_registry(spark, sf, scratch_path(spark, "registry-csv"))
    reg = sources.clean_loaded(sources.read_delimited(spark, path, schemas.REGISTRY, sep=",", header=True))
    return reg.select(*_REGISTRY_READ)


@register("read_delimited_quoted_newlines",
          _REGISTRY_ORACLE.replace("""siren || '"' AS""", """siren || '"' || chr(10) || 'second line' AS"""))
def q_read_delimited_quoted_newlines(spark, sf):
    path = landing.land_registry(spark, sf, scratch_path(spark, "registry-csv"), newlines=True)
    reg = sources.clean_loaded(sources.read_delimited(spark, path, schemas.REGISTRY, multi_line=True))
    return reg.select(*_REGISTRY_READ)


@register("read_delimited_fill", "SELECT * FROM fx_infogreffe")
def q_read_delimited_fill(spark, sf):
    path = landing.land_statements(spark, sf, scratch_path(spark, "statements-csv"))
    return sources.clean_loaded(sources.read_delimited(spark, path, schemas.STAGING_STATEMENTS, sep=";",
                                                       header=False, fill_missing=True))


_BLANK = "'[ \\t\\n\\r\\f\\x0B]*'"


@register("load_hygiene",
          f"SELECT event_id, CASE WHEN regexp_full_match(event_type, {_BLANK}) THEN NULL ELSE event_type END"
          f" AS event_type, CASE WHEN regexp_full_match(props, {_BLANK}) THEN NULL ELSE props END AS props"
          " FROM fx_blanks")
def q_load_hygiene(spark, sf):
    return sources.clean_loaded(fixture(spark, sf, "fx_blanks"))


TRUNCATE_WIDTH = 256


@register("truncate_bytes",
          f"SELECT doc_id, CASE WHEN strlen(text) <= {TRUNCATE_WIDTH} THEN text ELSE left(text, list_max(list_filter("
          f"range(0, {TRUNCATE_WIDTH} + 1), lambda i: strlen(left(text, i)) <= {TRUNCATE_WIDTH}))) END AS text"
          " FROM documents")
def q_truncate_bytes(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    return docs.select("doc_id", truncate_utf8(F.col("text"), TRUNCATE_WIDTH).alias("text"))


@register("csv_header_scan", "SELECT CAST(count(*) AS BIGINT) AS n_rows FROM fx_siren")
def q_csv_header_scan(spark, sf):
    path = landing.land_registry(spark, sf, scratch_path(spark, "registry-csv"))
    return row_count(sources.csv_header_scan(spark, path))


# --- sinks ---------------------------------------------------------------------------

def _warehouse(spark) -> Warehouse:
    return Warehouse(spark, scratch_path(spark, "warehouse"))


@register("table_scan", "SELECT * FROM dwh_marches")
def q_table_scan(spark, sf):
    wh = _warehouse(spark)
    wh.overwrite(dwh_marches(spark, sf), "dwh", "decp_marches")
    return wh.read("dwh", "decp_marches")


@register("overwrite_table", "SELECT * FROM dwh_titulaires")
def q_overwrite_table(spark, sf):
    wh = _warehouse(spark)
    wh.overwrite(datalake_titulaires(spark, sf), "dwh", "decp_titulaires")
    wh.overwrite(contracts.dwh_titulaires(wh.read("dwh", "decp_titulaires")), "dwh", "decp_titulaires")
    return wh.read("dwh", "decp_titulaires")


# every code as the old content, then a batch of all odd codes and as many new ones
_UPSERT_ORACLE = """
SELECT codecpv, if(CAST(codecpv AS BIGINT) % 2 = 0, description || ' old', description) AS description FROM fx_cpv
UNION ALL SELECT 'N' || right(codecpv, 7), description FROM fx_cpv
"""


@register("upsert", _UPSERT_ORACLE)
def q_upsert(spark, sf):
    cpv = fixture(spark, sf, "fx_cpv")
    wh = _warehouse(spark)
    wh.overwrite(cpv.select("codecpv", F.concat("description", F.lit(" old")).alias("description")),
                 "datalake", "cpv_attributes", key="codecpv")
    new = cpv.select(F.concat(F.lit("N"), F.right("codecpv", F.lit(7))).alias("codecpv"), "description")
    batch = cpv.where(F.col("codecpv").cast("bigint") % 2 != 0).unionByName(new)
    wh.upsert(batch, "datalake", "cpv_attributes", "codecpv")
    return wh.read("datalake", "cpv_attributes")


@register("write_delimited", "SELECT * FROM fx_cpv")
def q_write_delimited(spark, sf):
    raw = fixture(spark, sf, "fx_cpv_raw").select(F.col("CODE").alias("codecpv"), F.col("EN").alias("description"))
    path = scratch_path(spark, "cpv-csv")
    sinks.write_delimited(raw, path, sep="|")
    return sources.clean_loaded(sources.read_delimited(spark, path, schemas.CPV, sep="|"), schemas.CPV_WIDTHS)


_APPEND_ORACLE = """
SELECT * FROM fx_cpv WHERE CAST(codecpv AS BIGINT) % 2 = 0
UNION ALL SELECT * FROM fx_cpv WHERE CAST(codecpv AS BIGINT) % 2 = 1
"""


@register("append_into", _APPEND_ORACLE)
def q_append_into(spark, sf):
    cpv = fixture(spark, sf, "fx_cpv")
    n = F.col("codecpv").cast("bigint")
    wh = _warehouse(spark)
    wh.overwrite(cpv.where(n % 2 == 0), "datalake", "cpv_attributes")
    wh.append(cpv.where(n % 2 == 1).select("description", "codecpv"), "datalake", "cpv_attributes")
    return wh.read("datalake", "cpv_attributes")


# --- quality checks -----------------------------------------------------------------

@register("check_not_empty", "SELECT CAST(count(*) AS BIGINT) AS n_rows FROM dwh_marches")
def q_check_not_empty(spark, sf):
    return quality.check_not_empty(dwh_marches(spark, sf))


@register("check_unique_key",
          "SELECT count(*) AS max_rows_per_key FROM titulaires_keyed GROUP BY decp_bridge_uid"
          " ORDER BY max_rows_per_key DESC LIMIT 1")
def q_check_unique_key(spark, sf):
    return quality.check_unique_key(contracts.award_uid(fixture(spark, sf, "fx_titulaires")), "decp_bridge_uid")


#: Checked tables: key and DuckDB step of each.
_KEYED = {
    "staging.decp_titulaires": ("decp_bridge_uid", "titulaires_keyed"),
    "datalake.decp_marches": ("decp_uid", "marches_unique"),
    "datalake.decp_titulaires": ("decp_bridge_uid", "titulaires_unique"),
    "dwh.decp_marches": ("decp_uid", "dwh_marches"),
    "dwh.decp_titulaires": ("decp_bridge_uid", "dwh_titulaires"),
    "dwh.decp_siren_used": ("siren", "siren_used"),
    "datalake.siren_attributes": ("siren", "fx_siren"),
    "dwh.siren_attributes": ("siren", "dwh_siren"),
    "datalake.infogreffe_attributes": ("infogreffe_uid", "st_unique"),
    "dwh.infogreffe_attributes": ("infogreffe_uid", "dwh_statements"),
    "datalake.cpv_attributes": ("codecpv", "fx_cpv"),
    "dwh.cpv_attributes": ("codecpv", "fx_cpv"),
}


def _keyed_tables(spark, sf):
    """The checked tables; those that others derive from are written once and read from there."""
    marches = materialize(contracts.marches_unique(fixture(spark, sf, "fx_marches")), "decp_marches")
    awards = materialize(datalake_titulaires(spark, sf), "decp_titulaires")
    dwh_awards = materialize(contracts.dwh_titulaires(awards).select("decp_bridge_uid", "siren"), "dwh_titulaires")
    used = materialize(contracts.siren_used(dwh_awards), "siren_used")
    filed = materialize(datalake_statements(spark, sf), "statements")
    registry, codes_ = fixture(spark, sf, "fx_siren"), fixture(spark, sf, "fx_cpv")
    frames = {
        "staging.decp_titulaires": contracts.award_uid(fixture(spark, sf, "fx_titulaires")),
        "datalake.decp_marches": marches,
        "datalake.decp_titulaires": awards,
        "dwh.decp_marches": contracts.marches_prepared(marches),
        "dwh.decp_titulaires": dwh_awards,
        "dwh.decp_siren_used": used,
        "datalake.siren_attributes": registry,
        "dwh.siren_attributes": companies.siren_of_interest(companies.siren_standardized(registry), used),
        "datalake.infogreffe_attributes": filed,
        "dwh.infogreffe_attributes": statements.dwh_statements_of_interest(filed, used),
        "datalake.cpv_attributes": codes_,
        "dwh.cpv_attributes": codes.cpv_refresh(codes_),
    }
    return {name: (frames[name], key) for name, (key, _) in _KEYED.items()}


_QUALITY_ORACLE = """
SELECT table_name, CAST(sum(n) AS BIGINT) AS n_rows, max(n) AS max_rows_per_key, max(n) <= 1 AS passed
FROM ({}) per_key GROUP BY table_name
""".format(" UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS n FROM {step} GROUP BY {key}"
                              for name, (key, step) in _KEYED.items()))


@register("quality_report", _QUALITY_ORACLE)
def q_quality_report(spark, sf):
    return quality.quality_report(_keyed_tables(spark, sf))


# --- profiling ------------------------------------------------------------------------

def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.round(F.col(c), 2).alias(c) if c in cols else F.col(c) for c in df.columns])


@register("row_count", "SELECT CAST(count(*) AS BIGINT) AS n_rows FROM dwh_marches")
def q_row_count(spark, sf):
    return profile.row_count(dwh_marches(spark, sf))


_MARCHES_PROFILED = contracts.MARCHES_COLUMNS + ["suspicious_amount"]
_NULL_SHARE = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS null_share FROM dwh_marches"
    for c in _MARCHES_PROFILED)


@register("null_share", _NULL_SHARE)
def q_null_share(spark, sf):
    return profile.null_share(dwh_marches(spark, sf), _MARCHES_PROFILED)


@register("key_uniqueness",
          "SELECT CAST(count(DISTINCT decp_bridge_uid) AS BIGINT) AS n_distinct, CAST(count(*) AS BIGINT) AS n_rows,"
          " count(DISTINCT decp_bridge_uid) / count(*) AS ratio, count(DISTINCT decp_bridge_uid) = count(*)"
          " AS is_unique FROM titulaires_keyed")
def q_key_uniqueness(spark, sf):
    return profile.key_uniqueness(contracts.award_uid(fixture(spark, sf, "fx_titulaires")), "decp_bridge_uid")


@register("max_rows_per_key",
          "SELECT count(*) AS max_rows_per_key FROM fx_siren GROUP BY siren ORDER BY max_rows_per_key DESC LIMIT 1")
def q_max_rows_per_key(spark, sf):
    return profile.max_rows_per_key(fixture(spark, sf, "fx_siren"), "siren")


@register("numeric_summary",
          "SELECT CAST(count(montant) AS BIGINT) AS n, round(avg(montant), 2) AS mean,"
          " round(stddev_samp(montant), 2) AS std, round(min(montant), 2) AS min,"
          " round(quantile_cont(montant, 0.25), 2) AS p25, round(quantile_cont(montant, 0.5), 2) AS p50,"
          " round(quantile_cont(montant, 0.75), 2) AS p75, round(max(montant), 2) AS max FROM dwh_marches")
def q_numeric_summary(spark, sf):
    out = profile.numeric_summary(dwh_marches(spark, sf), "montant")
    return _rounded(out, "mean", "std", "min", "p25", "p50", "p75", "max")


# numeric columns of the filed statements, explored together
_MEASURES = ["millesime", "duree", "ca", "resultat", "effectif"]
_SUMMARIES = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS n, round(avg({c}), 2) AS mean,"
    f" round(stddev_samp({c}), 2) AS std, round(CAST(min({c}) AS DOUBLE), 2) AS min,"
    f" round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 2) AS p25,"
    f" round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 2) AS p50,"
    f" round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 2) AS p75, round(CAST(max({c}) AS DOUBLE), 2) AS max"
    f" FROM st_unique" for c in _MEASURES)


@register("numeric_summaries", _SUMMARIES)
def q_numeric_summaries(spark, sf):
    filed = materialize(datalake_statements(spark, sf).select(*_MEASURES), "measures")
    return _rounded(profile.numeric_summaries(filed, _MEASURES), "mean", "std", "min", "p25", "p50", "p75", "max")


_BOX = """
SELECT round(q1, 2) AS q1, round(med, 2) AS median, round(q3, 2) AS q3, round(q3 - q1, 2) AS iqr,
       round(min(CASE WHEN montant >= q1 - 1.5 * (q3 - q1) AND montant <= q3 + 1.5 * (q3 - q1) THEN montant END), 2)
         AS lower_whisker,
       round(max(CASE WHEN montant >= q1 - 1.5 * (q3 - q1) AND montant <= q3 + 1.5 * (q3 - q1) THEN montant END), 2)
         AS upper_whisker,
       CAST(count(*) FILTER (WHERE NOT (montant >= q1 - 1.5 * (q3 - q1) AND montant <= q3 + 1.5 * (q3 - q1)))
         AS BIGINT) AS n_outliers
FROM dwh_marches,
     (SELECT quantile_cont(montant, 0.25) AS q1, quantile_cont(montant, 0.5) AS med,
             quantile_cont(montant, 0.75) AS q3 FROM dwh_marches) q
WHERE montant IS NOT NULL
GROUP BY q1, med, q3
"""


@register("box_stats", _BOX)
def q_box_stats(spark, sf):
    out = profile.box_stats(dwh_marches(spark, sf), "montant")
    return _rounded(out, "q1", "median", "q3", "iqr", "lower_whisker", "upper_whisker")


_BOXES = " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, round(q[1], 2) AS q1, round(q[2], 2) AS median, round(q[3], 2) AS q3,
       round(q[3] - q[1], 2) AS iqr, round(min(v) FILTER (WHERE NOT far), 2) AS lower_whisker,
       round(max(v) FILTER (WHERE NOT far), 2) AS upper_whisker, CAST(count_if(far) AS BIGINT) AS n_outliers
FROM (SELECT v, q, v < q[1] - 1.5 * (q[3] - q[1]) OR v > q[3] + 1.5 * (q[3] - q[1]) AS far
      FROM (SELECT CAST({c} AS DOUBLE) AS v FROM st_unique WHERE {c} IS NOT NULL) x,
           (SELECT quantile_cont(CAST({c} AS DOUBLE), [0.25, 0.5, 0.75]) AS q FROM st_unique) quartiles) marked
GROUP BY q""" for c in _MEASURES)


@register("box_stats_of", _BOXES)
def q_box_stats_of(spark, sf):
    filed = materialize(datalake_statements(spark, sf).select(*_MEASURES), "measures")
    return _rounded(profile.box_stats_of(filed, _MEASURES), "q1", "median", "q3", "iqr", "lower_whisker",
                    "upper_whisker")


@register("amount_outliers",
          "SELECT *, CASE WHEN montant >= 100000000 THEN 'huge' ELSE 'zero' END AS kind FROM dwh_marches"
          " WHERE montant >= 100000000 OR montant = 0")
def q_amount_outliers(spark, sf):
    return profile.amount_outliers(dwh_marches(spark, sf), "montant", 1e8)


@register("date_coerce",
          "SELECT CAST(count(*) AS BIGINT) AS n_rows,"
          " CAST(count(*) FILTER (WHERE TRY_CAST(datenotification AS DATE) IS NULL) AS BIGINT) AS n_null,"
          " avg(CASE WHEN TRY_CAST(datenotification AS DATE) IS NULL THEN 1 ELSE 0 END) AS null_share"
          " FROM fx_marches")
def q_date_coerce(spark, sf):
    return profile.date_coerce(fixture(spark, sf, "fx_marches"), "datenotification")


_EPOCH = "DATE '1970-01-01'"


@register("date_summary",
          f"SELECT CAST(count(d) AS BIGINT) AS n, round(avg(d), 2) AS mean_day,"
          f" {_EPOCH} + CAST(min(d) AS INTEGER) AS min,"
          f" {_EPOCH} + CAST(floor(quantile_cont(d, 0.25)) AS INTEGER) AS p25,"
          f" {_EPOCH} + CAST(floor(quantile_cont(d, 0.5)) AS INTEGER) AS p50,"
          f" {_EPOCH} + CAST(floor(quantile_cont(d, 0.75)) AS INTEGER) AS p75,"
          f" {_EPOCH} + CAST(max(d) AS INTEGER) AS max"
          f" FROM (SELECT date_diff('day', {_EPOCH}, datenotification) AS d FROM dwh_marches) x")
def q_date_summary(spark, sf):
    return _rounded(profile.date_summary(dwh_marches(spark, sf), "datenotification"), "mean_day")


_DATES = ["datenotification", "datepublicationdonnees"]
_DATE_SUMMARIES = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count(d) AS BIGINT) AS n, round(avg(d), 2) AS mean_day, "
    + ", ".join(f"{_EPOCH} + CAST(floor({x}) AS INTEGER) AS {name}" for name, x in (
        ("min", "min(d)"), ("p25", "quantile_cont(d, 0.25)"), ("p50", "quantile_cont(d, 0.5)"),
        ("p75", "quantile_cont(d, 0.75)"), ("max", "max(d)")))
    + f" FROM (SELECT date_diff('day', {_EPOCH}, {c}) AS d FROM dwh_marches) x" for c in _DATES)


@register("date_summaries", _DATE_SUMMARIES)
def q_date_summaries(spark, sf):
    dates = materialize(dwh_marches(spark, sf).select(*_DATES), "dates")
    return _rounded(profile.date_summaries(dates, _DATES), "mean_day")


@register("future_dates", "SELECT * FROM dwh_marches WHERE year(datenotification) > 2021")
def q_future_dates(spark, sf):
    return profile.future_dates(dwh_marches(spark, sf), "datenotification", 2021)


_MONTHLY = ("SELECT CAST(year({c}) AS VARCHAR) || '-' || lpad(CAST(month({c}) AS VARCHAR), 2, '0') AS year_month,"
            " CAST(count(*) AS BIGINT) AS n FROM dwh_marches WHERE {c} IS NOT NULL {extra} GROUP BY 1 ORDER BY 1")


@register("monthly_histogram", _MONTHLY.format(
    c="datenotification", extra="AND year(datenotification) >= 2018 AND year(datenotification) <= 2021"))
def q_monthly_histogram(spark, sf):
    return profile.monthly_histogram(dwh_marches(spark, sf), "datenotification", 2018, 2021)


@register("monthly_histogram_publication", _MONTHLY.format(c="datepublicationdonnees", extra=""))
def q_monthly_histogram_publication(spark, sf):
    return profile.monthly_histogram(dwh_marches(spark, sf), "datepublicationdonnees")


@register("value_counts",
          "SELECT millesime AS value, CAST(count(*) AS BIGINT) AS n FROM st_unique WHERE millesime IS NOT NULL"
          " GROUP BY millesime ORDER BY n DESC, value")
def q_value_counts(spark, sf):
    return profile.value_counts(datalake_statements(spark, sf), "millesime")


@register("value_counts_top5",
          "SELECT codecpv AS value, CAST(count(*) AS BIGINT) AS n FROM dwh_marches WHERE codecpv IS NOT NULL"
          " GROUP BY codecpv ORDER BY n DESC, value LIMIT 5")
def q_value_counts_top5(spark, sf):
    return profile.value_counts(dwh_marches(spark, sf), "codecpv", k=5)


@register("null_share_by_category",
          "SELECT tranche_ca_millesime, avg(CASE WHEN ca IS NULL THEN 1 ELSE 0 END) AS ca_pct_null FROM st_unique"
          " WHERE tranche_ca_millesime IS NOT NULL GROUP BY tranche_ca_millesime ORDER BY tranche_ca_millesime")
def q_null_share_by_category(spark, sf):
    return profile.null_share_by_category(datalake_statements(spark, sf), "tranche_ca_millesime", "ca")


@register("decade_histogram",
          "SELECT CAST(1900 + 10 * floor((year(CAST(dateDebut AS DATE)) - 1900) / 10) AS BIGINT) AS decade,"
          " CAST(count(*) AS BIGINT) AS n FROM fx_siren GROUP BY 1 ORDER BY 1 NULLS FIRST")
def q_decade_histogram(spark, sf):
    return profile.decade_histogram(fixture(spark, sf, "fx_siren"), "dateDebut")


@register("sample_rows",
          "SELECT * FROM dwh_marches"
          " ORDER BY md5(coalesce(CAST(decp_uid AS VARCHAR), '') || '#42'), decp_uid ASC NULLS LAST LIMIT 100")
def q_sample_rows(spark, sf):
    return profile.sample_rows(dwh_marches(spark, sf), 100, "decp_uid", seed=42)


@register("first_rows", "SELECT least(1000, count(*)) AS n_rows FROM dwh_marches")
def q_first_rows(spark, sf):
    return profile.row_count(profile.first_rows(dwh_marches(spark, sf), 1000))


# profiles the explorations ran on the other tables

_STATEMENTS_PROFILED = ["infogreffe_uid", "siren", *statements.LONG_COLUMNS]


@register("null_share_statements", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, avg(CAST({c} IS NULL AS INTEGER)) AS null_share FROM st_unique"
    for c in _STATEMENTS_PROFILED))
def q_null_share_statements(spark, sf):
    return profile.null_share(datalake_statements(spark, sf), _STATEMENTS_PROFILED)


@register("key_uniqueness_statements",
          "SELECT count(DISTINCT infogreffe_uid) AS n_distinct, count(*) AS n_rows,"
          " count(DISTINCT infogreffe_uid) / count(*) AS ratio, count(DISTINCT infogreffe_uid) = count(*) AS is_unique"
          " FROM st_unique")
def q_key_uniqueness_statements(spark, sf):
    return profile.key_uniqueness(datalake_statements(spark, sf), "infogreffe_uid")


@register("value_counts_revenue_band",
          "SELECT tranche_ca_millesime AS value, count(*) AS n FROM st_unique WHERE value IS NOT NULL GROUP BY ALL"
          " ORDER BY n DESC, value")
def q_value_counts_revenue_band(spark, sf):
    return profile.value_counts(datalake_statements(spark, sf), "tranche_ca_millesime")


@register("value_counts_codes",
          "SELECT codecpv AS value, count(*) AS n FROM fx_cpv WHERE codecpv IS NOT NULL GROUP BY ALL ORDER BY n DESC, value")
def q_value_counts_codes(spark, sf):
    return profile.value_counts(fixture(spark, sf, "fx_cpv"), "codecpv")


# --- streaming ------------------------------------------------------------------------

STREAM_BATCHES = 4


@register("stream_contract_ingest", "SELECT * FROM marches_unique")
def q_stream_contract_ingest(spark, sf):
    from tenderlake.plans.pipeline import Pipeline
    from tenderlake.streaming import ingest_contracts
    landed = landing.land_contracts(spark, sf, scratch_path(spark, "contracts-stream"))
    wh = _warehouse(spark)
    # a few micro-batches, in whatever order the files come: the result must not depend on it
    files = len(spark.read.text(landed).inputFiles())
    q = ingest_contracts(spark, landed, wh, scratch_path(spark, "stream-ckpt"),
                         max_files_per_trigger=max(1, -(-files // STREAM_BATCHES)))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    Pipeline(spark, wh).settle_contracts()
    return wh.read("datalake", "decp_marches").select(*contracts.MARCHES_COLUMNS)


# --- the whole pipeline on landed files ---------------------------------------------------

@register("landed_fact_per_suppliername", _RPT_SUPPLIER)
def q_landed_fact_per_suppliername(spark, sf):
    from tenderlake.plans.pipeline import Pipeline
    paths = landing.land_all(spark, sf, scratch_path(spark, "pipeline-landing"))
    # the result is defined for companies that share a number, too: each of their names gets the number's spend
    pipe = Pipeline(spark, _warehouse(spark), strict=False)
    pipe.run_all(paths["contracts"], paths["registry"], paths["statements"], paths["codes"], statements_header=False)
    return pipe.wh.read("dwh", "fact_per_suppliername").select("sirenname", money("total_amount"), "n_contract")
