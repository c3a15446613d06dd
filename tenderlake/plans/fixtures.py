"""Input fixtures in the reference's landed shapes, derived from the driver's
TPC-H-like tables.

Each derivation is one SQL text that runs unchanged on Spark SQL and on
DuckDB.  Table names are written as ``{orders}`` placeholders: Spark binds
them to DataFrames (``spark.sql(text, orders=df)``, no shared temp views),
the DuckDB oracle formats them to the pre-registered view names.  They plant
duplicate keys, NULL / far-future dates, NULL / zero / huge amounts, dirty
identifiers, wrong identifier types, registry misses, unnamed companies, bad
fiscal years, NULL key parts and same-key rows with different measures.
Only ``fx_titulaires`` is built by DataFrame code on Spark, see ``_titulaires``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FX_MARCHES = """
WITH b AS (SELECT o_orderkey k, CAST(o_orderdate AS DATE) d, o_totalprice p, o_orderstatus st, o_orderpriority pr, c_custkey, c_name
           FROM {orders} JOIN {customer} ON o_custkey = c_custkey),
v AS (SELECT b.*, 0 AS ver FROM b UNION ALL SELECT b.*, 1 AS ver FROM b WHERE k % 7 = 0)
SELECT 'uid-' || CAST(k AS STRING) AS decp_uid, st AS source, CAST(k AS STRING) AS decp_id, 'Marche' AS type, pr AS nature,
 'Procedure ' || CAST(k % 4 AS STRING) AS procedure, 'objet ' || CAST(k AS STRING) || ' v' || CAST(ver AS STRING) AS objet,
 lpad(CAST(k % 2000 AS STRING), 8, '0') AS codecpv, CAST(k % 48 AS INT) AS dureemois,
 CASE WHEN k % 97 = 0 THEN NULL WHEN k % 499 = 1 THEN '2202-03-01'
      WHEN k % 101 = 0 THEN CAST(CAST(date_part('year', d) AS INT) + 20 AS STRING) || '-' || CAST(CAST(date_part('month', d) AS INT) AS STRING)
       || '-' || CAST(CAST(date_part('day', d) AS INT) AS STRING) || CASE WHEN k % 2 = 0 THEN 'T10:00:00' ELSE ' 00:00' END
      ELSE CAST(CAST(date_part('year', d) AS INT) + 20 AS STRING) || substring(CAST(d AS STRING), 5) END AS datenotification,
 CASE WHEN k % 14 = 0 AND ver = 0 THEN NULL
      ELSE CAST(CAST(CAST(CAST(date_part('year', d) AS INT) + 20 AS STRING) || substring(CAST(d AS STRING), 5) AS DATE) + CAST(30 * (1 + ver) AS INT) AS STRING) END AS datepublicationdonnees,
 CASE WHEN k % 89 = 0 THEN NULL WHEN k % 83 = 0 THEN 0.0e0 WHEN k % 250 = 0 THEN p * 1000 ELSE p END AS montant,
 CASE WHEN k % 2 = 0 THEN 'Ferme' ELSE 'Revisable' END AS formeprix, CAST(c_custkey AS STRING) AS acheteur_id, c_name AS acheteur_name
FROM v
"""

FX_TITULAIRES = """
WITH b AS (SELECT DISTINCT l_orderkey k, l_suppkey s, s_name n, CAST(CASE WHEN l_suppkey % 10 = 9 THEN 400000000 ELSE 500000000 END + l_suppkey * 7919 AS STRING) sn, (l_orderkey + l_suppkey) % 9 m
           FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey),
r AS (SELECT 'uid-' || CAST(k AS STRING) AS decp_uid,
 CASE m WHEN 0 THEN sn || '00012' WHEN 1 THEN sn
  WHEN 2 THEN ' ' || substring(sn,1,3) || ' ' || substring(sn,4,3) || '.' || substring(sn,7,3) || '-00012 '
  WHEN 3 THEN 'FR' || lpad(CAST((12 + 3 * (CAST(sn AS INT) % 97)) % 97 AS STRING), 2, '0') || sn
  WHEN 4 THEN 'de' || sn WHEN 5 THEN '999999999' WHEN 6 THEN sn || '00012' WHEN 7 THEN NULL ELSE '12AB' END AS titulaire_id,
 n AS titulaire_name,
 CASE m WHEN 3 THEN 'TVA' WHEN 4 THEN 'TVA_INTRA' WHEN 6 THEN 'siret' ELSE 'SIRET' END AS titulaire_typeidentifiant, k
 FROM b)
SELECT decp_uid, titulaire_id, '  ' || titulaire_name || ' SA ' AS titulaire_name, titulaire_typeidentifiant FROM r
UNION ALL SELECT decp_uid, titulaire_id, titulaire_name, titulaire_typeidentifiant FROM r WHERE k % 5 = 0
"""

# Companies: every supplier and every customer.  Awards of suppliers whose key
# ends in 9 go to foreign companies that no registry lists.
_COMPANIES = """c AS (SELECT CAST(s_suppkey AS BIGINT) AS k, 500000000 + s_suppkey * 7919 AS sn FROM {supplier}
 UNION ALL SELECT CAST(c_custkey AS BIGINT), 600000000 + c_custkey FROM {customer})"""

FX_SIREN = f"""
WITH {_COMPANIES}
SELECT CAST(sn AS STRING) AS siren,
 CASE WHEN k % 4 = 0 THEN 'Nom' || CAST(k AS STRING) END AS nomUniteLegale,
 CASE WHEN k % 8 = 0 THEN 'Usage' END AS nomUsageUniteLegale,
 CASE WHEN k % 4 <> 0 AND k % 11 <> 1 THEN 'Denom' || CAST(k % 20 AS STRING) END AS denominationUniteLegale,
 CAST(NULL AS STRING) AS denominationUsuelle1UniteLegale,
 CASE k % 3 WHEN 0 THEN 'O' WHEN 1 THEN 'N' END AS economieSocialeSolidaireUniteLegale,
 lpad(CAST(k % 13 AS STRING), 2, '0') AS trancheEffectifsUniteLegale,
 CASE k % 3 WHEN 0 THEN 'PME' WHEN 1 THEN 'ETI' ELSE 'GE' END AS categorieEntreprise,
 CAST(1695 + k % 335 AS STRING) || '-06-01' AS dateDebut
FROM c
"""

FX_INFOGREFFE = f"""
WITH {_COMPANIES}, r AS (SELECT k, sn, 0 AS rev FROM c UNION ALL SELECT k, sn, 1 AS rev FROM c)
SELECT CAST(sn AS STRING) AS siren,
 '2019' AS millesime_1, CASE WHEN rev = 0 THEN '2019-12-31' ELSE '2019-06-30' END AS date_de_cloture_exercice_1,
 CASE WHEN k % 6 = 0 AND rev = 1 THEN '6' ELSE '12' END AS duree_1, 'A' AS tranche_ca_millesime_1,
 CASE WHEN k % 5 = 0 THEN NULL ELSE CAST(k * 1000 AS STRING) END AS ca_1, CAST(k * 10 AS STRING) AS resultat_1, CAST(k AS STRING) AS effectif_1,
 CASE WHEN k % 9 = 0 THEN '18' ELSE '2018' END AS millesime_2, '2018-12-31' AS date_de_cloture_exercice_2,
 CASE WHEN k % 17 = 0 THEN NULL ELSE '12' END AS duree_2, 'B' AS tranche_ca_millesime_2,
 CAST(k * 900 + rev AS STRING) AS ca_2, CAST(k * 9 AS STRING) AS resultat_2, CAST(NULL AS STRING) AS effectif_2
FROM r
"""

FX_CPV = """
SELECT lpad(CAST(p_partkey AS STRING), 8, '0') AS codecpv, p_name AS description FROM {part}
"""

# The published code list before cleaning: ``NNNNNNNN-N`` codes.
FX_CPV_RAW = """
SELECT lpad(CAST(p_partkey AS STRING), 8, '0') || '-' || CAST(p_partkey % 10 AS STRING) AS CODE, p_name AS EN FROM {part}
"""

# events with blank and whitespace-only text planted (load hygiene).
FX_BLANKS = """
SELECT event_id,
 CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 11 = 0 THEN '   ' WHEN event_id % 13 = 0 THEN ' ' || chr(9) || ' '
      ELSE event_type END AS event_type,
 CASE WHEN event_id % 17 = 0 THEN chr(10) WHEN event_id % 19 = 0 THEN ' x ' ELSE props END AS props
FROM {events}
"""

FIXTURES = {
    "fx_marches": FX_MARCHES,
    "fx_titulaires": FX_TITULAIRES,
    "fx_siren": FX_SIREN,
    "fx_infogreffe": FX_INFOGREFFE,
    "fx_cpv": FX_CPV,
    "fx_cpv_raw": FX_CPV_RAW,
    "fx_blanks": FX_BLANKS,
}

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def tables_of(sql: str) -> list[str]:
    return sorted(set(_PLACEHOLDER.findall(sql)))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Spark DataFrame of fixture ``name`` over the tables in ``sf_dir``."""
    sql = FIXTURES[name]
    tables = {t: read_table(spark, sf_dir, t) for t in tables_of(sql)}
    return _titulaires(**tables) if name == "fx_titulaires" else spark.sql(sql, **tables)


def _titulaires(lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    """The rows of ``FX_TITULAIRES``, whose cast of a company's number to INT fails from supplier 208042 on.

    The number stays a long here; as far as the SQL text runs, the rows are the same.
    """
    s, m, sn = F.col("l_suppkey"), F.col("m"), F.col("sn")
    # DISTINCT then finds the rows of an order together: numbers are shuffled, no text
    lines = lineitem.select("l_orderkey", "l_suppkey").repartition("l_orderkey")
    number = F.when(s % 10 == 9, 400000000).otherwise(500000000) + s * 7919
    b = (lines.join(supplier, s == F.col("s_suppkey"))
         .select(F.col("l_orderkey").alias("k"), s.alias("s"), F.col("s_name").alias("n"), number.cast("string").alias("sn"),
                 ((F.col("l_orderkey") + s) % 9).alias("m")).distinct())
    vat_key = F.lpad(((12 + 3 * (sn.cast("bigint") % 97)) % 97).cast("string"), 2, "0")
    spaced = F.concat(F.lit(" "), F.substring(sn, 1, 3), F.lit(" "), F.substring(sn, 4, 3), F.lit("."),
                      F.substring(sn, 7, 3), F.lit("-00012 "))
    siret = F.concat(sn, F.lit("00012"))
    tid = (F.when(m == 0, siret).when(m == 1, sn).when(m == 2, spaced).when(m == 3, F.concat(F.lit("FR"), vat_key, sn))
           .when(m == 4, F.concat(F.lit("de"), sn)).when(m == 5, "999999999").when(m == 6, siret)
           .when(m == 7, F.lit(None)).otherwise("12AB"))
    kind = F.when(m == 3, "TVA").when(m == 4, "TVA_INTRA").when(m == 6, "siret").otherwise("SIRET")
    r = b.select(F.concat(F.lit("uid-"), F.col("k").cast("string")).alias("decp_uid"), tid.alias("titulaire_id"),
                 F.col("n").alias("titulaire_name"), kind.alias("titulaire_typeidentifiant"), "k")
    padded = F.concat(F.lit("  "), F.col("titulaire_name"), F.lit(" SA ")).alias("titulaire_name")
    return (r.select("decp_uid", "titulaire_id", padded, "titulaire_typeidentifiant")
            .unionAll(r.where(F.col("k") % 5 == 0)
                      .select("decp_uid", "titulaire_id", "titulaire_name", "titulaire_typeidentifiant")))


def duckdb_sql(name: str) -> str:
    """The same fixture as a DuckDB subquery over the pre-registered views."""
    sql = FIXTURES[name]
    return sql.format(**{t: t for t in tables_of(sql)})
