"""Contract documents and JSON-lines sources."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tenderlake import schemas
from tenderlake.functions import strip_control
from tenderlake.sources.spans import array_elements, pieces, small_array_elements

#: Documents up to this many bytes are parsed whole by one task (and no larger than the byte range of a task).
WHOLE_DOCUMENT = 16 << 20


def _bytes(size: str) -> int:
    """A size setting (``134217728``, ``128m``, ``128MB``) in bytes."""
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)i?b?", size.strip().lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def landed_contracts(spark: SparkSession, path: str, multi_line: bool = False, tolerant: bool = False) -> DataFrame:
    """One row per element of ``.marches[]`` of every document, values as text.

    Documents written one per line are split across tasks like any JSON-lines
    input.  ``multi_line`` reads files that hold one document each, however it
    is printed (the contracts are published as a single large one): it is
    split, too, element by element (:func:`array_elements`); a small one is
    parsed whole.

    A malformed document (truncated, not JSON, no object) stops the load.
    With ``tolerant`` it is left out here and listed by
    :func:`rejected_documents`; a large document is then parsed by one task,
    since whether it is sound shows at its end only.
    """
    if multi_line and not tolerant:
        element = F.from_json("element", schemas.LANDED_CONTRACT, {"mode": "FAILFAST"})
        most = min(WHOLE_DOCUMENT, _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes")))
        elements = small_array_elements(spark, path, "marches", most)
        if not pieces(spark, path, "}", most).isEmpty():
            elements = elements.unionByName(array_elements(spark, path, "marches", most))
        return elements.select(element.alias("m")).select("m.*")
    docs = (spark.read.schema(schemas.LANDED_DOCUMENT).option("multiLine", multi_line)
            .option("mode", "PERMISSIVE" if tolerant else "FAILFAST").json(path))
    rows = docs.select(F.explode("marches").alias("m")).select("m.*")
    return rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))) if multi_line else rows


def rejected_documents(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """(document, file) of every document a tolerant load leaves out."""
    schema = StructType([*schemas.LANDED_DOCUMENT.fields, StructField(schemas.CORRUPT, StringType())])
    docs = (spark.read.schema(schema).option("multiLine", multi_line).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", schemas.CORRUPT).json(path))
    # the reader refuses queries that need the corrupt column only
    parsed = F.coalesce(F.size("marches"), F.lit(0)) >= 0
    return (docs.where(F.col(schemas.CORRUPT).isNotNull() & parsed)
            .select(F.col(schemas.CORRUPT).alias("document"), F.input_file_name().alias("file")))


def _is_object(element: Column) -> Column:
    return element.isNull() | F.ltrim(element).startswith("{")


def typed_contracts(landed: DataFrame) -> DataFrame:
    """Landed text to the declared contract types.

    A non-numeric amount or duration becomes NULL, an element of a supplier
    list that is no object is left out; :func:`value_defects` counts both.
    A supplier list that is no list reads as NULL.
    """
    def cast(f):
        c = F.col(f.name)
        if f.name == "titulaires":
            elements = F.from_json(c, "array<string>")
            return F.transform(F.filter(elements, _is_object),
                               lambda e: F.from_json(e, schemas.AWARDEE)).alias(f.name)
        if f.dataType.typeName() == "struct":
            return F.from_json(c, f.dataType).alias(f.name)
        return (c if f.dataType.typeName() == "string" else c.try_cast(f.dataType)).alias(f.name)
    return landed.select(*[cast(f) for f in schemas.CONTRACT.fields])


def value_defects() -> list[Column]:
    """Aggregates over landed contracts: values that typing turns into NULL or leaves out."""
    elements = F.from_json("titulaires", "array<string>")
    return [
        F.count_if(F.col("montant").isNotNull() & F.col("montant").try_cast("double").isNull()).alias("bad_amounts"),
        F.count_if(F.col("dureeMois").isNotNull() & F.col("dureeMois").try_cast("int").isNull()).alias("bad_durations"),
        F.coalesce(F.sum(F.size(F.filter(elements, lambda e: ~_is_object(e)))), F.lit(0)).alias("bad_list_elements")]


def defective_values(landed: DataFrame) -> DataFrame:
    """uid, field, value of every value that :func:`value_defects` counts (list elements one by one)."""
    elements = F.filter(F.from_json("titulaires", "array<string>"), lambda e: ~_is_object(e))

    def odd(name: str, kind: str) -> Column:
        bad = F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()
        return F.when(bad, F.array(F.struct(F.lit(name).alias("field"), F.col(name).alias("value"))))

    in_lists = F.transform(elements, lambda e: F.struct(F.lit("titulaires").alias("field"), e.alias("value")))
    none = F.array().cast("array<struct<field:string,value:string>>")
    found = F.concat(*[F.coalesce(c, none) for c in (odd("montant", "double"), odd("dureeMois", "int"), in_lists)])
    return landed.select("uid", F.explode(found).alias("v")).select("uid", "v.field", "v.value")


def read_contracts(spark: SparkSession, path: str, multi_line: bool = False, tolerant: bool = False) -> DataFrame:
    """SRC-1: contracts of every document in their declared types (see :func:`landed_contracts`)."""
    return typed_contracts(landed_contracts(spark, path, multi_line, tolerant))


def strip_escapes(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """SRC-2: remove tab and newline characters from the given (default: all
    top-level string) columns after parsing."""
    targets = set(columns if columns is not None else
                  [f.name for f in df.schema.fields if f.dataType.typeName() == "string"])
    return df.select(*[strip_control(F.col(c)).alias(c) if c in targets else F.col(c) for c in df.columns])


def contract_rows(contracts: DataFrame) -> DataFrame:
    """SRC-3: the 15 staging columns of each contract."""
    return contracts.select(
        F.col("uid").alias("decp_uid"), "source", F.col("id").alias("decp_id"), F.col("_type").alias("type"),
        "nature", "procedure", "objet", F.col("codeCPV").alias("codecpv"), F.col("dureeMois").alias("dureemois"),
        F.col("dateNotification").alias("datenotification"),
        F.col("datePublicationDonnees").alias("datepublicationdonnees"),
        "montant", F.col("formePrix").alias("formeprix"),
        F.col("acheteur.id").alias("acheteur_id"), F.col("acheteur.nom").alias("acheteur_name"))


def award_rows(contracts: DataFrame) -> DataFrame:
    """SRC-4: one row per awarded supplier.  A missing, NULL, empty or
    non-array supplier list yields no row (``explode`` drops them)."""
    return (contracts.select(F.col("uid").alias("decp_uid"), F.explode("titulaires").alias("t"))
            .select("decp_uid", F.col("t.id").alias("titulaire_id"),
                    F.col("t.denominationSociale").alias("titulaire_name"),
                    F.col("t.typeIdentifiant").alias("titulaire_typeidentifiant")))


def read_json_lines(spark: SparkSession, path: str, schema: StructType, tolerant: bool = False) -> DataFrame:
    """SRC-5: JSON lines matched to columns by key name: a missing key reads
    as NULL, keys not in ``schema`` are ignored.  A malformed line stops the
    load; with ``tolerant`` it is left out and listed by
    :func:`rejected_lines`."""
    if not tolerant:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def rejected_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """(line, file) of every line a tolerant load leaves out."""
    full = StructType([*schema.fields, StructField(schemas.CORRUPT, StringType())])
    lines = (spark.read.schema(full).option("mode", "PERMISSIVE")
             .option("columnNameOfCorruptRecord", schemas.CORRUPT).json(path))
    parsed = F.length(F.concat_ws("", *[F.col(c).cast("string") for c in schema.fieldNames()])) >= 0
    return (lines.where(F.col(schemas.CORRUPT).isNotNull() & parsed)
            .select(F.col(schemas.CORRUPT).alias("line"), F.input_file_name().alias("file")))


def json_fields(df: DataFrame, column: str, schema: StructType, keep: list[str] | None = None) -> DataFrame:
    """SRC-5 on a text column: parse each value with ``schema`` by key name."""
    parsed = F.from_json(F.col(column), schema)
    return df.select(*(keep or []), *[parsed.getField(f.name).alias(f.name) for f in schema.fields])
