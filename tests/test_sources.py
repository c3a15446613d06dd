"""File-shaped sources on hand-written files."""

import json
import os

import pytest

from tenderlake import schemas
from tenderlake.sources import (award_rows, clean_loaded, contract_rows, csv_header_scan, landed_contracts,
                                read_contracts, read_delimited, rejected_documents, strip_escapes, value_defects)


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_contract_document_variants(spark, tmp_dir):
    doc = {"marches": [
        {"uid": "a", "objet": "tab\there", "acheteur": {"id": "B1", "nom": "Buyer"},
         "titulaires": [{"id": "1", "denominationSociale": "S1", "typeIdentifiant": "SIRET"},
                        {"id": "2", "denominationSociale": "S2", "typeIdentifiant": "SIRET"}]},
        {"uid": "b", "titulaires": None},
        {"uid": "c", "titulaires": []},
        {"uid": "d"},
        {"uid": "e", "titulaires": "not a list", "montant": 12.5, "dureeMois": 3},
    ]}
    # one pretty-printed document (multi-line) and the same as one line
    _write(f"{tmp_dir}/pretty/doc.json", json.dumps(doc, indent=2))
    _write(f"{tmp_dir}/lines/doc.json", json.dumps(doc) + "\n" + json.dumps({"marches": [{"uid": "f"}]}) + "\n")
    pretty = read_contracts(spark, f"{tmp_dir}/pretty", multi_line=True)
    lines = read_contracts(spark, f"{tmp_dir}/lines")
    assert pretty.count() == 5 and lines.count() == 6
    rows = strip_escapes(contract_rows(pretty))
    got = {r["decp_uid"]: r for r in rows.collect()}
    assert got["a"]["objet"] == "tabhere" and got["a"]["acheteur_name"] == "Buyer"
    assert got["e"]["montant"] == 12.5 and got["e"]["dureemois"] == 3
    awards = award_rows(pretty).collect()
    assert sorted(r["titulaire_id"] for r in awards) == ["1", "2"]


def test_csv_fail_fast_and_fill(spark, tmp_dir):
    header = ";".join(f.name for f in schemas.STAGING_STATEMENTS.fields)
    full = ";".join(["1"] * 15)
    short = ";".join(["2"] * 10)
    _write(f"{tmp_dir}/st/a.csv", "\n".join([header, full, short, ";".join(["3", " ", ""] + ["3"] * 12)]) + "\n")
    filled = read_delimited(spark, f"{tmp_dir}/st", schemas.STAGING_STATEMENTS, sep=";x", fill_missing=True)
    got = {r["siren"]: r for r in clean_loaded(filled).collect()}
    assert got["2"]["effectif_2"] is None and got["2"]["resultat_1"] == "2"
    assert got["3"]["millesime_1"] is None and got["3"]["date_de_cloture_exercice_1"] is None
    strict = read_delimited(spark, f"{tmp_dir}/st", schemas.STAGING_STATEMENTS, sep=";")
    with pytest.raises(Exception):
        strict.collect()


def test_quoted_delimiters_and_header_scan(spark, tmp_dir):
    _write(f"{tmp_dir}/cpv/a.csv", 'codecpv|description\n03000000-1|"Farm, ""fresh"" | goods"\n')
    df = clean_loaded(read_delimited(spark, f"{tmp_dir}/cpv", schemas.CPV, sep="|"), schemas.CPV_WIDTHS)
    assert [tuple(r) for r in df.collect()] == [("03000000", 'Farm, "fresh" | goods')]
    assert csv_header_scan(spark, f"{tmp_dir}/cpv").count() == 1


def test_json_lines_by_key_name(spark, tmp_dir):
    from tenderlake.sources import read_json_lines
    _write(f"{tmp_dir}/jl/a.json", '{"decp_uid": "1", "titulaire_id": "9", "extra": 1}\n{"titulaire_name": "X"}\n')
    df = read_json_lines(spark, f"{tmp_dir}/jl", schemas.STAGING_TITULAIRES)
    assert df.columns == [f.name for f in schemas.STAGING_TITULAIRES.fields]
    assert sorted(map(tuple, df.collect()), key=str) == sorted(
        [("1", "9", None, None), (None, None, "X", None)], key=str)


def test_truncated_document_stops_the_load_or_is_rejected(spark, tmp_dir):
    good = json.dumps({"marches": [{"uid": "a"}, {"uid": "b"}]})
    _write(f"{tmp_dir}/docs/a.json", good + "\n" + good[:-8] + "\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        read_contracts(spark, f"{tmp_dir}/docs").collect()
    assert read_contracts(spark, f"{tmp_dir}/docs", tolerant=True).count() == 2
    rejected = rejected_documents(spark, f"{tmp_dir}/docs").collect()
    assert [r["document"] for r in rejected] == [good[:-8]]


def test_odd_values_cost_only_themselves_and_are_counted(spark, tmp_dir):
    doc = {"marches": [{"uid": "a", "montant": "n/a", "dureeMois": 2.5,
                        "titulaires": [{"id": "1"}, "odd", 7, {"id": "2"}]},
                       {"uid": "b", "montant": "12", "dureeMois": 3, "acheteur": "name only"}]}
    _write(f"{tmp_dir}/docs/a.json", json.dumps(doc) + "\n")
    rows = read_contracts(spark, f"{tmp_dir}/docs")
    got = {r["uid"]: r for r in rows.collect()}
    assert got["a"]["montant"] is None and got["b"]["montant"] == 12.0 and got["b"]["dureeMois"] == 3
    assert sorted(r["titulaire_id"] for r in award_rows(rows).collect()) == ["1", "2"]
    counts = landed_contracts(spark, f"{tmp_dir}/docs").agg(*value_defects()).first()
    assert counts.asDict() == {"bad_amounts": 1, "bad_durations": 1, "bad_list_elements": 2}


def test_malformed_json_line(spark, tmp_dir):
    from tenderlake.sources import read_json_lines, rejected_lines
    _write(f"{tmp_dir}/jl/a.json", '{"decp_uid": "1"}\n{"decp_uid": "2\n')
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        read_json_lines(spark, f"{tmp_dir}/jl", schemas.STAGING_TITULAIRES).collect()
    assert [r[0] for r in read_json_lines(spark, f"{tmp_dir}/jl", schemas.STAGING_TITULAIRES, tolerant=True).collect()] == ["1"]
    assert [r["line"] for r in rejected_lines(spark, f"{tmp_dir}/jl", schemas.STAGING_TITULAIRES).collect()] == ['{"decp_uid": "2']


@pytest.mark.parametrize("multi_line", [False, True])
@pytest.mark.parametrize("line", ["1;2;3;EXTRA;MORE", "1;2;3;", '6;"7;8', '1;"a;b";2;3'])
def test_fill_mode_forgives_short_rows_only(spark, tmp_dir, line, multi_line):
    from pyspark.sql.types import StringType, StructField, StructType
    three = StructType([StructField(c, StringType()) for c in "abc"])
    _write(f"{tmp_dir}/ok/a.csv", 'a;b;c\n1;2\n4;"x;""y""";6\n7;8;""\n')
    _write(f"{tmp_dir}/bad/a.csv", f"a;b;c\n1;2;3\n{line}\n")
    got = read_delimited(spark, f"{tmp_dir}/ok", three, ";", fill_missing=True, multi_line=multi_line).collect()
    assert [tuple(r) for r in clean_loaded(spark.createDataFrame(got, three)).collect()] == [
        ("1", "2", None), ("4", 'x;"y"', "6"), ("7", "8", None)]
    for fill in (True, False):
        with pytest.raises(Exception, match="malformed record|MALFORMED"):
            read_delimited(spark, f"{tmp_dir}/bad", three, ";", fill_missing=fill, multi_line=multi_line).collect()


def test_open_quote_in_the_last_field(spark, tmp_dir):
    _write(f"{tmp_dir}/c/a.csv", '03000000|"never closed\n')
    for fill in (True, False):
        with pytest.raises(Exception, match="open quote"):
            read_delimited(spark, f"{tmp_dir}/c", schemas.CPV, "|", header=False, fill_missing=fill).collect()


@pytest.mark.parametrize("text, want", [
    ("2019-1-5T10:00:00", "2019-01-05"), ("2019-1-5 00:00", "2019-01-05"), ("2019-1-5", "2019-01-05"),
    ("2019-01-05T10:00:00Z", "2019-01-05"), ("2019-01-05junk", "2019-01-05"), ("2019-12-31", "2019-12-31"),
    ("2001-02-31", None), ("2019-1-5x", None), ("junk", None), ("", None), (None, None), ("2019-1", None)])
def test_lenient_date(spark, text, want):
    from pyspark.sql import functions as F

    from tenderlake.functions import lenient_date
    got = spark.range(1).select(lenient_date(F.lit(text).cast("string")).cast("string").alias("d")).first()["d"]
    assert got == want
