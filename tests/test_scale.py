"""Work that must grow no faster than the tables: what is landed, shuffled and parsed, and how often."""

import gzip
import json
import os
from datetime import datetime

import duckdb
import pytest

from tenderlake import schemas
from tenderlake.operators import contracts
from tenderlake.plans import catalog, fixtures, landing
from tenderlake.sources import read_contracts

import __spark_entry__ as E


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _tables(spark, at):
    """A supplier and a customer whose companies get one number, and a supplier with a number of its own."""
    day = datetime(1996, 5, 4)
    rows = {
        "customer": ([(1132, "Customer#1132"), (7, "Customer#7")], "c_custkey long, c_name string"),
        "supplier": ([(12628, "Supplier#12628"), (3, "Supplier#3")], "s_suppkey long, s_name string"),
        "part": ([(k, f"part {k}") for k in range(20)], "p_partkey long, p_name string"),
        "orders": ([(k, 7, "O", 100.0 + k, day, "1-URGENT") for k in range(1, 60)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp,"
                   " o_orderpriority string"),
        "lineitem": ([(k, s) for k in range(1, 60) for s in (12628, 3)], "l_orderkey long, l_suppkey long"),
    }
    con = duckdb.connect()
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{at}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{at}/{name}.parquet/*.parquet')")
    return con


def test_landed_report_of_companies_that_share_a_number(spark, tmp_dir):
    con = _tables(spark, tmp_dir)
    got = E.queries()["landed_fact_per_suppliername"](spark, tmp_dir).collect()
    want = con.sql(E.oracle_sql()["landed_fact_per_suppliername"])
    assert sorted(map(tuple, got)) == sorted(want.fetchall())
    names = {r["sirenname"] for r in got}
    assert "Nom12628Denom" not in names and {"Nom12628", "Nom1132"} <= names


def test_contracts_and_awards_meet_in_one_shuffle(spark, tmp_dir):
    _tables(spark, tmp_dir)
    marches, awards = (landing.fixture(spark, tmp_dir, f"fx_{n}").localCheckpoint() for n in ("marches", "titulaires"))
    docs = landing.contract_documents(marches, awards)
    assert _plan(docs).count("Exchange") == 1
    path = landing.land_contracts(spark, tmp_dir, f"{tmp_dir}/landed")
    files = [f for f in os.listdir(path) if f.endswith((".json", ".gz"))]
    assert files and all(f.endswith(".json.gz") for f in files)
    landed = {r["uid"]: r["n"] for r in read_contracts(spark, path).where("titulaires IS NOT NULL")
              .selectExpr("uid", "size(titulaires) AS n").collect() if r["n"]}
    assert landed == {r["decp_uid"]: r["count"] for r in awards.groupBy("decp_uid").count().collect()}


def test_award_fixture_shuffles_numbers_once(spark, tmp_dir):
    _tables(spark, tmp_dir)
    plan = _plan(landing.fixture(spark, tmp_dir, "fx_titulaires"))
    assert plan.count("Exchange hashpartitioning") == 2  # one for each half of the UNION ALL, the same, so run once
    assert plan.count("Exchange hashpartitioning(l_orderkey") == 2


def test_awards_of_companies_whose_number_is_no_int(spark, tmp_dir):
    keys = (3, 208041, 208042, 359999, None)
    lines = [(k, s) for k in [*range(1, 30), None] for s in keys]
    con = duckdb.connect()
    for name, rows, schema in (
            ("supplier", [(s, s and f"Supplier#{s}") for s in keys] + [(359999, None)], "s_suppkey long, s_name string"),
            ("lineitem", lines + lines, "l_orderkey long, l_suppkey long")):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_dir}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_dir}/{name}.parquet/*.parquet')")
    text = fixtures.duckdb_sql("fx_titulaires")
    want = con.sql(text.replace("CAST(sn AS INT)", "CAST(sn AS BIGINT)")).fetchall()
    got = fixtures.fixture(spark, tmp_dir, "fx_titulaires")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    ids = {r["titulaire_id"] for r in got.collect()}
    numbers = [500000000 + s * 7919 for s in (208041, 208042)]
    assert numbers[0] < 2**31 <= numbers[1]
    assert {f"FR{(12 + 3 * (n % 97)) % 97:02d}{n}" for n in numbers} <= ids
    assert E.queries()["award_uid"](spark, tmp_dir).count() == len(want)
    assert "500023757" in {r["siren"] for r in E.queries()["siren_used"](spark, tmp_dir).collect()}


def test_awards_are_chosen_once_and_hashed_after_the_shuffle(spark, tmp_dir, monkeypatch):
    awards = spark.createDataFrame([("u", "1", "short", "SIRET"), ("u", "1", "longer", "SIRET"), (None, "u", None, None)],
                                   schemas.STAGING_TITULAIRES.simpleString()[len("struct<"):-1])
    plan = _plan(contracts.titulaires_unique(awards))
    assert plan.index("md5") < plan.index("Exchange") and "md5" not in plan[plan.index("Exchange"):]
    assert {r["titulaire_name"] for r in contracts.titulaires_unique(awards).collect()} == {"longer", None}
    con, calls = _tables(spark, tmp_dir), []
    chosen = contracts.titulaires_unique
    monkeypatch.setattr(catalog.contracts, "titulaires_unique", lambda df: calls.append(1) or chosen(df))
    out = E.queries()["overwrite_table"](spark, tmp_dir)
    want = con.sql(E.oracle_sql()["overwrite_table"])
    assert sorted(map(tuple, out.select(*want.columns).collect()), key=str) == sorted(want.fetchall(), key=str)
    assert len(calls) == 1


def _document(path, value, indent=1):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    text = value if isinstance(value, str) else json.dumps(value, indent=indent)
    with (gzip.open if path.endswith(".gz") else open)(path, "wt") as f:
        f.write(text)


def test_small_documents_are_parsed_without_a_shuffle(spark, tmp_dir):
    odd = [{"uid": "a", "objet": 'brace } and "quote" ]', "titulaires": [{"id": "1"}, {"id": "2"}]}, {"uid": "b"}]
    _document(f"{tmp_dir}/d/a.json", {"note": "[[", "marches": odd, "nested": {"x": [1]}})
    _document(f"{tmp_dir}/d/b.json.gz", {"marches": [{"uid": "c", "montant": 1.5}]})
    for name, text in (("c", " \n"), ("d", {"marches": None}), ("e", {"other": 1}), ("f", {"marches": "[]"})):
        _document(f"{tmp_dir}/d/{name}.json", text)
    rows = read_contracts(spark, f"{tmp_dir}/d", multi_line=True)
    assert "Exchange" not in _plan(rows)
    got = {r["uid"]: r for r in rows.collect()}
    assert sorted(got) == ["a", "b", "c"] and got["a"]["objet"] == odd[0]["objet"] and got["c"]["montant"] == 1.5
    assert [t["id"] for t in got["a"]["titulaires"]] == ["1", "2"]


@pytest.mark.parametrize("text", ['{"marches": [{"uid": "a"}]}}', '{"marches": [{"uid": "a"}, null]}',
                                  '{"marches": [{"uid": "a}]}'])
def test_malformed_small_document_stops_the_load(spark, tmp_dir, text):
    _document(f"{tmp_dir}/d/a.json", text)
    with pytest.raises(Exception, match="malformed|no object"):
        read_contracts(spark, f"{tmp_dir}/d", multi_line=True).collect()
