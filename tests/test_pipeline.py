"""The whole pipeline on landed files, checked against the oracle SQL."""

from tenderlake.plans import landing
from tenderlake.plans.pipeline import Pipeline
from tenderlake.sinks.warehouse import Warehouse
from tests.conftest import SF_SMALL
from tests.oracle_compare import duck

import __spark_entry__ as E


def _multiset(rows):
    return sorted((tuple(r) for r in rows), key=str)


def test_pipeline_end_to_end(spark, tmp_dir):
    paths = landing.land_all(spark, SF_SMALL, f"{tmp_dir}/landing")
    pipe = Pipeline(spark, Warehouse(spark, f"{tmp_dir}/wh"))
    steps = pipe.run_all(paths["contracts"], paths["registry"], paths["statements"], paths["codes"],
                         statements_header=False)
    assert all(c["passed"] for s in steps for c in s.checks)
    con = duck(SF_SMALL)
    oracle = E.oracle_sql()
    for table, key, cols in [("fact_per_suppliername", "fact_per_suppliername", ["sirenname", "total_amount", "n_contract"]),
                             ("fact_per_ess", "fact_per_ess", ["ess", "total_amount", "n_contract"]),
                             ("contracts_year_month", "contracts_year_month", ["year", "year_month", "n_contracts"])]:
        got = pipe.wh.read("dwh", table)
        if "total_amount" in cols:
            from pyspark.sql import functions as F
            got = got.withColumn("total_amount", F.round("total_amount", 2))
        exp = con.sql(oracle[key]).fetchall()
        assert _multiset(got.select(*cols).collect()) == _multiset(exp), table
    for table, key in [("decp_titulaires", "titulaires_standardized"), ("siren_attributes", "siren_of_interest"),
                       ("infogreffe_attributes", "statements_of_interest"), ("cpv_attributes", "cpv_refresh")]:
        got = pipe.wh.read("dwh", table)
        exp_rel = con.sql(oracle[key])
        assert _multiset(got.select(*exp_rel.columns).collect()) == _multiset(exp_rel.fetchall()), table

    # properties: report totals agree with the per-company totals they come from
    from pyspark.sql import functions as F
    from tenderlake.operators import reports
    totals = reports.siren_totals(pipe.wh.read("dwh", "decp_marches"), pipe.wh.read("dwh", "decp_titulaires"))
    t = totals.agg(F.sum("total_amount").alias("a"), F.sum("n_contract").alias("n")).first()
    ess = pipe.wh.read("dwh", "fact_per_ess").agg(F.sum("total_amount").alias("a"),
                                                  F.sum("n_contract").alias("n")).first()
    assert ess["n"] == t["n"] and abs(ess["a"] - t["a"]) < 1e-6 * max(1.0, abs(t["a"]))
    used = {r[0] for r in pipe.wh.read("dwh", "decp_siren_used").collect()}
    assert {r[0] for r in totals.select("siren").collect()} <= used
    n_notified = pipe.wh.read("dwh", "decp_marches").where(F.col("datenotification").isNotNull()).count()
    assert pipe.wh.read("dwh", "contracts_year_month").agg(F.sum("n_contracts")).first()[0] <= n_notified

    # statements without a full key are counted before the de-dup and kept
    rejects = pipe.wh.read("rejects", "infogreffe_attributes")
    normal = con.sql("SELECT count(*) FROM (" + E.oracle_sql()["statements_normalized"] + ") WHERE infogreffe_uid IS NULL")
    load = next(x for x in steps if x.step == "load_statements")
    assert rejects.count() == load.notes["infogreffe_attributes_without_key"] \
        == load.upserts["infogreffe_attributes"].null_keys_rejected
    assert rejects.distinct().count() <= normal.fetchall()[0][0] <= rejects.count() > 1
    assert {k: v for k, v in steps[0].notes.items() if k.startswith("bad_")} == {
        "bad_amounts": 0, "bad_durations": 0, "bad_list_elements": 0}

    # reports are stored unsorted; report() gives the published order
    months = [r["year_month"] for r in pipe.report("contracts_year_month").collect()]
    assert months == sorted(months) and months
    amounts = [r["total_amount"] for r in pipe.report("fact_per_suppliername").collect()]
    assert amounts == sorted(amounts, key=lambda a: (a is not None, -(a or 0))) and amounts

    # a re-run of the same batch is idempotent and leaves one row per key
    before = pipe.wh.read("datalake", "decp_marches").count()
    again = pipe.load_contracts(paths["contracts"])
    assert pipe.wh.read("datalake", "decp_marches").count() == before
    assert again.upserts["decp_marches"].null_keys_rejected == 0
    assert len(pipe.wh.versions("datalake", "decp_marches")) == 2


def test_version_retention(spark, tmp_dir):
    codes = landing.land_codes(spark, SF_SMALL, f"{tmp_dir}/codes")
    pipe = Pipeline(spark, Warehouse(spark, f"{tmp_dir}/wh"), keep_versions=1)
    pipe.load_codes(codes)
    pipe.load_codes(codes)
    pipe.refresh_codes()
    assert pipe.wh.versions("datalake", "cpv_attributes") == [2]
    assert pipe.wh.read("datalake", "cpv_attributes").count() == pipe.wh.read("dwh", "cpv_attributes").count() > 0


def test_tolerant_load_counts_rejected_documents(spark, tmp_dir):
    import json
    import os
    os.makedirs(f"{tmp_dir}/docs")
    good = json.dumps({"marches": [{"uid": str(i), "montant": "x" if i == 1 else 5, "titulaires": [{"id": "9"}, 3]}
                                   for i in range(3)] + [{"objet": "no uid"}] * 5})
    with open(f"{tmp_dir}/docs/a.json", "w") as f:
        f.write(good + "\n" + good[:40] + "\n")
    pipe = Pipeline(spark, Warehouse(spark, f"{tmp_dir}/wh"))
    try:
        pipe.load_contracts(f"{tmp_dir}/docs")
        raise AssertionError("a truncated document must stop the load")
    except Exception as e:
        assert not isinstance(e, AssertionError)
    step = pipe.load_contracts(f"{tmp_dir}/docs", tolerant=True)
    assert step.notes == {"documents_rejected": 1, "bad_amounts": 1, "bad_durations": 0, "bad_list_elements": 3,
                          "decp_marches_without_key": 5}
    assert step.upserts["decp_marches"].null_keys_rejected == 5
    assert pipe.wh.read("datalake", "decp_marches").count() == 3
    assert pipe.wh.read("rejects", "decp_documents").count() == 1
