"""Physical-plan shape: the plans we want at scale, not just right answers."""

import pytest

from tenderlake.operators import contracts, profile, reports, statements
from tenderlake.plans.catalog import QUERIES as CATALOG
from tenderlake.plans.fixtures import fixture
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_dedup_limits_rows_before_shuffle(spark):
    p = plan(contracts.marches_unique(fixture(spark, SF_SMALL, "fx_marches")))
    assert "WindowGroupLimit" in p


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_no_python_udf_anywhere(spark, name):
    p = plan(CATALOG[name](spark, SF_SMALL))
    assert "Python" not in p and "InPandas" not in p and "InArrow" not in p


def test_unpivot_scans_once(spark, tmp_dir):
    fixture(spark, SF_SMALL, "fx_infogreffe").write.parquet(f"{tmp_dir}/st")
    df = statements.statements_unpivot(spark.read.parquet(f"{tmp_dir}/st"))
    assert optimized(df).count("] parquet") == 1
    assert "Generate inline" in plan(df)


def test_reports_aggregate_before_dimension_join(spark):
    m = contracts.marches_prepared(contracts.marches_unique(fixture(spark, SF_SMALL, "fx_marches")))
    t = contracts.dwh_titulaires(contracts.titulaires_unique(fixture(spark, SF_SMALL, "fx_titulaires")))
    names = spark.createDataFrame([("1", "x")], "siren string, sirenname string")
    opt = optimized(reports.fact_per_suppliername(reports.siren_totals(m, t), names))
    # the per-siren aggregate sits below the join with the company names
    join_at = opt.index("Join Inner")
    assert "Aggregate [siren" in opt[join_at:]


def _formatted(spark, df) -> str:
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_date_windows_of_profiles_reach_the_scan(spark, tmp_dir):
    m = contracts.marches_prepared(contracts.marches_unique(fixture(spark, SF_SMALL, "fx_marches")))
    m.write.parquet(f"{tmp_dir}/m")
    m = spark.read.parquet(f"{tmp_dir}/m")
    assert "GreaterThanOrEqual(datenotification,2022-01-01)" in _formatted(
        spark, profile.future_dates(m, "datenotification", 2021))
    p = _formatted(spark, profile.monthly_histogram(m, "datenotification", 2018, 2021))
    assert "GreaterThanOrEqual(datenotification,2018-01-01), LessThan(datenotification,2022-01-01)" in p
    assert "ReadSchema: struct<datenotification:date>" in p


def test_statement_chain_shuffles_once(spark):
    df = statements.datalake_statements(fixture(spark, SF_SMALL, "fx_infogreffe"))
    assert plan(df).count("Exchange hashpartitioning") == 1


def test_no_nested_loop_in_the_fixtures(spark):
    for name in ("fx_infogreffe", "fx_siren", "fx_marches", "fx_titulaires"):
        p = plan(fixture(spark, SF_SMALL, name))
        assert "NestedLoop" not in p and "Cartesian" not in p


def test_monthly_report_year_window_reaches_the_scan(spark, tmp_dir):
    m = contracts.marches_prepared(contracts.marches_unique(fixture(spark, SF_SMALL, "fx_marches")))
    m.write.parquet(f"{tmp_dir}/m")
    m = spark.read.parquet(f"{tmp_dir}/m")
    df = reports.contracts_year_month(m, contracts.time_dimension(m))
    p = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(datenotification,2018-01-01), LessThan(datenotification,2022-01-01)" in p


def test_calendar_scans_contracts_once(spark, tmp_dir):
    m = contracts.marches_prepared(contracts.marches_unique(fixture(spark, SF_SMALL, "fx_marches")))
    m.write.parquet(f"{tmp_dir}/m")
    df = contracts.time_dimension(spark.read.parquet(f"{tmp_dir}/m"))
    assert optimized(df).count("] parquet") == 1
    assert "Generate explode" in plan(df)
