"""The fixed-size filter never drops a partner, and the early filter of statements changes no result."""

import random

import pytest
from pyspark.sql import functions as F

from tenderlake import schemas
from tenderlake.operators import statements
from tenderlake.operators.prefilter import hash_bits, may_hold

WIDE, FULL = 1 << 18, 1


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shown(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("words", [WIDE, 64, FULL])
def test_filter_keeps_every_partner(spark, words):
    rows = spark.range(20_000).withColumn("k", F.when(F.col("id") % 5 > 0, F.col("id").cast("string")))
    keys = rows.where("id % 50 = 0").select("k").union(spark.createDataFrame([("99",), (None,)], "k string"))
    bits = hash_bits(keys, F.col("k"), words)
    assert bits.count() <= words
    kept = may_hold(rows, F.col("k"), bits, words)
    assert kept.columns == rows.columns and "Exchange hashpartitioning(_word" not in plan(kept)
    got = {r["id"] for r in kept.collect()}
    wanted = {r["id"] for r in rows.collect() if r["k"] is None or r["k"] == "99"}
    assert wanted <= got
    assert len(got) < len(wanted) + 100 if words == WIDE else True
    # rows of one key stay or go together
    per_key = kept.groupBy("k").count().join(rows.groupBy("k").agg(F.count("*").alias("n")), "k")
    assert per_key.where("count != n").count() == 0


def test_filter_of_empty_tables(spark):
    rows = spark.range(10).withColumn("k", F.col("id").cast("string"))
    assert may_hold(rows, F.col("k"), hash_bits(rows.limit(0), F.col("k"))).count() == 0
    assert may_hold(rows.limit(0), F.col("k"), hash_bits(rows, F.col("k"))).count() == 0


def statement_rows(spark, n=3000):
    """Company numbers and years whose joined texts coincide (A1 + 2015, A + 12015), missing parts included."""
    rnd = random.Random(5)
    sirens = ["A", "A1", "A12", "B", "B1", None, "", "1", "12"]
    years = [2015, 12015, 212015, 15, 2015, None, -15]
    days = [None, "2015-12-31", "2015-06-30"]
    data = [(f"u{i % 900}", rnd.choice(sirens), rnd.choice(years), rnd.choice(days), rnd.choice([12, 12, 12, 6, None]),
             rnd.choice(["x", None]), float(i), None, 1.0) for i in range(n)]
    df = spark.createDataFrame(data, "infogreffe_uid string, siren string, millesime int, d string, duree int,"
                                     " tranche_ca_millesime string, ca double, resultat double, effectif double")
    return df.select(*[F.to_date("d").alias(f.name) if f.name == "date_de_cloture" else F.col(f.name)
                       for f in schemas.DATALAKE_STATEMENTS.fields])


@pytest.mark.parametrize("used", [["A"], ["A1", "B"], ["", "1"], [], ["A", "A1", "A12", "B", "B1", "", "1", "12"]])
def test_early_filter_changes_no_statement(spark, used):
    filed = statement_rows(spark).cache()
    companies = spark.createDataFrame([(s,) for s in used], "siren string")
    late = statements.statements_of_interest(statements.dwh_statements(filed), companies)
    assert shown(statements.dwh_statements_of_interest(filed, companies)) == shown(late)
    near = statements.near_interest(filed, companies, FULL)
    assert shown(statements.statements_of_interest(statements.dwh_statements(near), companies)) == shown(late)


def test_group_shared_by_two_companies_is_kept_whole(spark):
    cols = "infogreffe_uid string, siren string, millesime int, d string, duree int"
    filed = spark.createDataFrame([("u1", "A1", 2015, "2015-06-30", 12), ("u2", "A", 12015, "2015-12-31", 12),
                                   ("u3", "C", 2015, "2015-12-31", 12)], cols)
    near = statements.near_interest(filed, spark.createDataFrame([("A1",)], "siren string"))
    # the later closing of the other company wins the group, so nothing of A1 stays in the end
    assert {r["infogreffe_uid"] for r in near.collect()} == {"u1", "u2"}


def test_fewer_rows_reach_the_choice_per_group(spark, tmp_dir):
    n = 50_000
    filed = spark.range(n).selectExpr(
        "CAST(id AS STRING) infogreffe_uid", "lpad(CAST(id AS STRING), 9, '0') siren", "2015 millesime",
        "DATE '2015-12-31' date_de_cloture", "12 duree", "CAST(NULL AS STRING) tranche_ca_millesime",
        "1.0D ca", "1.0D resultat", "1.0D effectif")
    filed.write.parquet(f"{tmp_dir}/filed")
    filed = spark.read.parquet(f"{tmp_dir}/filed")
    used = filed.where("CAST(siren AS INT) % 100 = 0").select("siren")
    near = statements.near_interest(filed, used)
    assert n // 100 <= near.count() < n // 50
    p = plan(statements.dwh_statements_of_interest(filed, used))
    window, filtered = p.index("WindowGroupLimit"), p.index("BroadcastHashJoin", p.index("WindowGroupLimit"))
    assert window < filtered  # the filter lies below the choice and its shuffle
