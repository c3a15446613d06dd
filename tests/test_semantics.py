"""Hand-written rows for each decision of the semantics ledger."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenderlake import schemas
from tenderlake.functions import blank_as_null, french_vat_number, lenient_date, strip_control, truncate_utf8, year_month
from tenderlake.operators import contracts, profile, quantiles, reports, statements
from tenderlake.sinks.warehouse import Warehouse, upsert_frame


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((x is not None, x if x is not None else "") for x in t))


def staging_marches(spark, data):
    base = {f.name: None for f in schemas.STAGING_MARCHES.fields}
    full = [tuple({**base, **d}[f.name] for f in schemas.STAGING_MARCHES.fields) for d in data]
    return spark.createDataFrame(full, schemas.STAGING_MARCHES)


def awards(spark, data):
    return spark.createDataFrame(data, schemas.STAGING_TITULAIRES)


def test_vat_number(spark):
    df = spark.createDataFrame([("732829320",), ("abc",), (None,)], "siren string")
    got = [r[0] for r in df.select(french_vat_number(F.col("siren"))).collect()]
    assert got == ["FR44732829320", None, None]


def test_latest_publication_null_first_then_newest(spark):
    df = staging_marches(spark, [
        {"decp_uid": "a", "objet": "x1", "datepublicationdonnees": "2020-01-01"},
        {"decp_uid": "a", "objet": "x2", "datepublicationdonnees": None},
        {"decp_uid": "b", "objet": "y1", "datepublicationdonnees": "2020-01-01"},
        {"decp_uid": "b", "objet": "y2", "datepublicationdonnees": "2021-01-01"},
        {"decp_uid": "c", "objet": "z2", "datepublicationdonnees": "2021-01-01"},
        {"decp_uid": "c", "objet": "z1", "datepublicationdonnees": "2021-01-01"},
    ])
    assert rows(contracts.marches_unique(df), "decp_uid", "objet") == [("a", "x2"), ("b", "y2"), ("c", "z1")]


def test_lenient_dates(spark):
    df = spark.createDataFrame([("2019-1-5",), ("2019-01-05T10:00:00",), ("2001-02-31",), ("junk",), (None,)], "t string")
    got = [r[0] for r in df.select(lenient_date(F.col("t"))).collect()]
    assert got == [dt.date(2019, 1, 5), dt.date(2019, 1, 5), None, None, None]


def test_year_month_not_zero_padded(spark):
    df = spark.createDataFrame([(dt.date(20, 3, 1),), (dt.date(2202, 3, 1),)], "d date")
    assert [r[0] for r in df.select(year_month(F.col("d"))).collect()] == ["20-03", "2202-03"]


def test_award_key_and_longest_name(spark):
    df = awards(spark, [("u", "1", "Short", "SIRET"), ("u", "1", "Much longer", "SIRET"),
                        ("u", None, None, None), ("u", "", "", "")])
    out = contracts.titulaires_unique(df)
    got = rows(out, "titulaire_id", "titulaire_name")
    # NULL parts read as '' so the last two rows share one key; the NULL name sorts first
    assert got == [(None, None), ("1", "Much longer")]


def test_identifier_cleaning_rules(spark):
    df = awards(spark, [
        ("u1", " 123 456.789-00012 ", "A", "SIRET"),   # cleaned to 14 digits
        ("u2", "123456789", "B", "siret"),              # lower-case type dropped
        ("u3", " 999999999 ", "C", "SIRET"),            # sentinel test runs on the raw id: kept
        ("u4", "999999999", "D", "SIRET"),              # sentinel dropped
        ("u5", "_^1", "E", "TVA"),                      # [A-z] admits _ and ^
        ("u6", "FR12", "F", "TVA_INTRA"),               # FR VAT with no digits: siren ''
        ("u7", "123456789\n", "G", "SIRET"),            # trailing newline is not a digit
        ("u8", "de123", "H", "TVA"),
    ])
    keyed = contracts.award_uid(df)
    out = contracts.dwh_titulaires(keyed)
    got = {r["decp_uid"]: (r["siren"], r["siret"], r["euvat"], r["titulaire_iso_country"]) for r in out.collect()}
    assert got["u1"] == ("123456789", "12345678900012", "FR" + f"{(12 + 3 * (123456789 % 97)) % 97:02d}" + "123456789", "FR")
    assert "u2" not in got and "u4" not in got and "u7" not in got
    assert got["u3"][0] == "999999999"
    assert got["u5"] == (None, None, "_^1", "_^")
    assert got["u6"] == ("", None, "FR12", "FR")
    assert got["u8"] == (None, None, "DE123", "DE")


def test_suspicious_flag_and_reports(spark):
    m = staging_marches(spark, [
        {"decp_uid": "a", "montant": 100.0, "datenotification": "2019-05-01"},
        {"decp_uid": "b", "montant": None, "datenotification": "2019-05-02"},
        {"decp_uid": "c", "montant": 99_000_000.0, "datenotification": "2022-01-01"},
        {"decp_uid": "d", "montant": 50.0, "datenotification": "2018-01-01"},
    ])
    dwh_m = contracts.marches_prepared(contracts.marches_unique(m))
    assert rows(dwh_m, "decp_uid", "suspicious_amount") == [("a", 0), ("b", 0), ("c", 1), ("d", 0)]
    t = spark.createDataFrame([("a", "111111111"), ("a", "222222222"), ("b", "111111111"), ("c", "111111111"),
                               ("d", "333333333")], "decp_uid string, siren string")
    totals = reports.siren_totals(dwh_m, t)
    # full amount for each winner; NULL and >= 99M amounts left out
    assert rows(totals, "siren", "total_amount", "n_contract") == [
        ("111111111", 100.0, 1), ("222222222", 100.0, 1), ("333333333", 50.0, 1)]
    names = spark.createDataFrame([("111111111", "", "O"), ("222222222", "", None)],
                                  "siren string, sirenname string, economieSocialeSolidaireUniteLegale string")
    # unnamed companies form one '' group; unmatched companies drop out
    assert rows(reports.fact_per_suppliername(totals, names), "sirenname", "total_amount", "n_contract") == [
        ("", 200.0, 2)]
    # NULL flag and registry misses share the NULL group
    ess = {r["ess"]: r["n_contract"] for r in reports.fact_per_ess(totals, names).collect()}
    assert ess == {"O": 1, None: 2}
    month = rows(reports.contracts_year_month(dwh_m, contracts.time_dimension(dwh_m)), "year_month", "n_contracts")
    assert month == [("2018-01", 1), ("2019-05", 2)]


def test_statement_null_key_group_keeps_one_row(spark):
    st = spark.createDataFrame(
        [("1", "2019", "2019-12-31", "12", "A", "1", "1", "1", "2018", None, "12", "B", "2", "2", "2"),
         ("2", "2019", "2019-12-31", None, "A", "1", "1", "1", "19", "2018-12-31", "12", "B", "2", "2", "2")],
        schemas.STAGING_STATEMENTS)
    out = statements.datalake_statements(st)
    null_keys = [r for r in out.collect() if r["infogreffe_uid"] is None]
    assert len(null_keys) == 1
    assert out.count() == 2  # one full key + one surviving NULL-key row; '19' year dropped


def test_upsert_semantics(spark, tmp_dir):
    target = spark.createDataFrame([("1", "old"), ("2", "old"), (None, "nullkey")], "k string, v string")
    batch = spark.createDataFrame([("2", "new"), ("2", "new"), ("3", "new"), (None, "x")], "k string, v string")
    once = upsert_frame(target, batch, "k")
    assert rows(once, "k", "v") == [(None, "nullkey"), ("1", "old"), ("2", "new"), ("3", "new")]
    twice = upsert_frame(once, batch, "k")
    assert sorted(map(tuple, twice.collect()), key=str) == sorted(map(tuple, once.collect()), key=str)
    wh = Warehouse(spark, tmp_dir)
    wh.overwrite(target, "datalake", "t")
    res = wh.upsert(batch, "datalake", "t", "k")
    assert (res.rows_in_batch, res.null_keys_rejected) == (4, 1)
    assert wh.versions("datalake", "t") == [1, 2]
    assert wh.read("datalake", "t").count() == 4
    wh.append(spark.createDataFrame([("z", "9")], "v string, k string"), "datalake", "t")
    assert ("9", "z") in rows(wh.read("datalake", "t"), "k", "v")


def test_strip_and_blank(spark):
    df = spark.createDataFrame([("a\tb\nc\\n",), ("  ",), ("",), (" x ",), (None,)], "t string")
    assert [r[0] for r in df.select(strip_control(F.col("t"))).collect()] == ["abc\\n", "  ", "", " x ", None]
    assert [r[0] for r in df.select(blank_as_null(F.col("t"))).collect()] == ["a\tb\nc\\n", None, None, " x ", None]


def test_truncate_matches_brute_force(spark):
    rnd = random.Random(7)
    alphabet = ["a", "é", "€", "😀", " "]
    vals = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12))) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    for w in (1, 2, 3, 4, 5, 8, 13):
        got = [r[0] for r in df.select(truncate_utf8(F.col("s"), w)).collect()]
        exp = []
        for v in vals:
            out = ""
            for ch in v:
                if len((out + ch).encode()) > w:
                    break
                out += ch
            exp.append(out)
        assert got == exp, w


QUANTILE_COLUMNS = {
    "mixed": lambda rnd: np.concatenate([rnd.normal(0, 100, 3000), np.full(1500, 42.0), rnd.integers(0, 5, 500)]),
    "constant": lambda rnd: np.full(2000, 7.0),
    "two values": lambda rnd: np.repeat([1.0, 9.0], [700, 1300]),
    "half zero": lambda rnd: np.concatenate([np.zeros(2000), rnd.normal(50, 9, 2000)]),
    "quarter zero": lambda rnd: np.concatenate([np.zeros(1000), rnd.normal(50, 9, 3000)]),
    "one row": lambda rnd: np.array([3.0]),
}


@pytest.mark.parametrize("shape", QUANTILE_COLUMNS)
def test_exact_quantiles_in_a_fixed_number_of_jobs(spark, shape):
    vals = QUANTILE_COLUMNS[shape](np.random.default_rng(3))
    df = spark.createDataFrame([(float(v),) for v in vals] + [(None,)], "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    tag = f"quantiles-{shape}"
    spark.sparkContext.addJobTag(tag)
    try:
        got = quantiles.exact_quantiles(df, "x", probs)
    finally:
        spark.sparkContext.removeJobTag(tag)
    assert np.allclose(got, np.quantile(vals, probs), rtol=0, atol=1e-9)
    jobs = spark.sparkContext._jsc.sc().statusTracker().getJobIdsForTag(tag)
    assert 0 < len(jobs) <= 12


def test_many_columns_take_as_many_jobs_as_one(spark):
    rnd = np.random.default_rng(4)
    vals = {shape: np.resize(make(rnd), 5000) for shape, make in QUANTILE_COLUMNS.items()}
    vals["whole numbers"] = rnd.integers(-9, 9, 5000)
    names = {f"c{i}": v for i, v in enumerate(vals.values())}
    df = spark.createDataFrame([tuple(None if r % 7 == i else v[r].item() for i, v in enumerate(names.values()))
                                for r in range(5000)],
                               ", ".join(f"{c} {'long' if v.dtype.kind == 'i' else 'double'}" for c, v in names.items()))
    df = df.withColumn("empty", F.lit(None).cast("double"))
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    jobs = {}
    for tag, columns in (("one", ["c0"]), ("all", [*names, "empty"])):
        spark.sparkContext.addJobTag(tag)
        try:
            got = quantiles.column_quantiles(df, columns, probs)
        finally:
            spark.sparkContext.removeJobTag(tag)
        jobs[tag] = len(spark.sparkContext._jsc.sc().statusTracker().getJobIdsForTag(tag))
    for i, v in enumerate(names.values()):
        assert np.allclose(got[i], np.quantile(np.delete(v, np.s_[i::7]), probs), rtol=0, atol=1e-9)
    assert got[-1] == [None] * len(probs)
    assert 0 < jobs["all"] <= jobs["one"] + 2  # adaptive execution may split off a job, columns add none


def test_profiles_of_many_columns(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 2.0, None), (3, 3.0, None), (4, 400.0, None), (None, None, None)],
                               "a long, b double, c int")
    got = {r["column_name"]: r for r in profile.numeric_summaries(df, ["b", "a", "c"]).collect()}
    assert list(got) == ["b", "a", "c"]
    assert got["a"][1:] == profile.numeric_summary(df, "a").first()[:]
    assert (got["a"]["n"], got["a"]["p50"], got["b"]["max"]) == (4, 2.5, 400.0)
    assert got["c"]["n"] == 0 and got["c"]["p50"] is None
    boxes = {r["column_name"]: r for r in profile.box_stats_of(df, ["a", "c", "b"]).collect()}
    assert set(boxes) == {"a", "b"}
    assert boxes["b"]["n_outliers"] == 1 and boxes["b"]["upper_whisker"] == 3.0 and boxes["a"]["n_outliers"] == 0
    assert profile.box_stats_of(df, ["c"]).collect() == [] and profile.box_stats(df, "c").collect() == []
    empty = df.limit(0)
    assert profile.numeric_summaries(empty, ["a", "b"]).select("n", "mean", "p25").collect() == [(0, None, None)] * 2
    dates = spark.createDataFrame([("2020-01-01", None), ("2020-01-04", None)], "d string, e string").selectExpr(
        "to_date(d) AS d", "to_date(e) AS e")
    d, e = profile.date_summaries(dates, ["d", "e"]).collect()
    assert str(d["p50"]) == "2020-01-02" and str(d["max"]) == "2020-01-04" and e["n"] == 0 and e["p50"] is None


def test_no_values_no_quantiles(spark):
    assert quantiles.exact_quantiles(spark.createDataFrame([(None,)], "x double"), "x", [0.5]) == [None]


def test_box_and_summary_on_small_frame(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100]] + [(None,)], "x double")
    b = profile.box_stats(df, "x").first()
    assert (b["q1"], b["median"], b["q3"], b["upper_whisker"], b["n_outliers"]) == (2.0, 3.0, 4.0, 4.0, 1)
    s = profile.numeric_summary(df, "x").first()
    assert s["n"] == 5 and s["p50"] == 3.0 and s["max"] == 100.0


def test_decade_histogram_tolerates_bad_dates(spark):
    df = spark.createDataFrame([("1895-06-01",), ("2021-01-01",), ("junk",), (None,)], "dateDebut string")
    got = [tuple(r) for r in profile.decade_histogram(df, "dateDebut").collect()]
    assert got == [(None, 2), (1890, 1), (2020, 1)]


def test_failed_write_leaves_previous_version(spark, tmp_dir):
    wh = Warehouse(spark, tmp_dir)
    wh.overwrite(spark.createDataFrame([("1",)], "k string"), "dwh", "t")
    # a job that died after writing, and one that died while writing an append
    wh.stage(spark.createDataFrame([("junk",)], "k string"), "dwh", "t")
    wh.stage_append(spark.createDataFrame([("more",)], "k string"), "dwh", "t")
    broken = spark.range(3).select(F.raise_error(F.lit("lost")).cast("string").alias("k"))
    for write in (wh.append, wh.overwrite, lambda df, *t: wh.upsert(df, *t, "k")):
        with pytest.raises(Exception, match="lost"):
            write(broken, "dwh", "t")
    assert wh.versions("dwh", "t") == [1] and [r.k for r in wh.read("dwh", "t").collect()] == ["1"]
    v = wh.overwrite(spark.createDataFrame([("2",)], "k string"), "dwh", "t")
    assert v == 2 and [r.k for r in wh.read("dwh", "t").collect()] == ["2"]
    # vacuum also removes what never became a version
    assert wh.vacuum("dwh", "t", keep=1) == [1]
    assert len(wh._names(f"{tmp_dir}/dwh/t/data")) == 1 and wh.read("dwh", "t").count() == 1


def test_versions_do_not_need_success_markers(spark, tmp_dir):
    wh = Warehouse(spark, tmp_dir)
    marker = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set(marker, "false")
    try:
        wh.overwrite(spark.createDataFrame([("1",)], "k string"), "dwh", "t", key="k")
        wh.append(spark.createDataFrame([("2",)], "k string"), "dwh", "t")
    finally:
        conf.unset(marker)
    assert sorted(r.k for r in wh.read("dwh", "t").collect()) == ["1", "2"]


def _files(wh, layer, table):
    m = wh._manifest(layer, table, wh.current(layer, table))
    return {bucket: folder for bucket, folder in m.parts}


def test_upsert_rewrites_touched_buckets_only(spark, tmp_dir):
    wh = Warehouse(spark, tmp_dir, buckets=16)
    old = [(str(i), "old") for i in range(400)] + [(None, "null key")]
    wh.overwrite(spark.createDataFrame(old, "k string, v string"), "datalake", "t", key="k")
    before = _files(wh, "datalake", "t")
    res = wh.upsert(spark.createDataFrame([("7", "new"), ("new", "new"), (None, "x")], "k string, v string"),
                    "datalake", "t", "k")
    after = _files(wh, "datalake", "t")
    moved = {b for b in after if after[b] != before.get(b)}
    assert 1 <= len(moved) <= 2 == res.buckets_rewritten or len(moved) == res.buckets_rewritten == 1
    assert -1 not in moved and res.null_keys_rejected == 1
    got = dict(wh.read("datalake", "t").collect())
    assert len(got) == 402 and got["7"] == got["new"] == "new" and got[None] == "null key" and got["8"] == "old"
    # appended rows land in their buckets, so a later upsert finds them
    wh.append(spark.createDataFrame([("x", "app")], "v string, k string"), "datalake", "t")
    wh.upsert(spark.createDataFrame([("app", "y")], "k string, v string"), "datalake", "t", "k")
    assert [r.v for r in wh.read("datalake", "t").where("k = 'app'").collect()] == ["y"]


def test_failed_check_leaves_the_old_version_current(spark, tmp_dir):
    from tenderlake.operators.quality import QualityError
    from tenderlake.plans.pipeline import Pipeline
    wh = Warehouse(spark, tmp_dir)
    codes = spark.createDataFrame([("1", "a")], schemas.CPV)
    wh.overwrite(codes, "datalake", "cpv_attributes")
    pipe = Pipeline(spark, wh)
    pipe.refresh_codes()
    wh.overwrite(codes.unionByName(codes), "datalake", "cpv_attributes")
    with pytest.raises(QualityError):
        pipe.refresh_codes()
    assert wh.versions("dwh", "cpv_attributes") == [1] and wh.read("dwh", "cpv_attributes").count() == 1


def test_target_schemas_are_enforced(spark):
    df = spark.createDataFrame([(1, "d")], "codecpv int, description string")
    assert schemas.conform(df, schemas.CPV).schema == schemas.CPV
    with pytest.raises(ValueError):
        schemas.conform(df.withColumn("more", F.lit(1)), schemas.CPV)


def test_registry_refresh_counts_non_numeric_siren(spark, tmp_dir):
    from tenderlake.plans.pipeline import Pipeline
    wh = Warehouse(spark, tmp_dir)
    reg = spark.createDataFrame([tuple([s] + [None] * (len(schemas.REGISTRY_COLUMNS) - 1)) for s in ("123456789", "12A")],
                                schemas.REGISTRY)
    wh.overwrite(reg, "datalake", "siren_attributes")
    wh.overwrite(spark.createDataFrame([("123456789",), ("12A",)], "siren string"), "dwh", "decp_siren_used")
    step = Pipeline(spark, wh).refresh_registry()
    assert step.notes["siren_without_vat"] == 1
    got = {r.siren: r.euvat for r in wh.read("dwh", "siren_attributes").collect()}
    assert got["12A"] is None and got["123456789"].startswith("FR")


@pytest.mark.parametrize("keyed", [False, True])
def test_two_appends_from_one_version_keep_all_rows(spark, tmp_dir, keyed):
    wh = Warehouse(spark, tmp_dir)
    wh.overwrite(spark.createDataFrame([("a",)], "k string"), "dwh", "t", key="k" if keyed else None)
    one = wh.stage_append(spark.createDataFrame([("b",)], "k string"), "dwh", "t")
    two = wh.stage_append(spark.createDataFrame([("c",)], "k string"), "dwh", "t")
    assert [wh.publish(one), wh.publish(two)] == [2, 3]
    assert sorted(r.k for r in wh.read("dwh", "t").collect()) == ["a", "b", "c"]


def test_upserts_from_one_version(spark, tmp_dir):
    from tenderlake.sinks.warehouse import StaleWrite, bucket_of
    wh = Warehouse(spark, tmp_dir, buckets=8)
    frame = lambda *rows: spark.createDataFrame(list(rows), "k string, v string")
    wh.overwrite(frame(*[(str(i), "old") for i in range(40)]), "datalake", "t", key="k")
    place = {r.k: r.b for r in wh.read("datalake", "t").select("k", bucket_of("k", 8).alias("b")).collect()}
    other = next(k for k in place if place[k] != place["0"])
    same = next(k for k in place if place[k] == place["0"] and k != "0")
    one = wh.stage_upsert(frame(("0", "one")), "datalake", "t", "k")
    two = wh.stage_upsert(frame((other, "two")), "datalake", "t", "k")
    late = wh.stage_upsert(frame((same, "late")), "datalake", "t", "k")
    whole = wh.stage(frame(("x", "x")), "datalake", "t", "k")
    assert [wh.publish(one), wh.publish(two)] == [2, 3]          # other buckets: merged
    for stale in (late, whole):
        with pytest.raises(StaleWrite):
            wh.publish(stale)
    wh.upsert(frame((same, "late")), "datalake", "t", "k")       # staged anew
    got = dict(wh.read("datalake", "t").collect())
    assert len(got) == 40 and (got["0"], got[other], got[same]) == ("one", "two", "late")
    assert sum(v == "old" for v in got.values()) == 37


def test_a_faster_writer_makes_upsert_and_append_merge_anew(spark, tmp_dir, monkeypatch):
    wh, rival = Warehouse(spark, tmp_dir, buckets=1), Warehouse(spark, tmp_dir, buckets=1)
    frame = lambda *rows: spark.createDataFrame(list(rows), "k string, v string")
    wh.overwrite(frame(("a", "0")), "datalake", "t", key="k")
    published, faster = wh.publish, [frame(("b", "rival")), frame(("c", "rival"))]

    def publish(staged):
        if faster:
            rival.upsert(faster.pop(), "datalake", "t", "k")
        return published(staged)

    monkeypatch.setattr(wh, "publish", publish)
    wh.upsert(frame(("a", "1"), ("b", "mine")), "datalake", "t", "k")
    assert dict(wh.read("datalake", "t").collect()) == {"a": "1", "b": "mine", "c": "rival"}
    faster.append(frame(("d", "rival")))
    wh.append(frame(("e", "mine")), "datalake", "t")
    assert sorted(r.k for r in wh.read("datalake", "t").collect()) == list("abcde")
    assert wh.versions("datalake", "t") == list(range(1, wh.current("datalake", "t") + 1))


def test_buckets_split_as_upserts_grow_a_table(spark, tmp_dir):
    from tenderlake.sinks.warehouse import StaleWrite
    wh = Warehouse(spark, tmp_dir, buckets=2, bucket_bytes=3000)
    frame = lambda a, b, v: spark.range(a, b).select(F.md5(F.col("id").cast("string")).alias("k"), F.lit(v).alias("v"))
    wh.overwrite(frame(0, 50, "old").unionByName(spark.createDataFrame([(None, "null key")], "k string, v string")),
                 "datalake", "t", key="k")
    early = wh.stage_upsert(frame(0, 1, "early"), "datalake", "t", "k")
    for start in range(0, 1000, 250):
        wh.upsert(frame(start, start + 250, "new"), "datalake", "t", "k")
    manifest = wh._manifest("datalake", "t", wh.current("datalake", "t"))
    assert manifest.buckets >= 8 and manifest.buckets & (manifest.buckets - 1) == 0
    assert len(manifest.parts) == manifest.buckets + 1
    with pytest.raises(StaleWrite):  # staged for the buckets of before
        wh.publish(early)
    got = wh.read("datalake", "t")
    assert got.count() == 1001 == got.select("k").distinct().count()
    assert {(r.v, r["count"]) for r in got.groupBy("v").count().collect()} == {("new", 1000), ("null key", 1)}
    # settled: one key rewrites one bucket of bounded size and leaves the others
    wh.bucket_bytes = 1 << 20
    before = _files(wh, "datalake", "t")
    assert wh.upsert(frame(7, 8, "last"), "datalake", "t", "k").buckets_rewritten == 1
    after = _files(wh, "datalake", "t")
    assert sum(after[b] != before[b] for b in after) == 1 and wh.read("datalake", "t").where("v = 'last'").count() == 1


def test_rebucket_keeps_rows_and_spreads_them(spark, tmp_dir):
    wh = Warehouse(spark, tmp_dir, buckets=2)
    rows = [(str(i),) for i in range(100)] + [(None,)]
    wh.overwrite(spark.createDataFrame(rows, "k string"), "datalake", "t", key="k")
    wh.rebucket("datalake", "t", 8)
    assert len(_files(wh, "datalake", "t")) == 9 and wh.read("datalake", "t").count() == 101
    res = wh.upsert(spark.createDataFrame([("7",)], "k string"), "datalake", "t", "k")
    assert res.buckets_rewritten == 1 and wh.read("datalake", "t").count() == 101
