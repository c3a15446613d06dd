"""File-stream ingestion: each run picks up only newly landed documents."""

import json
import os

from tenderlake.sinks.warehouse import Warehouse
from tenderlake.streaming import ingest_contracts


def _doc(path, contracts):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(json.dumps({"marches": contracts}) + "\n")


def _run(spark, landing, wh, ckpt, files=None):
    q = ingest_contracts(spark, landing, wh, ckpt, max_files_per_trigger=files)
    finished = q.awaitTermination(180)
    if not finished:
        q.stop()
    assert finished and q.exception() is None


def test_incremental_runs(spark, tmp_dir):
    landing, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/ckpt"
    wh = Warehouse(spark, f"{tmp_dir}/wh")
    _doc(f"{landing}/a.json", [
        {"uid": "1", "objet": "first", "datePublicationDonnees": "2020-01-01",
         "titulaires": [{"id": "123456789", "denominationSociale": "A", "typeIdentifiant": "SIRET"}]},
        {"uid": "2", "objet": "second", "datePublicationDonnees": "2020-01-01"}])
    _run(spark, landing, wh, ckpt)
    assert wh.read("datalake", "decp_marches").count() == 2
    v1 = wh.versions("datalake", "decp_marches")
    _run(spark, landing, wh, ckpt)          # nothing new: no new version
    assert wh.versions("datalake", "decp_marches") == v1
    _doc(f"{landing}/b.json", [{"uid": "2", "objet": "second v2", "datePublicationDonnees": "2020-02-01"},
                               {"uid": "3", "objet": "third"}])
    _run(spark, landing, wh, ckpt)
    got = {r["decp_uid"]: r["objet"] for r in wh.read("datalake", "decp_marches").collect()}
    assert got == {"1": "first", "2": "second v2", "3": "third"}
    assert wh.read("datalake", "decp_titulaires").count() == 1


def test_older_publication_in_a_later_batch_changes_nothing(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    award = {"id": "123456789", "typeIdentifiant": "SIRET"}
    for i, (day, name) in enumerate([("2020-01-01", "MID"), ("2021-01-01", "NEWEST"), ("2019-01-01", "OLD")]):
        _doc(f"{landing}/{i}.json", [
            {"uid": "1", "objet": name, "datePublicationDonnees": day,
             "titulaires": [{**award, "denominationSociale": name}]},
            {"uid": None, "objet": "no key"}])
        os.utime(f"{landing}/{i}.json", (1_600_000_000 + i, 1_600_000_000 + i))
    got = []
    for files in (None, 1):
        wh = Warehouse(spark, f"{tmp_dir}/wh{files}")
        _run(spark, landing, wh, f"{tmp_dir}/ckpt{files}", files)
        got.append([sorted(map(tuple, wh.read("datalake", t).collect()), key=str)
                    for t in ("decp_marches", "decp_titulaires")])
    assert got[0] == got[1]
    assert [r[6] for r in got[0][0]] == ["NEWEST"] and [r[3] for r in got[0][1]] == ["NEWEST"]


def _rows(wh, table, *columns):
    return sorted(map(tuple, wh.read("datalake", table).select(*columns).collect()), key=str)


def test_any_mix_of_batch_and_stream_gives_the_newest_row(spark, tmp_dir):
    from tenderlake.operators.contracts import MARCHES_COLUMNS
    from tenderlake.plans.pipeline import Pipeline
    award = {"id": "123456789", "typeIdentifiant": "SIRET"}
    docs = {}
    for day, name in [("2021-01-01", "NEW"), ("2019-01-01", "OLD SUPPLIER"), ("2020-01-01", "MID")]:
        docs[name] = [{"uid": "1", "objet": name, "datePublicationDonnees": day,
                       "titulaires": [{**award, "denominationSociale": name}]}]
        _doc(f"{tmp_dir}/{name}/a.json", docs[name])
    got = set()
    for k, order in enumerate([("bNEW", "sOLD SUPPLIER"), ("sNEW", "bOLD SUPPLIER"), ("bOLD SUPPLIER", "sMID", "bNEW"),
                               ("sOLD SUPPLIER", "bNEW", "bMID")]):
        wh = Warehouse(spark, f"{tmp_dir}/wh{k}")
        for step in order:
            if step[0] == "b":
                Pipeline(spark, wh).load_contracts(f"{tmp_dir}/{step[1:]}")
            else:
                _run(spark, f"{tmp_dir}/{step[1:]}", wh, f"{tmp_dir}/ck{k}{step}")
        got.add(str(_rows(wh, "decp_marches", *MARCHES_COLUMNS)))
        assert [r[0] for r in _rows(wh, "decp_titulaires", "titulaire_name")] == ["OLD SUPPLIER"]
        Pipeline(spark, wh).refresh_contracts()
        assert [r.objet for r in wh.read("dwh", "decp_marches").collect()] == ["NEW"]
    assert len(got) == 1 and "NEW" in got.pop()


def test_rejects_of_micro_batches_survive_replay(spark, tmp_dir):
    from tenderlake.plans.pipeline import Pipeline
    landing = f"{tmp_dir}/landing"
    for i in range(2):
        _doc(f"{landing}/{i}.json", [
            {"uid": str(i), "montant": "n/a", "dureeMois": "3", "titulaires": [{"id": "1"}, 7]},
            {"uid": " ", "objet": f"no key {i}"}, {"objet": f"no key {i}"}])
        os.utime(f"{landing}/{i}.json", (1_600_000_000 + i, 1_600_000_000 + i))
    wh = Warehouse(spark, f"{tmp_dir}/wh")
    _run(spark, landing, wh, f"{tmp_dir}/ckpt", 1)

    def state():
        return {t: sorted((str(r.asDict()) for r in wh.read("rejects", t).collect()))
                for t in ("decp_marches", "decp_values", "loads")}

    first = state()
    assert len(first["decp_marches"]) == 4 and len(first["decp_values"]) == 4
    metrics = {(r.load_id, r.metric): r.value for r in wh.read("rejects", "loads").collect()}
    for k in range(2):
        assert {m: metrics[f"stream-{k}", m] for m in ("bad_amounts", "bad_list_elements", "decp_marches_without_key",
                                                       "contracts_landed")} == {
            "bad_amounts": 1, "bad_list_elements": 1, "decp_marches_without_key": 2, "contracts_landed": 3}
    # a fresh checkpoint replays both batches under their ids
    _run(spark, landing, wh, f"{tmp_dir}/ckpt2", 1)
    assert state() == first and wh.read("datalake", "decp_marches").count() == 2
    # a batch load adds its own rejects and leaves the others
    step = Pipeline(spark, wh).load_contracts(landing)
    assert step.notes["decp_marches_without_key"] == 4
    assert wh.read("rejects", "decp_marches").count() == 8
    values = wh.read("rejects", "decp_values").where(f"load_id = '{step.load_id}'").collect()
    assert sorted((r.uid, r.field, r.value) for r in values) == [
        ("0", "montant", "n/a"), ("0", "titulaires", "7"), ("1", "montant", "n/a"), ("1", "titulaires", "7")]


def test_a_batch_leaves_no_scratch_and_few_versions(spark, tmp_dir):
    from tenderlake.session import _scratch_root, hadoop_path
    landing = f"{tmp_dir}/landing"
    for i in range(3):
        _doc(f"{landing}/{i}.json", [{"uid": str(i)}])
    fs, root = hadoop_path(spark, _scratch_root(spark))
    names = lambda: {s.getPath().getName() for s in fs.listStatus(root)} if fs.exists(root) else set()
    before = names()
    wh = Warehouse(spark, f"{tmp_dir}/wh")
    q = ingest_contracts(spark, landing, wh, f"{tmp_dir}/ckpt", 1, keep_versions=1)
    assert q.awaitTermination(180) and q.exception() is None
    assert not names() - before
    assert len(wh.versions("datalake", "decp_marches")) == 1 and wh.read("datalake", "decp_marches").count() == 3


def _tables(wh):
    return {t: sorted(map(tuple, wh.read("datalake", t).collect()), key=str) for t in ("decp_marches", "decp_titulaires")}


def test_batches_are_written_once_and_settled_once(spark, tmp_dir):
    """Before, every batch rewrote the buckets it touched: 3.5 times the rows in 6 batches."""
    from tenderlake.plans.pipeline import Pipeline
    n, landing = 100, f"{tmp_dir}/landing"
    for i in range(6):
        _doc(f"{landing}/{i}.json", [
            {"uid": f"{i}-{k}", "objet": f"o{k}", "datePublicationDonnees": "2020-01-01",
             "titulaires": [{"id": f"{k}", "denominationSociale": "A" * (k % 3), "typeIdentifiant": "SIRET"}]}
            for k in range(n)] + [{"uid": "all", "objet": f"all {i}", "datePublicationDonnees": f"202{i}-01-01",
                                   "titulaires": [{"id": "1", "denominationSociale": "B" * (i + 1)}]}])
    wh = Warehouse(spark, f"{tmp_dir}/wh")
    _run(spark, landing, wh, f"{tmp_dir}/ckpt", 1)
    before = _tables(wh)
    Pipeline(spark, wh).settle_contracts()
    for table in before:
        written = (spark.read.option("recursiveFileLookup", True)
                   .parquet(f"{wh.location('datalake', table)}/data").count())
        assert written == 6 * (n + 1) + 6 * n + 1
        last = wh._manifest("datalake", table, wh.current("datalake", table))
        assert not last.pending and {bucket for bucket, _ in last.parts} <= set(range(last.buckets))
    assert _tables(wh) == before and [len(rows) for rows in before.values()] == [6 * n + 1] * 2
    assert {r[6] for r in before["decp_marches"] if r[0] == "all"} == {"all 5"}
    assert {r[3] for r in before["decp_titulaires"] if r[1] == "all"} == {"B" * 6}
    assert wh.settle("datalake", "decp_marches") is None  # nothing pending: no new version
    assert wh.vacuum("datalake", "decp_marches", keep=1) and _tables(wh) == before


def test_awards_of_one_key_under_two_contracts_meet(spark, tmp_dir):
    """uid, type and identifier are joined without a separator: the key of ("u", "1", "23") is that of ("u1", null, "23")."""
    from tenderlake.plans.pipeline import Pipeline
    _doc(f"{tmp_dir}/l/0.json", [{"uid": "u", "titulaires": [{"id": "23", "typeIdentifiant": "1", "denominationSociale": "long"}]}])
    _doc(f"{tmp_dir}/l/1.json", [{"uid": "u1", "titulaires": [{"id": "23", "denominationSociale": "longer"}]},
                                 {"uid": None, "titulaires": [{"id": "u123", "denominationSociale": "x"}]}])
    wh = Warehouse(spark, f"{tmp_dir}/wh")
    _run(spark, f"{tmp_dir}/l", wh, f"{tmp_dir}/ckpt", 1)
    rows = _tables(wh)["decp_titulaires"]
    assert [r[1:4] for r in rows] == [("u1", "23", "longer")]
    Pipeline(spark, wh).settle_contracts()
    assert _tables(wh)["decp_titulaires"] == rows


def _newest(df, *within):
    from pyspark.sql import functions as F
    from tenderlake.operators.dedup import latest_per_key
    return latest_per_key(df, [*within, "k"], [F.col("v").desc()])


def test_pending_batches_among_other_writes(spark, tmp_dir, monkeypatch):
    from tenderlake.sinks import warehouse
    wh = Warehouse(spark, tmp_dir, buckets=2, bucket_bytes=2000)

    def frame(*rows):
        return spark.createDataFrame(rows, "k string, v int")

    def pend(*rows, at=wh):
        return at.stage_pending(frame(*rows), "d", "t", "k", _newest)

    def rows():
        return sorted(((r.k, r.v) for r in wh.read("d", "t").collect()), key=str)

    wh.overwrite(frame(("a", 1), (None, 1), (None, 2)), "d", "t")  # no key yet
    one = pend(("a", 2), ("b", 1), (None, 3))
    two = pend(("b", 3), ("c", 1))
    wh.publish(one), wh.publish(two)                               # neither loses the other
    state = [("a", 2), ("b", 3), ("c", 1), (None, 1), (None, 2)]
    assert rows() == sorted(state, key=str)
    late = pend(("c", 9))
    wh.settle("d", "t")
    wh.publish(late)                                               # onto the settled version
    state[2] = ("c", 9)
    assert rows() == sorted(state, key=str)
    wh.upsert(frame(("a", 0)), "d", "t", "k")                      # settles before it replaces
    wh.publish(pend(("d", 4)))
    wh.append(frame(("e", 5)), "d", "t")
    state = [("a", 0), *state[1:], ("d", 4), ("e", 5)]
    assert rows() == sorted(state, key=str)
    wh.publish(pend(*[(f"key {i}", i) for i in range(2000)]))
    wh.settle("d", "t")
    m = wh._manifest("d", "t", wh.current("d", "t"))
    assert m.buckets > 2 and len(rows()) == len(state) + 2000      # split by size
    wh.upsert(frame(("key 7", 0)), "d", "t", "k")
    assert ("key 7", 0) in rows() and ("key 7", 7) not in rows()
    monkeypatch.setattr(warehouse, "PENDING", 2)
    monkeypatch.setattr(warehouse, "MOST_PENDING", 3)
    for i in range(7):
        wh.publish(pend(("z", i)))
        assert len(wh._manifest("d", "t", wh.current("d", "t")).pending) <= 3
    assert ("z", 6) in rows() and len(rows()) == len(state) + 2001
