import hashlib
import random

import duckdb
import pytest

from tenderlake.llm import line_dedup
from tenderlake.llm.queries import ORACLE, QUERIES
from tests.llm.helpers import rows


def brute(docs, min_docs=3):
    """(doc_id, n_lines, n_dropped, text) per row, every row told apart."""
    def key(line):
        k = line.strip(" \t\n\x0b\x0c\r")
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in k)

    holders = {}
    for i, (_, text) in enumerate(docs):
        for k in {key(x) for x in (text or "").split("\n")}:
            holders.setdefault(k, []).append(i)
    out = []
    for doc, text in docs:
        lines, keep = (text or "").split("\n"), []
        for x in lines:
            k = key(x)
            ids = [docs[i][0] for i in holders[k]]
            top = max((i for i in ids if i is not None), default=None)
            if len(k) < 20 or len(ids) < min_docs or doc == top:
                keep.append(x)
        out.append((doc, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return sorted(out, key=str)


def corpus():
    rnd = random.Random(3)
    shared = [f"A Line that many documents share, number {k}" for k in range(12)]
    docs = []
    for i in range(60):
        lines = [f"own line {i} {k} of this document" for k in range(rnd.randrange(3))]
        lines += [rnd.choice(["  ", "\t", ""]) + rnd.choice([x, x.upper(), x.lower()]) + rnd.choice(["", " \r", "\x0b"])
                  for x in rnd.sample(shared, rnd.randrange(5))]
        lines += ["short line", "", shared[0][:19]]
        rnd.shuffle(lines)
        docs.append((i, "\n".join(lines)))
    docs += [(70, None), (71, ""), (72, "\n\n"), (73, "é" * 20 + "\n" + "É" * 20), (74, "é" * 20), (75, "É" * 20 + "\né" * 19),
             (76, "É" * 20), (77, "é" * 20), (5, docs[5][1]), (5, docs[5][1]), (None, docs[6][1]), (None, shared[3]),
             (78, "\n".join([shared[4]] * 5)), (79, (shared[5] + "\n") * 3), (80, "x" * 200_000 + "\n" + shared[6])]
    return docs


@pytest.mark.parametrize(("batches", "fan"), [(1, 2), (4, 2), (7, 3)])
def test_matches_brute_force(spark, batches, fan):
    docs = corpus()
    got = line_dedup.dedup_lines(rows(spark, docs).repartition(3), batches=batches, fan=fan).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs)
    assert any(r["n_dropped"] for r in got)


def test_order_of_batches_changes_nothing(spark):
    docs = corpus()
    lines = line_dedup.line_hashes(rows(spark, docs)).collect()
    results = set()
    for seed in range(3):
        mixed = list(lines)
        random.Random(seed).shuffle(mixed)
        index = line_dedup.LineIndex(spark, fan=2 + seed)
        for k in range(5):
            index.add(spark.createDataFrame(mixed[k::5], "doc_id long, text_key long, h1 long, h2 long"))
        results.add(frozenset(map(tuple, index.repeated().collect())))
        reopened = line_dedup.LineIndex(spark, runs=index.runs)
        assert frozenset(map(tuple, reopened.repeated().collect())) in results
    assert len(results) == 1


def test_settled_hashes_add_nothing_and_levels_stay_few(spark):
    index = line_dedup.LineIndex(spark, fan=2)
    batch = spark.createDataFrame([(100 + i, 1, 2) for i in range(3)] + [(1, 3, 4)], "doc_id long, h1 long, h2 long")
    index.add(batch)
    index.add(spark.createDataFrame([(5, 1, 2), (6, 3, 4)], "doc_id long, h1 long, h2 long"))
    assert [n for n, _ in index.runs] == [1]
    (entry,) = [r for r in index._read([index.runs[0][1]]).collect() if r["h1"] == 1]
    assert (entry["docs"], entry["top"]) == (3, 102)
    for k in range(6):
        index.add(batch)
        assert len(index.runs) <= 3
    # a larger id than the largest known is never settled
    index.add(spark.createDataFrame([(500, 1, 2)], "doc_id long, h1 long, h2 long"))
    assert {r["h1"]: r["top"] for r in index.repeated().collect()} == {1: 500, 3: 6}


def test_empty_table(spark):
    assert line_dedup.dedup_lines(rows(spark, [])).collect() == []


def test_query_matches_brute_force_and_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, QUERIES["op12_line_dedup"](spark, sf).select(
        "doc_id", "n_lines", "n_dropped", "kept_sha256").collect()))
    assert got == sorted((d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in brute(docs))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    sql = ORACLE["op12_line_dedup"]
    assert sorted(con.sql(f"SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM ({sql})").fetchall()) == got
