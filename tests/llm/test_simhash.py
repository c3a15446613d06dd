import itertools
import random
import re

import numpy as np
import xxhash

from tenderlake.llm import simhash
from tenderlake.llm.queries import QUERIES
from tests.llm.helpers import rows, union_find


def slow_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(docs, distance=4):
    fps = [(d, slow_fingerprint(t)) for d, t in docs]
    distinct = sorted({f for _, f in fps})
    root = union_find(distinct, [(a, b) for a, b in itertools.combinations(distinct, 2) if (a ^ b).bit_count() <= distance])
    low = {}
    for d, f in fps:
        if d is not None:
            low[root[f]] = min(d, low.get(root[f], d))
    return sorted(((d, f, low.get(root[f])) for d, f in fps), key=str)


def result(df):
    return sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in df.collect()), key=str)


def texts():
    rnd = random.Random(7)
    out = [(i, " ".join(rnd.choices(["Alpha", "b", "cé", "D.", "e", "fox", "Gg", "hh"], k=rnd.randrange(0, 60))))
           for i in range(60)]
    base = " ".join(f"t{k}" for k in range(300))
    for i in range(60, 120):
        ws = base.split()
        ws[rnd.randrange(300)] = "changed"
        out.append((i, " ".join(ws)))
    return out + [(200, None), (201, ""), (202, " \t\n"), (203, "one"), (204, "one two three"), (205, "ONE  two\x0bthree"),
                  (None, base), (60, base), (60, base), (206, "x y z w"), (207, "İstanbul A")]


def test_fingerprints_components_and_crowded_keys_match_brute_force(spark):
    docs = texts()
    want = slow_components(docs)
    assert result(simhash.near_duplicates(rows(spark, docs).repartition(3))) == want
    assert result(simhash.near_duplicates(rows(spark, docs), bucket=2)) == want
    assert len({c for _, _, c in want}) < len(docs) - 20


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(((r["doc_id"], int(r["fingerprint"], 16), r["component_id"])
                  for r in QUERIES["op3_simhash_near_dedup"](spark, sf).collect()), key=str)
    assert got == slow_components(docs)


def test_allocation_obeys_the_pigeonhole(spark):
    rnd = np.random.default_rng(4)
    n = 20_000
    bits = rnd.random((n, 64)) < rnd.uniform(0.2, 0.8, 64)
    both = bits.T.astype(np.int64) @ bits.astype(np.int64)
    for size in (100, 10**6, 10**9):
        parts = simhash.allocation(size, both * size // n, 4)
        assert sum(t + 1 for _, t in parts) == 5
        assert len({b for g, _ in parts for b in g}) == sum(len(g) for g, _ in parts)
        for _ in range(300):
            flips = rnd.choice(64, size=4, replace=False)
            assert any(sum(int(f) in g for f in flips) <= t for g, t in parts)
    assert simhash.allocation(0, np.zeros((64, 64), dtype=np.int64), 4)


def test_links_are_complete_for_random_neighbours(spark):
    rnd = random.Random(11)
    points = {rnd.getrandbits(64) for _ in range(300)}
    for p in list(points)[:150]:
        for b in rnd.sample(range(64), rnd.randrange(1, 6)):
            p ^= 1 << b
        points.add(p)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in points]
    df = spark.createDataFrame(signed, "fp long")
    want = union_find(points, [(a, b) for a, b in itertools.combinations(points, 2) if (a ^ b).bit_count() <= 4])
    for bucket in (4096, 1):
        edges = [(r["src"] % (1 << 64), r["dst"] % (1 << 64)) for r in simhash.links(df, 4, bucket).collect()]
        assert all((a ^ b).bit_count() <= 4 for a, b in edges)
        assert union_find(points, edges) == want


def test_points_of_crowded_keys_are_emitted_once_and_never_broadcast(spark):
    df = spark.createDataFrame([(i << 7 * (i % 8),) for i in range(200)], "fp long").distinct()
    edges = simhash._links_by_midpoint(df, 4)
    plan = edges._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("MapInArrow") == 1
    edges.collect()
    assert "Broadcast" not in edges._jdf.queryExecution().executedPlan().toString()


def test_keep_one(spark):
    docs = texts()
    df = rows(spark, docs)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    comps = {}
    for (d, t), (_, f, c) in zip(sorted(docs, key=lambda x: str((x[0], slow_fingerprint(x[1])))), slow_components(docs)):
        comps.setdefault(c, set()).add(d)
    got = [r["doc_id"] for r in kept.collect()]
    assert sorted(got) == sorted(comps)
    same = rows(spark, [(None, "a b c d e"), (None, "a b c d e"), (None, "z y x w v u")])
    assert kept.count() == len(comps) and simhash.keep_one(same).count() == 2


def test_empty_table(spark):
    assert simhash.near_duplicates(rows(spark, [])).count() == 0
    assert simhash.keep_one(rows(spark, [])).count() == 0
