import random

from tenderlake.llm.components import connected_components
from tests.llm.helpers import union_find


def components(spark, pairs):
    df = spark.createDataFrame(pairs, "src long, dst long")
    return {r["node"]: r["component"] for r in connected_components(df).collect()}


def test_random_graph_matches_union_find(spark):
    rnd = random.Random(3)
    pairs = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)]
    want = union_find({x for p in pairs for x in p}, pairs)
    got = components(spark, pairs + pairs[:50])
    touched = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {n: want[n] for n in touched}


def test_long_path_and_hub(spark):
    path = [(i, i + 1) for i in range(1000, 1200)]
    hub = [(5, i) for i in range(2000, 3000)]
    got = components(spark, path + hub)
    assert all(got[i] == 1000 for i in range(1000, 1201))
    assert all(got[i] == 5 for i in range(2000, 3000))


def test_nulls_loops_and_nothing(spark):
    assert components(spark, [(1, None), (None, 2), (3, 3)]) == {}
    assert components(spark, []) == {}
