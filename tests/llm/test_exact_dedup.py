import hashlib

from tenderlake.llm import exact_dedup
from tests.llm.helpers import normal, rows

DOCS = [(5, "a b"), (3, "a\t\nb"), (9, "a  b"), (3, "a\t\nb"), (1, None), (2, ""), (7, " "), (8, " "), (None, "a b"),
        (None, "only null"), (None, "only null"), (10, "x" * 100_000), (11, "x" * 100_000), (12, "A b")]


def test_decisions_match_brute_force(spark):
    groups = {}
    for d, t in DOCS:
        groups.setdefault(normal(t), []).append(d)
    keep = {t: min((d for d in ds if d is not None), default=None) for t, ds in groups.items()}
    want = sorted(((d, keep[normal(t)], len(groups[normal(t)]), hashlib.sha256(normal(t).encode()).hexdigest())
                   for d, t in DOCS), key=str)
    got = exact_dedup.duplicate_decisions(rows(spark, DOCS)).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=str) == want
    assert sum(r["kept"] for r in got) == len(groups)
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_keep_first_keeps_one_row_per_text(spark):
    df = rows(spark, DOCS)
    kept = exact_dedup.keep_first(df.repartition(4))
    assert kept.columns == df.columns
    assert sorted(((r["doc_id"], normal(r["text"])) for r in kept.collect()), key=str) == sorted(
        [(3, "a b"), (1, ""), (7, " "), (8, " "), (None, "only null"), (10, "x" * 100_000), (12, "A b")], key=str)


def test_empty_table(spark):
    assert exact_dedup.duplicate_decisions(rows(spark, [])).count() == 0
    assert exact_dedup.keep_first(rows(spark, [])).count() == 0


def test_hot_text_collapses_before_the_shuffle(spark):
    plan = exact_dedup.keep_first(rows(spark, DOCS))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Python" not in plan
