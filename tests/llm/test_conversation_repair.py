import hashlib
import itertools
import random
import re
import zlib

import pytest

from tenderlake.llm import conversation_repair as cr
from tenderlake.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, digest string, audit string, copies string"


def frame(spark, items):
    return spark.createDataFrame([(*x, "d", "a", None) for x in items], SCHEMA)


def strip(text):
    return text.strip(" \t\n\x0b\x0c\r")


def damage(items):
    out = {}
    for conv, turn, role, text in items:
        rows = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for rows in out.values():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    return out


def slow(rows):
    """gaps ... sha, by a plain program over whole strings."""
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, faults = set(), []
    for _, role, text in rows:
        faults.append("blank" if not strip(text) else "duplicate" if (role, text) in seen
                      else "truncated" if strip(text)[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    # every output so far that can still be completed: state -> (cost, audit, repaired lines)
    states = {"": (0, "", [])}

    def insert(states):
        out = dict(states)
        for _ in range(3):
            for s, (c, a, lines) in list(out.items()):
                for i, name in (("u", "user"), ("a", "assistant")):
                    put(out, s, i, (c + 2, a + "I", [*lines, f"{name}:"]))
        return out

    def put(out, s, initial, value):
        new = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((s, initial))
        if new is not None and (new not in out or value < out[new]):
            out[new] = value

    for (_, role, text), fault in zip(rows, faults):
        before, out = insert(states), {}
        for s, (c, a, lines) in before.items():
            if s not in out or (c + 3, a + "D", lines) < out[s]:
                out[s] = (c + 3, a + "D", lines)
            if fault in ("blank", "duplicate"):
                continue
            cost = c + (fault == "truncated")
            put(out, s, role[:1], (cost, a + "K", [*lines, f"{role}:{text}"]))
            for i, name in (("u", "user"), ("a", "assistant")):
                put(out, s, i, (cost + 2, a + "R", [*lines, f"{name}:{text}"]))
        states = out
    cost, audit, lines = min(v for s, v in insert(states).items() if s in ("", "a"))
    return (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def brute(items):
    return sorted(((conv, *slow(rows)) for conv, rows in damage(items).items()), key=str)


def cases(seed=1, n=60):
    rnd = random.Random(seed)
    texts = ["Yes.", "No", "What?", "Well!", "", " \t", "a. ", "b \n", "c?\x0b", "d"]
    roles = ["user", "assistant", "system", "tool", "user", "assistant"]
    items = []
    for conv in range(n):
        turn = rnd.randrange(3)
        for _ in range(rnd.randrange(1, 12)):
            items.append((conv, turn, rnd.choice(roles), rnd.choice(texts) if rnd.random() < .7 else f"text {turn}."))
            turn += rnd.choice([0, 1, 1, 1, 2])
    items += [(None, 1, "user", "Hi."), (None, None, "assistant", "Yes."), (100, None, None, None), (100, 1, None, "x."),
              (101, 3, "user", None), (102, 5, "", "empty role."), (102, 6, "u", "one letter."),
              (103, 1, "user", "long. " * 40_000), (104, None, "system", "s.")]
    items += [(105, 2, "user", "again.")] * 7 + [(105, 3, "assistant", "ok.")] * 2
    return items


@pytest.mark.parametrize("partition_rows", [100_000, 3])
def test_matches_brute_force(spark, partition_rows):
    items = cases()
    rows = frame(spark, items).repartition(3)
    got = cr.report(rows, cr.damaged(rows), partition_rows).collect()
    assert sorted(map(tuple, got), key=str) == brute(items)


def test_one_long_conversation_over_many_partitions(spark):
    rnd = random.Random(4)
    items = [(7, k // 2, rnd.choice(["user", "assistant", "system"]), rnd.choice(["Yes.", "No", f"Line {k}.", ""]))
             for k in range(300)] + [(8, 0, "user", "Hi.")]
    rows = frame(spark, items).repartition(4)
    got = cr.report(rows, cr.damaged(rows), partition_rows=20).collect()
    assert sorted(map(tuple, got), key=str) == brute(items)


@pytest.mark.parametrize("modulus", [cr.Audits.MODULUS, 7, 2])
def test_ties_compare_as_whole_strings_even_with_colliding_hashes(modulus):
    rnd = random.Random(8)
    audits = cr.Audits(modulus)
    nodes = [0]
    for _ in range(400):
        nodes.append(audits.extend(rnd.choice(nodes[-30:]), rnd.choice("DIKR")))
    pairs = list(itertools.product(rnd.sample(nodes, 90), repeat=2))
    assert all(audits.less(a, b) == (audits.text(a) < audits.text(b)) for a, b in pairs)
    for node in nodes:
        assert audits.lift(node, audits.depth[node] // 2) == 0 or \
            audits.text(audits.lift(node, audits.depth[node] // 2)) == audits.text(node)[:audits.depth[node] // 2]


def test_stretches_chain_at_every_cut():
    rnd = random.Random(11)
    for _ in range(60):
        rows = [(k, rnd.choice(["system", "user", "assistant", "x"]), rnd.random() < .15, False, rnd.random() < .3)
                for k in range(rnd.randrange(2, 9))]
        whole = cr.Stretch((cr.START,), 5)
        for r in rows:
            whole.take(*r)
        want = cr.finish({s: (c, a) for _, s, c, a in whole.cells()})
        for cut in range(1, len(rows)):
            states = {cr.START: (0, "")}
            for part in (rows[:cut], rows[cut:]):
                s = cr.Stretch((0, 1, 2, 3))
                for r in part:
                    s.take(*r)
                states = cr._through(states, [dict(zip(("entry", "exit", "cost", "audit"), c)) for c in s.cells()])
            assert cr.finish(states) == want


def test_audits_fit_the_pattern_and_rows_read_as_the_digest(spark):
    rows = frame(spark, cases(2, 25))
    clean = cr.as_they_are(rows)
    found = cr.audits(clean, 50)
    text = {}
    for r in sorted(cr.repaired_rows(clean, found).collect(), key=lambda r: (r["conv_id"] or -1, r["at"])):
        text.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    for lines in text.values():
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in lines))
    digests = {r["conv_id"]: r["repaired_sha256"] for r in cr.repaired_digests(clean, found).collect()}
    assert len(digests) == rows.select("conv_id").distinct().count()
    for conv, sha in digests.items():
        joined = "\n".join(f"{r}:{t}" for r, t in text.get(conv, []))
        assert sha == hashlib.sha256(joined.encode()).hexdigest()


def test_empty_table_and_vanished_conversations(spark):
    rows = frame(spark, [])
    assert cr.report(rows, cr.damaged(rows)).collect() == []
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    rows = frame(spark, [(gone, 0, "user", "Hi.")])
    assert [tuple(r) for r in cr.report(rows, cr.damaged(rows)).collect()] == [
        (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet")
             .select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op13_conversation_structure_repair"](spark, sf).collect()
    assert sorted(map(tuple, got), key=str) == brute(items)
