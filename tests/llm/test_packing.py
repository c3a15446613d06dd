import itertools
import random
import zlib

import numpy as np
import pytest

from tenderlake.llm import packing
from tenderlake.llm.queries import tokenizer_path
from tests.llm.helpers import rows

TEXTS = ["", " ", "a", "Hello, world's  end\n\n\t x", "été naïve Ñandú größer 日本語 🙂🙃", "x" * 5000, " " * 3000,
         "1234567890 " * 50, "end<|endoftext|>start", "  tab\u0085", "don't we'll I'M", "a\r\nb\r\n"]


@pytest.fixture(scope="module")
def reference():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_are_those_of_the_json_vocabulary(spark, reference):
    encode = packing.byte_level_ids(tokenizer_path())
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for t in TEXTS + [r["text"] or "" for r in docs.select("text").collect()]:
        assert encode(t) == reference.encode(t, add_special_tokens=False).ids


LONG = [" " * 1_000_000, "\n" * 1_000_000, "a" * 1_000_000, "x " + "\t" * 400_000 + "y" * 400_000, "?" * 300_000,
        "é" * 300_000, "ab " * 300_000]


def test_very_long_runs_have_the_ids_of_the_json_vocabulary(spark, reference):
    """The rank-file encoder ends its process on some of these."""
    encode = packing.byte_level_ids(tokenizer_path())
    for t in LONG:
        assert encode(t) == reference.encode(t, add_special_tokens=False).ids
    texts = list(enumerate(LONG[:4]))
    check(packing.pack(rows(spark, texts), tokenizer_path()).collect(), texts, 2048, reference)


def test_without_the_rank_file_ids_are_the_same(tmp_path, reference):
    import shutil
    path = shutil.copy(tokenizer_path(), tmp_path / "v.json")
    encode, plain = packing.byte_level_ids(str(path)), packing.byte_level_ids(str(path), special=False)
    for t in TEXTS:
        assert encode(t) == reference.encode(t, add_special_tokens=False).ids
        assert (plain(t) == encode(t)) == ("<|endoftext|>" not in t)


def test_fullest_matches_brute_force():
    rnd = random.Random(1)
    for _ in range(60):
        items = [rnd.randrange(1, 30) for _ in range(rnd.randrange(1, 9))]
        room = rnd.randrange(0, 60)
        counts = {x: items.count(x) for x in items}
        got = packing.fullest(counts, room)
        assert all(got[x] <= counts[x] for x in got)
        best = max((sum(c) for r in range(len(items) + 1) for c in itertools.combinations(items, r) if sum(c) <= room))
        assert sum(x * c for x, c in got.items()) == best


def best_fit_decreasing(hist, width):
    space, bins = [0] * (width + 1), 0
    for x in sorted(hist, reverse=True):
        for _ in range(hist[x]):
            s = next((s for s in range(x, width + 1) if space[s]), None)
            if s is None:
                bins, s = bins + 1, width
            else:
                space[s] -= 1
            space[s - x] += 1
    return bins


@pytest.mark.parametrize("most", [4, 60])
def test_plan_uses_every_piece_once_and_no_more_bins_than_best_fit_decreasing(most):
    rnd = random.Random(2)
    hist = {x: rnd.randrange(1, most) for x in rnd.sample(range(1, 2049), 700)}
    plan = packing.plan_bins(hist)
    used = {}
    for times, bin_ in plan:
        assert times > 0 and sum(x * c for x, c in bin_.items()) <= packing.WIDTH
        for x, c in bin_.items():
            used[x] = used.get(x, 0) + c * times
    assert used == hist
    assert sum(t for t, _ in plan) <= best_fit_decreasing(hist, packing.WIDTH)
    assert packing.plan_bins({}) == []


def test_number_of_combinations_does_not_follow_the_number_of_pieces():
    rnd = random.Random(2)
    hist = {x: rnd.randrange(1, 10**9) for x in rnd.sample(range(1, 2049), 700)}
    assert len(packing.plan_bins(hist)) < 8_000


def check(got, texts, width, reference):
    """Exact round trip: every piece where and what it should be, every sequence gapless."""
    want = []
    for doc, t in texts:
        ids = np.array([*reference.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        first = len(ids) % width or min(width, len(ids))
        cuts = [0, *range(first, len(ids), width), len(ids)]
        want += [(doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]

    def key(x):
        return tuple((v is None, v or 0) for v in x)

    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=key) \
        == sorted(want, key=key)
    by_seq = {}
    for r in got:
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= width
    return len(by_seq), sum(w[3] for w in want)


@pytest.mark.parametrize("lane_rows", [100_000, 5])
def test_pack_round_trip_with_awkward_rows(spark, reference, lane_rows):
    texts = [(i, t) for i, t in enumerate(TEXTS)] + [(3, None), (3, None), (None, "nul id"), (7, "x" * 9000),
                                                     (7, "x" * 9000), (8, "word " * 64)] + [(9, "same text")] * 20
    got = packing.pack(rows(spark, texts).repartition(3), tokenizer_path(), width=64, lane_rows=lane_rows).collect()
    n, total = check(got, texts, 64, reference)
    assert n <= -(-total // 64) + 2


def test_query_on_documents(spark, reference):
    sf = "/root/testdata/sf0.01"
    from tenderlake.llm.queries import QUERIES
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    n, total = check(QUERIES["op1_best_fit_packing"](spark, sf).collect(), [tuple(r) for r in docs], 2048, reference)
    assert n <= 1.005 * -(-total // 2048) + 1


def test_empty_table(spark):
    assert packing.pack(rows(spark, []), tokenizer_path()).count() == 0
