import math
import random
import re
import zlib

import numpy as np

from tenderlake.llm import toxicity
from tests.llm.helpers import rows


def sample(texts):
    out = []
    for y, t in texts:
        ws = set(toxicity.words(t))
        out.append((y, toxicity.features(ws).tobytes(), [toxicity.features(v).tobytes() for v in toxicity.swapped(ws)]))
    return out


def biased(n=400):
    """Insults are toxic; one group is named mostly in toxic sentences, by accident of the data."""
    rnd = random.Random(9)
    plain = [f"plain{k}" for k in range(60)]
    out = []
    for _ in range(n):
        ws = rnd.choices(plain, k=12)
        toxic = rnd.random() < 0.4
        if toxic:
            ws.append(rnd.choice(["idiot", "scum"]))
        if rnd.random() < (0.6 if toxic else 0.03):
            ws.append("muslims")
        rnd.shuffle(ws)
        out.append((int(toxic), " ".join(ws)))
    return out


def test_swap_penalty_keeps_neutral_mentions_low():
    data = sample(biased())
    free = toxicity.fit(data, swap_penalty=0.0)
    fair = toxicity.fit(data)

    def gap(model):
        s = {w: toxicity.score_text(f"plain1 plain2 {w}", model, {}) for w in ("muslims", "person")}
        return abs(s["muslims"] - s["person"])

    assert gap(fair) < 0.5 * gap(free) and gap(fair) < 0.05
    assert toxicity.score_text("plain1 plain2 muslims", fair, {}) < 0.5
    assert toxicity.score_text("plain1 you scum", fair, {}) >= 0.7


def test_held_out_quality_on_documents(spark):
    from tenderlake.llm.queries import QUERIES
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [r for r in QUERIES["op7_toxicity"](spark, sf).collect() if r["held_out"] and r["doc_id"] in labels]
    pos = np.array([r["score"] for r in got if labels[r["doc_id"]] == 1])
    neg = np.array([r["score"] for r in got if labels[r["doc_id"]] == 0])
    assert len(pos) > 50 and len(neg) > 500
    assert (pos[:, None] > neg[None, :]).mean() > 0.93
    assert (pos >= 0.7).mean() > 0.8 and (neg >= 0.7).mean() < 0.01
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in got)


def test_labels_of_the_held_out_fold_are_never_read(spark):
    from pyspark.sql import functions as F
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = toxicity.train(docs, labels, ~toxicity.held_out())
    assert a == toxicity.train(docs, flipped, ~toxicity.held_out()) and len(a) > 1
    ids = [r["doc_id"] for r in labels.where(toxicity.held_out()).collect()]
    assert ids and all(zlib.crc32(str(i).encode()) % 3 == 1 for i in ids)


def plain_features(ws):
    """Hashes of the words and of their first 4, 5 and 6 bytes, ascending."""
    out = set()
    for w in ws:
        out.add(zlib.crc32(w) or 1)
        out |= {zlib.crc32(b"^" + w[:n]) or 1 for n in (4, 5, 6) if len(w) >= n}
    return sorted(out)


def plain_words(text):
    return {w.encode("utf-8") for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").lower())}


def packed(features):
    return b"".join(f.to_bytes(4, "little") for f in features)


def plain_swaps(ws):
    out = []
    for kind in toxicity.IDENTITY_TERMS.values():
        terms = kind.split()
        for term in terms:
            if term.encode() in ws:
                rest = [t for t in terms if t != term] + ["person"]
                for other in dict.fromkeys([rest[0], rest[len(rest) // 2], "person"]):
                    out.append((term, (ws - {term.encode()}) | {other.encode()}))
    return [packed(plain_features(v)) for _, v in sorted(out, key=lambda p: p[0])]


def test_query_equals_a_plain_classifier(spark, tmp_path):
    """Sample, counterfactuals and every score are rebuilt row by row; only the solver is shared."""
    from tenderlake.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    docs += [(90_001, None), (90_002, ""), (90_003, "a Muslim woman, an OLD man"), (90_004, "scum! idiot"), (90_004, "scum!")]
    toxic = [(r["doc_id"], int(r["toxic"])) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    toxic += [(90_003, 0), (90_004, 0), (90_004, 1), (99_999, 1)]
    rows(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(toxic, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    label, text = {}, {}
    for i, y in toxic:
        label[i] = max(y, label.get(i, 0))
    for i, t in docs:
        text[i] = min(t or "", text.get(i, t or ""))
    sample = []
    for i in sorted(text):
        if i in label and zlib.crc32(str(i).encode()) % 3 != 1:
            ws = plain_words(text[i])
            sample.append((label[i], packed(plain_features(ws)), plain_swaps(ws)))
    assert 50 < len(sample) <= toxicity.SAMPLE_ROWS and any(s[2] for s in sample)
    model = toxicity.fit(sorted(sample))
    wanted = []
    for i, t in docs:
        margin = model[0] + sum(model.get(f, 0.0) for f in plain_features(plain_words(t)))
        wanted.append((i, zlib.crc32(str(i).encode()) % 3 == 1, 1 / (1 + math.exp(-margin))))
    got = sorted((r["doc_id"], r["held_out"], r["score"]) for r in QUERIES["op7_toxicity"](spark, str(tmp_path)).collect())
    assert len(got) == len(wanted)
    for a, b in zip(got, sorted(wanted)):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-9


def test_awkward_rows(spark):
    docs = rows(spark, [(1, None), (2, ""), (2, ""), (None, "idiot"), (3, "word " * 200_000), (4, "idiot")])
    labels = spark.createDataFrame([(1, 0), (2, 0), (2, None), (3, 0), (4, 1), (None, 1), (99, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, ~toxicity.held_out(folds=1, fold=5), min_rows=1)
    got = toxicity.score(docs, model).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (1, 2)}) == 1
    none = toxicity.train(docs, labels.limit(0), ~toxicity.held_out())
    assert {r["predicted"] for r in toxicity.score(docs, none).collect()} == {0}
    assert toxicity.score(docs.limit(0), model).count() == 0
