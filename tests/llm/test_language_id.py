import math
import zlib
from collections import Counter, defaultdict

import numpy as np

from tenderlake.llm import language_id as li
from tests.llm.helpers import rows

EN = "the cat and the dog were in the house with their friends and the other animals "
FR = "le chat et le chien étaient dans la maison avec leurs amis et les autres animaux "
DE = "die katze und der hund waren in dem haus mit ihren freunden und den anderen tieren "


def model(spark):
    return li.learn(rows(spark, [(1, EN * 5, "en"), (2, FR * 5, "fr"), (3, DE * 5, "de"), (4, None, "en"), (5, EN, None)]))


def test_single_and_mixed_documents(spark):
    langs, p = model(spark)
    assert langs == ["de", "en", "fr"]
    np.testing.assert_allclose(p.sum(axis=0), 1)
    for text, want in ((EN, "en"), (FR, "fr"), (DE, "de")):
        got = li.infer(text, p)
        assert langs[got[0]] == want and got[1] == 1.0  # the penalty leaves one language
    lang, share = li.infer(FR * 3 + EN, p)
    assert langs[lang] == "fr" and 0.6 < share < 0.9


def test_em_recovers_known_proportions():
    rnd = np.random.default_rng(1)
    p = rnd.dirichlet(np.full(500, 0.1), size=3).T
    counts = rnd.multinomial(20_000, p @ [0.6, 0.3, 0.1]).astype(float)
    seen = counts > 0
    share, _ = li.em(p[seen], counts[seen], steps=100)
    np.testing.assert_allclose(share, [0.6, 0.3, 0.1], atol=0.03)


def test_awkward_rows(spark):
    m = model(spark)
    docs = [(1, None), (2, ""), (3, "123 --- !!"), (4, "\t\n"), (5, EN), (5, EN), (None, FR), (6, "a"), (7, "é"), (8, DE * 4000)]
    df = rows(spark, docs)
    got = sorted(((r["doc_id"], r["lang_pred"], r["score"]) for r in li.predict(df, m).collect()), key=str)
    by_id = {d: (lang, s) for d, lang, s in got}
    assert len(got) == len(docs)
    assert all(by_id[i] == ("und", 0.0) for i in (1, 2, 3, 4))
    assert by_id[5][0] == "en" and by_id[None][0] == "fr" and by_id[8][0] == "de"
    assert all(by_id[i][0] != "und" and 0 < by_id[i][1] <= 1 for i in (6, 7))
    kept = li.keep_identified(df, m)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 5, 5, 6, 7, 8]
    nothing = li.learn(rows(spark, []))
    assert nothing[0] == [] and {r["lang_pred"] for r in li.predict(df, nothing).collect()} == {"und"}
    assert li.predict(rows(spark, []), m).count() == 0


def test_held_out_accuracy_on_documents(spark):
    from tenderlake.llm.queries import QUERIES
    sf = "/root/testdata/sf0.1"
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    got = [r for r in QUERIES["op10_language_id"](spark, sf).collect() if r["held_out"]]
    assert len(got) > 2000
    assert np.mean([lang[r["doc_id"]] == r["lang_pred"] for r in got]) > 0.98


def plain_trigrams(text):
    """Trigram buckets of one text, byte by byte."""
    out = []
    for b in f" {text.lower()} ".encode("utf-8", "surrogatepass"):
        b = b if b >= 0x80 or chr(b).isalpha() else 32
        if not out or b != 32 or out[-1] != 32:
            out.append(b)
    return [((a << 16 | b << 8 | c) * 2654435761 % 2**32) >> 17 for a, b, c in zip(out, out[1:], out[2:])]


def plain_mixture(seen, model, chosen):
    share = {x: 1 / len(chosen) for x in chosen}
    for _ in range(li.STEPS):
        got = dict.fromkeys(chosen, 0.0)
        for t, n in seen.items():
            whole = sum(share[x] * model[x][t] for x in chosen)
            for x in chosen:
                got[x] += n * share[x] * model[x][t] / whole
        total = sum(seen.values())
        share = {x: v / total for x, v in got.items()}
    return share, sum(n * math.log(sum(share[x] * model[x][t] for x in chosen)) for t, n in seen.items())


def plain_prediction(text, model):
    seen = Counter(plain_trigrams(text or ""))
    if not any(c.isalpha() for c in text or "") or not seen or not model:
        return "und", 0.0
    price = li.PENALTY + 0.5 * math.log(sum(seen.values()))
    chosen = [max(sorted(model), key=lambda x: sum(n * math.log(model[x][t]) for t, n in seen.items()))]
    share, best = plain_mixture(seen, model, chosen)
    everywhere, ceiling = plain_mixture(seen, model, sorted(model))
    for x in sorted(sorted(model), key=lambda x: -everywhere[x]):
        if x in chosen:
            continue
        got, ll = plain_mixture(seen, model, [*chosen, x])
        if ceiling - best <= price or ll - best <= price:
            break
        chosen, share, best = [*chosen, x], got, ll
    top = max(chosen, key=lambda x: share[x])
    return top, share[top]


def plain_model(docs):
    counts = {}
    for doc_id, text, lang in docs:
        if lang is not None and text is not None and (doc_id is None or zlib.crc32(str(doc_id).encode()) % 4 != 2):
            counts.setdefault(lang, Counter()).update(plain_trigrams(text))
    return {x: defaultdict(lambda floor=li.SMOOTHING / (c.total() + li.SMOOTHING * li.BUCKETS): floor, {
        t: (n + li.SMOOTHING) / (c.total() + li.SMOOTHING * li.BUCKETS) for t, n in c.items()}) for x, c in counts.items()}


def test_query_equals_a_plain_mixture(spark, tmp_path):
    from tenderlake.llm.queries import QUERIES
    docs = [(r["doc_id"], r["text"], r["lang"])
            for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    docs += [(90_000 + i, t, lang) for i, (t, lang) in enumerate([
        (None, "en"), ("", "fr"), ("12 ..", None), (EN + FR * 2, None), (DE + EN + FR, None), ("a\0b c\0", "de"), ("É", None)])]
    rows(spark, docs).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["lang_pred"], r["score"], r["held_out"])
           for r in QUERIES["op10_language_id"](spark, str(tmp_path)).collect()}
    assert len(got) == len(docs)
    model = plain_model(docs)
    for doc_id, text, _ in docs:
        lang, score = plain_prediction(text, model)
        assert got[doc_id][0] == lang and abs(got[doc_id][1] - min(1.0, score)) < 1e-9, doc_id
        assert got[doc_id][2] == (zlib.crc32(str(doc_id).encode()) % 4 == 2)


def test_model_does_not_depend_on_the_dealing_of_rows(spark):
    docs = rows(spark, [(i, t, lang) for i, (t, lang) in enumerate(
        [("ab", "en"), ("cd\0e", "en"), ("", "en"), (FR, "fr"), ("..", "fr"), ("x", "fr"), (None, "fr"), ("é", "de")] * 40)])
    models = [li.learn(docs.repartition(n)) for n in (1, 3, 11)]
    for langs, p in models[1:]:
        assert langs == models[0][0] == ["de", "en", "fr"]
        np.testing.assert_array_equal(p, models[0][1])
