"""Toxicity: a counterfactually regularised linear classifier.

Features of a text are the words it holds and their beginnings (4 to 6
characters, which catch inflected and disguised forms), as presence, so a
score doesn't fade with length.  Logistic regression is fitted on a bounded
sample of labelled rows.  For every labelled sentence that mentions an
identity term, the sentence with the term swapped for others is built, and
the squared change of the score is added to the loss: group mentions by
themselves are thereby pushed towards the same weight as a neutral word, and
neutral mentions don't score.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlake.llm.common import crc_fold, map_arrow, text_or_empty

#: At most this many labelled rows are learned from (the smallest by hash of
#: the id): a fixed-size model needs no more, and the sample fits the driver.
SAMPLE_ROWS = 12_000
FEATURES = 6_000
MIN_ROWS = 4
THRESHOLD = 0.7
SWAP_PENALTY = 4.0
RIDGE = 5e-5
PREFIXES = (4, 5, 6)

# Identity terms by kind; a term is swapped for others of its kind and for the neutral word.
IDENTITY_TERMS = {
    "faith": "muslim muslims christian christians jewish jew jews hindu hindus buddhist atheist catholic protestant",
    "origin": "black white asian african american european mexican arab chinese indian latino immigrant immigrants "
              "refugee refugees foreigner foreigners",
    "gender": "woman women man men girl girls boy boys female male transgender trans",
    "orientation": "gay lesbian bisexual straight queer homosexual heterosexual",
    "condition": "deaf blind disabled autistic elderly old young",
}
NEUTRAL = "person"
_SWAPS = {t: [x for x in terms.split() if x != t] + [NEUTRAL]
          for terms in IDENTITY_TERMS.values() for t in terms.split()}

_SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_TO_WORDS = bytes(32 if c in set(_SEPARATORS) else c for c in range(256))


def words(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()


def word_features(word: bytes) -> list[int]:
    """Hashes of a word and of its beginnings; 0 is never a feature."""
    return [zlib.crc32(word) or 1, *[zlib.crc32(b"^" + word[:n]) or 1 for n in PREFIXES if len(word) >= n]]


def features(ws: set[bytes]) -> np.ndarray:
    return np.unique(np.array([f for w in ws for f in word_features(w)], dtype=np.uint32))


def swapped(ws: set[bytes]) -> list[set[bytes]]:
    """The word set with each identity term exchanged for the next of its kind and for the neutral word."""
    out = []
    for term in sorted(w.decode("ascii") for w in ws if w.isascii() and w.decode("ascii") in _SWAPS):
        others = _SWAPS[term]
        for other in dict.fromkeys([others[0], others[len(others) // 2], NEUTRAL]):
            out.append((ws - {term.encode()}) | {other.encode()})
    return out


def training_rows(docs: DataFrame, labels: DataFrame, learnable: Column, rows: int) -> DataFrame:
    """(y, x, swaps): features of the sample and of its counterfactuals, packed as bytes.

    The sample is at most ``rows`` ids, so broadcasting it is bounded and no
    text is shuffled.
    """
    ids = (labels.select("doc_id", F.col("toxic").cast("int").alias("y")).where("doc_id IS NOT NULL AND y IS NOT NULL")
           .groupBy("doc_id").agg(F.max("y").alias("y")).where(learnable)
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    # an id that many rows repeat is one row of the sample
    texts = (docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(ids), "doc_id")
             .groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("y", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [set(words(t)) for t in b.column(1).to_pylist()]
            x = [features(s).tobytes() for s in sets]
            swaps = [[features(v).tobytes() for v in swapped(s)] for s in sets]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(x, pa.binary()), pa.array(swaps, pa.list_(pa.binary()))],
                names=["y", "x", "swaps"])

    return map_arrow(texts, run, "y int, x binary, swaps array<binary>")


def _select(xs: list[np.ndarray], y: np.ndarray, size: int, min_rows: int) -> np.ndarray:
    """Features that are more frequent in toxic rows, by G-squared statistic, sorted.

    Only evidence for toxicity is used: ordinary words would otherwise learn
    negative weights, and a long text could outweigh its insults.  The
    statistic must pass 2 ln(number of features), about what the luckiest of
    so many irrelevant features reaches.
    """
    n, n1 = len(y), int(y.sum())
    ids, counts = np.unique(np.concatenate(xs), return_counts=True)
    on = [x for x, label in zip(xs, y) if label]
    ids1, counts1 = np.unique(np.concatenate(on), return_counts=True)
    hit = np.zeros(len(ids))
    hit[np.searchsorted(ids, ids1)] = counts1

    def part(seen, expected):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-12) / np.maximum(expected, 1e-12)), 0.0)

    total = counts.astype(float)
    g2 = 2 * (part(hit, total * n1 / n) + part(total - hit, total * (n - n1) / n)
              + part(n1 - hit, (n - total) * n1 / n) + part(n - total - (n1 - hit), (n - total) * (n - n1) / n))
    ok = np.flatnonzero((total >= min_rows) & (hit * n > total * n1) & (g2 > 2 * np.log(max(2, len(ids)))))
    best = ok[np.lexsort((ids[ok], -g2[ok]))[:size]]
    return np.sort(ids[best])


def _sparse(xs: list[np.ndarray], vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rows, cols = [], []
    for i, x in enumerate(xs):
        at = np.searchsorted(vocabulary, x)
        at = at[(at < len(vocabulary)) & (vocabulary[np.minimum(at, len(vocabulary) - 1)] == x)]
        rows.append(np.full(len(at), i))
        cols.append(at)
    return np.concatenate([np.zeros(0, int), *rows]).astype(np.int64), \
        np.concatenate([np.zeros(0, int), *cols]).astype(np.int64)


def fit(sample: list[tuple[int, bytes, list[bytes]]], size: int = FEATURES, min_rows: int = MIN_ROWS,
        ridge: float = RIDGE, swap_penalty: float = SWAP_PENALTY, steps: int = 300) -> dict:
    """{feature: weight} with the bias under feature 0; one class only: no weights, the bias says which.

    Rows are weighted so that both classes weigh the same: a score of 0.5 is
    where a text is as typical of one as of the other.
    """
    y = np.array([min(1, max(0, r[0])) for r in sample], dtype=float)
    if not len(y) or y.min() == y.max():
        return {0: 4.0 if len(y) and y[0] else -4.0}
    xs = [np.frombuffer(r[1], dtype=np.uint32) for r in sample]
    vocabulary = _select(xs, y, size, min_rows)
    identity = np.array([f for t in [*_SWAPS, NEUTRAL] for f in word_features(t.encode())], dtype=np.uint32)
    vocabulary = np.union1d(vocabulary, identity)
    m, n = len(vocabulary), len(y)
    r, c = _sparse(xs, vocabulary)
    owner = np.array([i for i, s in enumerate(sample) for _ in s[2]], dtype=np.int64)
    sr, sc = _sparse([np.frombuffer(v, dtype=np.uint32) for s in sample for v in s[2]], vocabulary)
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / n
    w, bias = np.zeros(m), 0.0
    mom, var, b_mom, b_var, rate = np.zeros(m), np.zeros(m), 0.0, 0.0, 0.05

    def margin(rows, cols, count):
        return np.bincount(rows, weights=w[cols], minlength=count)

    for step in range(1, steps + 1):
        z = margin(r, c, n)
        err = (1 / (1 + np.exp(-(z + bias))) - y) * weight
        if len(owner):
            # d/dz of penalty * mean((z - z_swapped)^2)
            gap = 2 * swap_penalty * (z[owner] - margin(sr, sc, len(owner))) / len(owner)
            pull = np.bincount(owner, weights=gap, minlength=n)
        else:
            gap, pull = np.zeros(0), np.zeros(n)
        grad = np.bincount(c, weights=(err + pull)[r], minlength=m) + ridge * w
        if len(owner):
            grad -= np.bincount(sc, weights=gap[sr], minlength=m)
        mom, var = 0.9 * mom + 0.1 * grad, 0.999 * var + 0.001 * grad ** 2
        b_mom, b_var = 0.9 * b_mom + 0.1 * err.sum(), 0.999 * b_var + 0.001 * err.sum() ** 2
        fix = np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
        w -= rate * fix * mom / (np.sqrt(var) + 1e-9)
        bias -= rate * fix * b_mom / (np.sqrt(b_var) + 1e-9)
    return {0: bias, **{int(f): float(x) for f, x in zip(vocabulary, w) if abs(x) > 1e-4}}


def train(docs: DataFrame, labels: DataFrame, learnable: Column, rows: int = SAMPLE_ROWS, **kw) -> dict:
    got = training_rows(docs, labels, learnable, rows).collect()
    # Spark returns rows in no fixed order; sums in floating point should not depend on it
    return fit(sorted((r["y"], bytes(r["x"]), [bytes(v) for v in r["swaps"]]) for r in got), **kw)


def score_text(text: str, model: dict, cache: dict) -> float:
    """Score of a text; ``cache`` remembers the (feature, weight) pairs of words seen before."""
    hit: dict[int, float] = {}
    for w in set(words(text)):
        found = cache.get(w)
        if found is None:
            found = tuple((f, model[f]) for f in word_features(w) if f in model)
            if len(cache) < 200_000:
                cache[w] = found
        if found:
            hit.update(found)
    return float(1 / (1 + np.exp(-(sum(hit[f] for f in sorted(hit)) + model[0]))))


def score(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted of every row; NULL and empty texts get the bias's score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for b in batches:
            s = [score_text(t, shared.value, cache) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(s, pa.float64()), pa.array([int(x >= threshold) for x in s], pa.int32())],
                names=["doc_id", "score", "predicted"])

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return map_arrow(wanted, run, "doc_id long, score double, predicted int")


def held_out(id_col: str = "doc_id", folds: int = 3, fold: int = 1) -> Column:
    return F.coalesce(crc_fold(F.col(id_col), folds) == fold, F.lit(False))
