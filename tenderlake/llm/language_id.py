"""Language identification as inference of a multilingual mixture.

Every language is a distribution over hashed character trigrams, counted over
all learning rows.  A document is a mixture of languages:
expectation-maximisation estimates the proportions, and the language set grows
by the next language only while the log-likelihood gains more than a penalty
per language.  The prediction is the language with the largest share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlake.llm.common import crc_fold, free_name, map_arrow, ship, text_or_empty

BUCKETS = 1 << 15
SMOOTHING = 0.5
STEPS = 12
#: A further language must gain this many nats plus half the log of the number of trigrams.
PENALTY = 3.0
UNKNOWN = "und"
#: Share that the main language must reach for a row to be kept; mixtures of three stay.
MIN_SCORE = 0.3

# Bytes of words: letters and everything beyond ASCII; all else separates.  NUL stands between texts.
_BYTES = np.array([c | 0x20 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 or c == 0 else 32
                   for c in range(256)], dtype=np.uint32)


def trigrams(*texts: str) -> np.ndarray:
    """Buckets of the byte trigrams of lower-cased texts, none across two texts; a run of separators counts once."""
    joined = "\0".join([f" {text.lower()} ".replace("\0", " ") for text in texts])
    raw = _BYTES[np.frombuffer(joined.encode("utf-8", "surrogatepass"), dtype=np.uint8)]
    keep = raw != 32
    keep[0] = True
    keep[1:] |= raw[:-1] != 32
    raw = raw[keep]
    if len(raw) < 3:
        return np.zeros(0, dtype=np.int64)
    code = raw[:-2] << np.uint32(16) | raw[1:-1] << np.uint32(8) | raw[2:]
    if len(texts) > 1:
        between = raw == 0
        code = code[~(between[:-2] | between[1:-1] | between[2:])]
    return ((code * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def trigram_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, bucket, n) over all rows with a language; each task sends one count per language and bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for b in batches:
            texts: dict[str, list[str]] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                texts.setdefault(lang, []).append(text)
            for lang, ts in texts.items():
                total = counts.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                for i in range(0, len(ts), 64):
                    total += np.bincount(trigrams(*ts[i:i + 64]), minlength=BUCKETS)
        for lang, total in counts.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])],
                names=["lang", "bucket", "n"])

    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(
        "lang IS NOT NULL AND text IS NOT NULL")
    return (map_arrow(rows, run, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> tuple[list[str], np.ndarray]:
    """(languages, probabilities by language and bucket); no learning rows: no languages.

    What reaches the driver is one count per language and bucket, as packed
    columns: a bound that doesn't depend on the number of rows.  The model
    that tasks share has 256 KB per language.
    """
    found = trigram_counts(docs, lang_col, text_col).toArrow()
    lang = found["lang"].combine_chunks().dictionary_encode()
    langs = sorted(lang.dictionary.to_pylist())
    place = np.array([langs.index(x) for x in lang.dictionary.to_pylist()], dtype=np.int64)
    counts = np.zeros((len(langs), BUCKETS))
    counts[place[lang.indices.to_numpy()], found["bucket"].to_numpy()] = found["n"].to_numpy()
    p = (counts + SMOOTHING) / (counts.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)
    return langs, np.ascontiguousarray(p.T)


def em(p: np.ndarray, counts: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """(proportions, log-likelihood): ``p`` has a row per trigram and a column per language."""
    share, total = np.full(p.shape[1], 1.0 / p.shape[1]), counts.sum()
    for _ in range(steps):
        mixed = p @ share
        share = share * ((counts / mixed) @ p) / total
    return share, float(counts @ np.log(p @ share))


def infer(text: str, p: np.ndarray, penalty: float = PENALTY) -> tuple[int, float] | None:
    """(language, its share of the selected mixture); None when there is nothing to judge by."""
    if not p.shape[1] or not has_letter(text):
        return None
    found, counts = _counted(trigrams(text))
    if not len(found):
        return None
    rows, counts = p[found], counts.astype(float)
    n = counts.sum()
    alone = counts @ np.log(rows)
    chosen = [int(np.argmax(alone))]
    share, best = np.ones(1), float(alone[chosen[0]])
    price = penalty + 0.5 * np.log(n)
    if p.shape[1] > 1:
        everywhere, ceiling = em(rows, counts)
        order = [int(x) for x in np.lexsort((np.arange(len(alone)), -everywhere)) if x != chosen[0]]
        for nxt in order:
            if ceiling - best <= price:  # not even all languages together would gain enough
                break
            got, ll = em(rows[:, [*chosen, nxt]], counts)
            if ll - best <= price:
                break
            chosen, share, best = [*chosen, nxt], got, ll
    top = int(np.argmax(share))
    return chosen[top], float(min(1.0, share[top] / share.sum()))


def _counted(buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if len(buckets) < 2000:
        return np.unique(buckets, return_counts=True)
    full = np.bincount(buckets, minlength=BUCKETS)
    at = np.flatnonzero(full)
    return at, full[at]


def predict_column(docs: DataFrame, model: tuple[list[str], np.ndarray], text: Column) -> Column:
    """struct(lang, score) of a text column."""
    langs, p = model
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((langs, p))

    @F.pandas_udf("lang string, score double")
    def predict(texts):
        import pandas as pd
        names, probs = shared.value
        got = [None if t is None else infer(t, probs) for t in texts]
        return pd.DataFrame({"lang": [UNKNOWN if g is None else names[g[0]] for g in got],
                             "score": [0.0 if g is None else g[1] for g in got]})

    return predict(text)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row; NULL texts and texts without a letter: ``und``, 0."""
    return (docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
            .select("doc_id", predict_column(docs, model, F.col("text")).alias("got"))
            .select("doc_id", F.col("got.lang").alias("lang_pred"), F.col("got.score").alias("score")))


def keep_identified(docs: DataFrame, model: tuple[list[str], np.ndarray], min_score: float = MIN_SCORE,
                    text_col: str = "text") -> DataFrame:
    """Rows whose main language is known and makes up ``min_score`` of the text, all columns unchanged."""
    got = free_name(docs, "_got")
    return (docs.withColumn(got, predict_column(docs, model, text_or_empty(text_col)))
            .where((F.col(f"{got}.lang") != UNKNOWN) & (F.col(f"{got}.score") >= min_score)).drop(got))


def held_out(id_col: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    return F.coalesce(crc_fold(F.col(id_col), folds) == fold, F.lit(False))
