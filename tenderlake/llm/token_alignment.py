"""Cross-tokenizer alignment: which ids of two vocabularies stand for the same bytes.

Both tokenizers cut the same bytes (a space and the text).  Offsets where a
token of each ends cut them into groups; inside a group every A token is linked
with every B token.  How many documents hold an id pair linked is counted over
the whole corpus.

Identity-map fast path: an array made once names for every A id the B id of
the same bytes.  Pairs of that map (all groups of one token each, but for
byte-for-byte twins in B) are counted in a vector of vocabulary length per
task; only the pairs of irregular groups are shuffled, pre-aggregated in the
task.  A document's distinct links are kept as packed arrays, so texts are
encoded once.

Counts come back to the documents in two parts: the vector, each A id's best
count and the most frequent irregular pairs (at most ``HOT_PAIRS``, a fixed
table whatever the corpus) are broadcast; links to all other pairs, rare by
construction and hence no hot keys, are joined by a shuffle.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.llm.common import map_arrow, materialize, text_or_empty
from tenderlake.llm.packing import byte_level_ids

#: Irregular pairs in the broadcast table at most (24 bytes each).
HOT_PAIRS = 1 << 20
#: Pairs made at a time inside one group.
BLOCK = 1 << 20
_LOADED: dict = {}


class Vocabularies:
    """Both tokenizers; what they need is loaded once per Python worker."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        self.encode_a = byte_level_ids(a_path, special=False)
        self.model = sentencepiece.SentencePieceProcessor(model_file=b_path)
        ranks = {int(n): base64.b64decode(b) for b, n in map(bytes.split, open(a_path.replace(".json", ".tiktoken"), "rb"))}
        self.a_bytes = [ranks.get(i, b"") for i in range(max(ranks) + 1)]
        self.b_bytes = [self._piece(i) for i in range(self.model.get_piece_size())]
        self.a_len = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        by_bytes: dict[bytes, int] = {}
        for i, x in enumerate(self.b_bytes):  # of byte-for-byte twins the ordinary piece, else the smaller id
            if x and (x not in by_bytes or self.model.is_byte(by_bytes[x]) and not self.model.is_byte(i)):
                by_bytes[x] = i
        self.identity = np.array([by_bytes.get(x, -1) for x in self.a_bytes], dtype=np.int64)
        self.digits = {n: _digits(n) for n in (len(self.a_bytes), len(self.b_bytes))}

    def _piece(self, i: int) -> bytes:
        m = self.model
        if m.is_byte(i):
            return bytes([int(m.id_to_piece(i)[3:5], 16)])
        if m.is_control(i) or m.is_unknown(i) or m.is_unused(i):
            return b""
        return m.id_to_piece(i).replace("▁", " ").encode()

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A and B; None where there are no tokens (empty, or bytes that the tokens don't give back)."""
        if not text:
            return None
        whole = (" " + text).encode()
        a, b = self.encode_a(" " + text), self.model.encode(text)
        if b"".join(map(self.b_bytes.__getitem__, b)) != whole or b"".join(map(self.a_bytes.__getitem__, a)) != whole:
            return None
        return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)


def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0 to n - 1, left-justified with a spare column, and how many there are."""
    width = len(str(n)) + 1
    text = np.array([str(i).encode() for i in range(n)], dtype=f"S{width}")
    return text.view(np.uint8).reshape(n, width), np.char.str_len(text)


def vocabularies(a_path: str, b_path: str) -> Vocabularies:
    if (a_path, b_path) not in _LOADED:
        _LOADED[a_path, b_path] = Vocabularies(a_path, b_path)
    return _LOADED[a_path, b_path]


def groups(a_len: np.ndarray, b_len: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one past the last A token, one past the last B token) of every group."""
    _, i, j = np.intersect1d(np.cumsum(a_len), np.cumsum(b_len), assume_unique=True, return_indices=True)
    return i + 1, j + 1


def groups_text(v: Vocabularies, a: np.ndarray, b: np.ndarray, a_end: np.ndarray, b_end: np.ndarray) -> bytes:
    """``a1,a2|b1;a3|b2,b3``: the groups' ids in decimal."""
    a_group = np.searchsorted(a_end, np.arange(len(a)), side="right")
    b_group = np.searchsorted(b_end, np.arange(len(b)), side="right")
    before = np.concatenate([[0], b_end[:-1]])
    a_at = np.arange(len(a)) + before[a_group]
    b_at = np.arange(len(b)) + a_end[b_group]
    total = len(a) + len(b)
    mark = np.full(total, ord(","), dtype=np.uint8)
    mark[a_at[a_end - 1]] = ord("|")
    mark[b_at[b_end - 1]] = ord(";")
    (da, la), (db, lb) = v.digits[len(v.a_bytes)], v.digits[len(v.b_bytes)]
    width = max(da.shape[1], db.shape[1])
    out = np.zeros((total, width), dtype=np.uint8)
    out[a_at, :da.shape[1]] = da[a]
    out[b_at, :db.shape[1]] = db[b]
    size = np.empty(total, dtype=np.int64)
    size[a_at], size[b_at] = la[a], lb[b]
    out[np.arange(total), size] = mark
    return out[np.arange(width) <= size[:, None]].tobytes()[:-1]


def links(v: Vocabularies, a: np.ndarray, b: np.ndarray, a_end: np.ndarray,
          b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct linked pairs as a * |B| + b, how often each is linked, and the number of links.

    Tokens of a large group are counted by id first, and its pairs are made a
    block at a time, so a group holds no more than its distinct pairs.
    """
    p, q = np.diff(a_end, prepend=0), np.diff(b_end, prepend=0)
    n_b = len(v.b_bytes)
    single = (p == 1) & (q == 1)
    pairs = [a[a_end[single] - 1] * n_b + b[b_end[single] - 1]]
    times = [np.ones(len(pairs[0]), dtype=np.int64)]
    usual = ~single & (p * q <= 4096)
    if usual.any():
        pu, qu = p[usual], q[usual]
        count = pu * qu
        owner = np.repeat(np.arange(len(count)), count)
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        ai = (a_end[usual] - pu)[owner] + at // qu[owner]
        bi = (b_end[usual] - qu)[owner] + at % qu[owner]
        pairs.append(a[ai] * n_b + b[bi])
        times.append(np.ones(len(ai), dtype=np.int64))
    for g in np.flatnonzero(p * q > 4096):
        ua, na = np.unique(a[a_end[g] - p[g]:a_end[g]], return_counts=True)
        ub, nb = np.unique(b[b_end[g] - q[g]:b_end[g]], return_counts=True)
        step = max(1, BLOCK // len(ub))
        for s in range(0, len(ua), step):
            pairs.append((ua[s:s + step, None] * n_b + ub).ravel())
            times.append((na[s:s + step, None] * nb).ravel())
    key, place = np.unique(np.concatenate(pairs), return_inverse=True)
    # sums of integers in floating point are exact below 2^53
    return key, np.bincount(place, np.concatenate(times), len(key)).astype(np.int64), int((p * q).sum())


ENCODED = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "regular binary, regular_times binary, irregular binary, irregular_times binary")


def encoded(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: sizes, digest of the groups, and its distinct links with their numbers.

    ``regular``: A ids linked with their identity (int32); ``irregular``: other
    pairs as a * |B| + b (int64).
    """
    names = [x.split()[0] for x in ENCODED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabularies(a_path, b_path)
        n_b, row = len(v.b_bytes), TaskContext.get().partitionId() << 40
        for batch in batches:
            out = []
            for doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                ids = v.encode(text)
                if ids is None:
                    out.append((row, doc, 0, 0, 0, 0, "", b"", b"", b"", b""))
                else:
                    a, b = ids
                    a_end, b_end = groups(v.a_len[a], v.b_len[b])
                    key, times, n = links(v, a, b, a_end, b_end)
                    same = v.identity[key // n_b] == key % n_b
                    sha = hashlib.sha256(groups_text(v, a, b, a_end, b_end)).hexdigest()
                    out.append((row, doc, len(a), len(b), len(a_end), n, sha,
                                (key[same] // n_b).astype("<i4").tobytes(), times[same].astype("<i4").tobytes(),
                                key[~same].astype("<i8").tobytes(), times[~same].astype("<i4").tobytes()))
                row += 1
            kinds = [*[pa.int64()] * 6, pa.string(), *[pa.binary()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else [()] * 11, kinds)],
                                             names=names)

    wanted = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return map_arrow(wanted, run, ENCODED)


def _sizes(a_path: str, b_path: str) -> tuple[int, int, np.ndarray]:
    v = vocabularies(a_path, b_path)
    return len(v.a_bytes), len(v.b_bytes), v.identity


def pair_counts(rows: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """a, b, docs: how many documents hold each pair linked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_a, n_b, identity = _sizes(a_path, b_path)
        vector = np.zeros(n_a, dtype=np.int64)

        def batch(a, b, n):
            return pa.RecordBatch.from_arrays([pa.array(np.asarray(x, dtype=np.int64)) for x in (a, b, n)],
                                              names=["a", "b", "docs"])

        for part in batches:
            regular = np.frombuffer(b"".join(part.column(0).to_pylist()), dtype="<i4")
            vector += np.bincount(regular, minlength=n_a)
            key, n = np.unique(np.frombuffer(b"".join(part.column(1).to_pylist()), dtype="<i8"), return_counts=True)
            yield batch(key // n_b, key % n_b, n)
        ids = np.flatnonzero(vector)
        yield batch(ids, identity[ids], vector[ids])

    return (map_arrow(rows.select("regular", "irregular"), run, "a long, b long, docs long")
            .groupBy("a", "b").agg(F.sum("docs").alias("docs")))


def _columns(df: DataFrame) -> list[np.ndarray]:
    """A small frame's columns (callers bound the rows)."""
    got = df.toArrow()
    return [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in got.columns]


def align(docs: DataFrame, a_path: str, b_path: str, hot_pairs: int = HOT_PAIRS, id_col: str = "doc_id",
          text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, pairs).

    documents: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256 of every row; ``n_best``: links whose pair count is the
    highest of their A id, ``count_sum``: the pair counts of all links.
    pairs: a, b, docs.  NULL and empty texts, and texts that the tokens don't
    give back byte for byte, have zeros and an empty digest.  Repeated rows
    count once each; an empty table gives empty frames.
    """
    spark = docs.sparkSession
    n_a, n_b, identity = _sizes(a_path, b_path)
    rows = materialize(encoded(docs, a_path, b_path, id_col, text_col), "aligned-rows")
    pairs = materialize(pair_counts(rows, a_path, b_path), "aligned-pairs")
    best = np.zeros(n_a, dtype=np.int64)
    ids, top = _columns(pairs.groupBy("a").agg(F.max("docs").alias("docs")))  # at most |A| rows
    best[ids] = top
    # a local frame of |A| rows: the identity of each A id, for the JVM side
    same = spark.createDataFrame(pa.table({"a": np.arange(n_a), "same": identity}))
    marked = pairs.join(F.broadcast(same), "a")
    vector = np.zeros(n_a, dtype=np.int64)
    ids, n = _columns(marked.where("b = same").select("a", "docs"))  # at most |A| rows
    vector[ids] = n
    other = marked.where("b <> same").select((F.col("a") * n_b + F.col("b")).alias("pair"), "docs")
    # the least power of two such that no more than ``hot_pairs`` pairs are at least as frequent: at most 64 rows
    sizes = {r[0]: r[1] for r in other.groupBy(F.length(F.bin("docs")) - 1).count().collect()}
    level = 64
    while level > 0 and sum(n for k, n in sizes.items() if k >= level - 1) <= hot_pairs:
        level -= 1
    hot, hot_n = _columns(other.where(F.col("docs") >= F.lit(2.0 ** level)))
    order = np.argsort(hot)
    hot, hot_n = hot[order], hot_n[order]
    shared = spark.sparkContext.broadcast((best, vector, hot, hot_n))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, vector, hot, hot_n = shared.value
        for part in batches:
            n_best, total = [], []
            for a, ta, key, tk in zip(*(part.column(k).to_pylist() for k in range(7, 11))):
                a, ta = np.frombuffer(a, dtype="<i4"), np.frombuffer(ta, dtype="<i4").astype(np.int64)
                key, tk, n, found = _looked_up(key, tk, hot, hot_n)
                counts = np.concatenate([vector[a], n[found]])
                times = np.concatenate([ta, tk[found]])
                top = np.concatenate([best[a], best[key[found] // n_b]])
                n_best.append(int(times[counts == top].sum()))
                total.append(int((times * counts).sum()))
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:7], pa.array(n_best, pa.int64()), pa.array(total, pa.int64())],
                names=[*part.schema.names[:7], "n_best", "count_sum"])

    scored = map_arrow(rows, score, "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
                                    "groups_sha256 string, n_best long, count_sum long")
    result = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if level == 0:  # every pair is in the table
        return scored.select(*result), pairs

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, hot, hot_n = shared.value
        for part in batches:
            for row, key, tk in zip(*(c.to_pylist() for c in part.columns)):
                key, tk, _, found = _looked_up(key, tk, hot, hot_n)
                if not found.all():
                    key, tk = key[~found], tk[~found]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), row)), pa.array(key), pa.array(tk)],
                                                     names=["row", "pair", "times"])

    tops = spark.createDataFrame(pa.table({"a": np.arange(n_a), "top": best}))
    rare = (other.where(F.col("docs") < F.lit(2.0 ** level)).withColumn("a", F.expr(f"pair div {n_b}"))
            .join(F.broadcast(tops), "a").select("pair", "docs", (F.col("docs") == F.col("top")).alias("is_best")))
    more = (map_arrow(rows.select("row", "irregular", "irregular_times"), rest, "row long, pair long, times long")
            .join(rare, "pair").groupBy("row")
            .agg(F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("more_best"),
                 F.sum(F.col("times") * F.col("docs")).alias("more_sum")))
    summed = (scored.join(more, "row", "left")
              .withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0)))
              .withColumn("count_sum", F.col("count_sum") + F.coalesce("more_sum", F.lit(0))))
    return summed.select(*result), pairs


def _looked_up(key: bytes, times: bytes, hot: np.ndarray, hot_n: np.ndarray) -> tuple:
    """Pairs, their numbers, their counts and whether the table has them."""
    k, t = np.frombuffer(key, dtype="<i8"), np.frombuffer(times, dtype="<i4").astype(np.int64)
    if not len(hot):
        return k, t, np.zeros(len(k), dtype=np.int64), np.zeros(len(k), dtype=bool)
    at = np.minimum(np.searchsorted(hot, k), len(hot) - 1)
    return k, t, hot_n[at], hot[at] == k
