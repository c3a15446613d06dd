"""SimHash near-dedup with a generalised pigeonhole search.

Fingerprints are computed where the texts lie and written once.  Distinct
fingerprints are the search space, so exact copies, however many, are one
point.  Bits that vary together are grouped into the same partition; a dynamic
program over the expected number of candidates chooses how many partitions to
use and gives each its own distance threshold, with sum(threshold + 1) =
max distance + 1.  By the pigeonhole principle two fingerprints within the
maximum distance are within the threshold on some partition.  Each fingerprint
is filed under the keys within half the threshold of its partition value; two
that meet under a key are compared on all 64 bits.

Inside one key no pair list is made: a breadth-first walk compares a frontier
with what is not reached yet and yields a spanning forest.  Keys with more
fingerprints than ``BUCKET`` are found by a count first and left out of that
walk; their fingerprints instead emit every point within half the distance on
all 64 bits, where two that are linked always share a point (linear in their
number, exact for any bucket size).
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenderlake.llm.common import cut, free_name, map_arrow, materialize, text_or_empty
from tenderlake.llm.components import connected_components

BITS = 64
SHINGLE = 4
MAX_DISTANCE = 4
SEED = 42
BUCKET = 4096
#: Fingerprints of crowded keys that one task expands into points (2,081 each, some 50 MB).
EXPANDED = 1024

#: Seconds per row filed under a key and per pair compared: the weights of the dynamic program.
ROW_COST, PAIR_COST = 2e-6, 5e-9


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Majority bits over the XXH64 of all word shingles, repeats included.

    Words are runs between ASCII white space, A-Z lower-cased.  Fewer words
    than a shingle: one shingle of them all.  No word: 0.
    """
    import xxhash
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - shingle + 1)
    starts = [0, *(ends[:n - 1] + 1).tolist()]
    stops = ends[min(shingle, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(flat[a:b], SEED) for a, b in zip(starts, stops)], dtype="<u8")
    ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text_col: str = "text",
                 keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``fp`` (the 64 bits as a signed long) of every row; NULL text counts as empty."""
    wanted = docs.select(*keep, text_or_empty(text_col).alias("_whole_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b.column(b.num_columns - 1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fps.view(np.int64))],
                                             names=[*b.schema.names[:-1], "fp"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.schema.fields[:-1]]
    return map_arrow(wanted, run, ", ".join([*fields, "fp long"]))


def bit_moments(points: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and the 64 x 64 counts of jointly set bits, over all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((BITS, BITS), dtype=np.float64), 0
        for b in batches:
            x = _bit_matrix(b.column(0).to_numpy(zero_copy_only=False)).astype(np.float32)
            for s in range(0, len(x), 1 << 20):  # float32 counts stay exact
                part = x[s:s + (1 << 20)]
                both += part.T @ part
            n += len(x)
        cells = np.append(both.ravel(), n).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells), dtype=np.int32)), pa.array(cells)],
                                         names=["cell", "n"])

    rows = map_arrow(points.select("fp"), run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    cells = np.zeros(BITS * BITS + 1, dtype=np.int64)
    for r in rows:
        cells[r["cell"]] = r["n"]
    return int(cells[-1]), cells[:-1].reshape(BITS, BITS)


def _bit_matrix(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(fp).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def correlated_groups(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Deal the bits into ``parts`` groups, each grown by the bit most correlated with it."""
    p = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(p, p)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(cov / np.outer(spread, spread))
    left, groups = set(range(BITS)), []
    for g in range(parts):
        room = BITS // parts + (g < BITS % parts)
        group = [min(left, key=lambda b: (-sum(corr[b, x] for x in left if x != b), b))]
        left.discard(group[0])
        while len(group) < room:
            nxt = min(left, key=lambda b: (-corr[b, group].sum(), b))
            group.append(nxt)
            left.discard(nxt)
        groups.append(sorted(group))
    return groups


def _ball(width: int, radius: int) -> int:
    return sum(math.comb(width, r) for r in range(radius + 1))


def _cost(n: int, p: np.ndarray, group: list[int], threshold: int) -> float:
    """Expected seconds to file and compare ``n`` fingerprints on one partition."""
    if threshold < 0:
        return 0.0
    differ = np.array([1.0])
    for b in group:
        q = 2 * p[b] * (1 - p[b])
        differ = np.convolve(differ, [1 - q, q])
    width, r = len(group), (threshold + 1) // 2
    shared = 0.0  # expected number of common keys of two fingerprints
    for d in range(min(2 * r, width) + 1):
        ways = sum(math.comb(d, i) * math.comb(width - d, j)
                   for i in range(d + 1) for j in range(width - d + 1)
                   if i + j <= r and d - i + j <= r)
        shared += differ[d] * ways
    return ROW_COST * n * _ball(width, r) + PAIR_COST * n * n / 2 * shared


def thresholds(n: int, p: np.ndarray, groups: list[list[int]], max_distance: int) -> tuple[float, list[int]]:
    """Cheapest thresholds >= -1 with sum(threshold + 1) = max_distance + 1, by dynamic programming."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for group in groups:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t in range(-1, max_distance + 1 - used):
                key, c = used + t + 1, cost + _cost(n, p, group, t)
                if key not in nxt or c < nxt[key][0]:
                    nxt[key] = (c, [*chosen, t])
        best = nxt
    return best[max_distance + 1]


def allocation(n: int, both: np.ndarray, max_distance: int) -> list[tuple[list[int], int]]:
    """[(bits, threshold)] of the cheapest partitioning into 2 .. max_distance + 1 groups."""
    p = np.diag(both) / max(n, 1)
    options = []
    for parts in range(2, max(3, max_distance + 2)):
        groups = correlated_groups(n, both, parts)
        cost, ts = thresholds(n, p, groups, max_distance)
        options.append((cost, parts, [(g, t) for g, t in zip(groups, ts) if t >= 0]))
    return min(options)[2]


def _flips(positions: list[int], radius: int) -> np.ndarray:
    masks = [sum(1 << x for x in c) for r in range(radius + 1) for c in itertools.combinations(positions, r)]
    return np.array(masks, dtype=np.uint64)


def filed(points: DataFrame, parts: list[tuple[list[int], int]]) -> DataFrame:
    """(key, fp): each fingerprint under all keys within half the threshold, per partition."""
    specs = [(np.uint64(k) << np.uint64(56), np.array(bits, dtype=np.uint64),
              _flips(list(range(len(bits))), (t + 1) // 2)) for k, (bits, t) in enumerate(parts)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = np.uint64(1)
        for b in batches:
            whole = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for s in range(0, len(whole), 4096):
                fp = whole[s:s + 4096]
                for tag, bits, flips in specs:
                    value = np.zeros(len(fp), dtype=np.uint64)
                    for at, bit in enumerate(bits):
                        value |= ((fp >> bit) & one) << np.uint64(at)
                    keys = ((value[:, None] ^ flips) | tag).ravel()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.view(np.int64)), pa.array(np.repeat(fp, len(flips)).view(np.int64))],
                        names=["key", "fp"])

    return map_arrow(points.select("fp"), run, "key long, fp long")


def forest(fp: np.ndarray, max_distance: int) -> list[tuple[int, int]]:
    """Edges that span the groups of ``fp`` (signed longs) linked within ``max_distance`` bits."""
    x = fp.view(np.uint64)
    rest, edges = np.arange(len(x)), []
    while len(rest):
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            at = frontier.pop()
            near = np.bitwise_count(x[rest] ^ x[at]) <= max_distance
            if near.any():
                reached = rest[near]
                edges += [(int(fp[at]), int(fp[i])) for i in reached]
                frontier += reached.tolist()
                rest = rest[~near]
    return edges


def _links_in_runs(max_distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = None, []

        def found(edges):
            return pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in edges], pa.int64()), pa.array([b for _, b in edges], pa.int64())],
                names=["src", "dst"])

        for b in batches:
            key = b.column(0).to_numpy(zero_copy_only=False)
            fp = b.column(1).to_numpy(zero_copy_only=False)
            if not len(key):
                continue
            edges = []
            bounds = np.flatnonzero(np.diff(key)) + 1
            runs = list(zip([0, *bounds.tolist()], [*bounds.tolist(), len(key)]))
            for a, z in runs:
                if key[a] == held_key:
                    held.append(fp[a:z])
                    continue
                if held and sum(map(len, held)) > 1:
                    edges += forest(np.concatenate(held), max_distance)
                held_key, held = key[a], [fp[a:z]]
            yield found(edges)
        if held and sum(map(len, held)) > 1:
            yield found(forest(np.concatenate(held), max_distance))

    return run


def links(points: DataFrame, max_distance: int = MAX_DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Edges (src, dst) whose components are those of all links between the distinct ``fp``."""
    n, both = bit_moments(points)
    keyed = filed(points, allocation(n, both, max_distance))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n"))
    big = cut(sizes.where(F.col("n") > bucket))
    small = keyed
    crowded = big.agg(F.sum("n")).first()[0]
    if crowded:
        small = keyed.join(big, "key", "left_anti")
    edges = map_arrow(small.repartition("key").sortWithinPartitions("key"), _links_in_runs(max_distance),
                      "src long, dst long")
    if crowded:
        crowd = keyed.join(big, "key", "left_semi").select("fp").repartition(-(-crowded // EXPANDED), "fp").distinct()
        edges = edges.unionByName(_links_by_midpoint(crowd, max_distance))
    return edges.distinct()


def _links_by_midpoint(points: DataFrame, max_distance: int) -> DataFrame:
    """Exact links for crowded keys, for an even ``max_distance``.

    Two fingerprints are linked exactly when some 64-bit point lies within
    half the distance of both, so everything that emits a point is linked to
    the smallest fingerprint that emits it.  No join: Spark takes the emitted
    points to be as few as ``points`` and would broadcast them.  A point is
    emitted by 2,081 fingerprints at most (distance 4), so no window grows.
    """
    if max_distance % 2:
        raise ValueError("crowded keys need an even maximum distance")
    flips = _flips(list(range(BITS)), max_distance // 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            whole = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for s in range(0, len(whole), 64):
                fp = whole[s:s + 64]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((fp[:, None] ^ flips).ravel().view(np.int64)),
                     pa.array(np.repeat(fp, len(flips)).view(np.int64))], names=["mid", "fp"])

    mids = map_arrow(points, run, "mid long, fp long")
    src = F.min("fp").over(Window.partitionBy("mid"))
    return mids.select(src.alias("src"), F.col("fp").alias("dst")).where(F.col("src") != F.col("dst")).distinct()


def near_groups(fps: DataFrame, max_distance: int = MAX_DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """(fp, root) for the fingerprints that have a link to another one; ``fps`` is a stored table."""
    points = fps.select("fp").distinct()
    return connected_components(links(points, max_distance, bucket)).select(
        F.col("node").alias("fp"), F.col("component").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE, bucket: int = BUCKET,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp, component_id of every row; component_id is the smallest doc_id reachable.

    Repeated rows share a component.  NULL ids take part but name a component
    only when it has no other id (then NULL).
    """
    fps = materialize(fingerprints(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")),
                                   shingle), "fingerprints")
    roots = cut(near_groups(fps, max_distance, bucket))
    # written sides: adaptive execution splits a hot root only where both sides of the join come straight from a shuffle
    lowest = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("low")).join(roots, "fp", "left"), "lowest")
    linked, alone = lowest.where(F.col("root").isNotNull()), lowest.where(F.col("root").isNull())
    component = materialize(linked.groupBy("root").agg(F.min("low").alias("component_id")), "components")
    by_fp = (linked.join(component, "root").select("fp", "component_id")
             .unionByName(alone.select("fp", F.col("low").alias("component_id"))))
    return fps.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE, bucket: int = BUCKET,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, all columns unchanged: of each component the smallest id (NULL last).

    Rows are told apart by id and text hash, so repeated and NULL ids are
    safe; of rows equal in both one stays.
    """
    key, rn = free_name(docs, "_row_md5"), free_name(docs, "_rn")
    keyed = docs.withColumn(key, F.md5(F.concat_ws("\u0001", F.col(id_col).cast("string"), text_or_empty(text_col))))
    fps = materialize(fingerprints(keyed.select(F.col(id_col).alias("doc_id"), F.col(key).alias("row_md5"),
                                                F.col(text_col).alias("text")),
                                   shingle, keep=("doc_id", "row_md5")), "fingerprints")
    roots = cut(near_groups(fps, max_distance, bucket))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("row_md5")))
    per_fp = fps.groupBy("fp").agg(first.alias("first")).join(roots, "fp", "left")
    stay = (per_fp.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
            .select(F.col("first.row_md5").alias(key)))
    w = Window.partitionBy(key).orderBy(F.lit(0))
    return (keyed.join(stay, key, "left_semi").withColumn(rn, F.row_number().over(w))
            .where(F.col(rn) == 1).drop(key, rn))
