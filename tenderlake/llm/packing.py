"""Best-fit packing by minimum bin slack, over token counts.

Documents are tokenised where they lie and become pieces of at most one
sequence.  Only the histogram of piece lengths (at most ``width`` rows, at any
data size) reaches the driver.  There, per bin, a bitset subset-sum dynamic
program over the lengths still available finds the fullest feasible
combination around the longest one; the combination is taken as often as the
counts allow and removed.  Each length is thereby cut into rank intervals, and
a piece finds its sequence from (length, rank), where ranks are counted in
parallel lanes, so a length that a third of all pieces have is no hot group.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenderlake.llm.common import map_arrow, materialize, text_or_empty

WIDTH = 2048
#: Pieces of one length that are ranked in one group, about, when a length holds them all.
LANE_ROWS = 100_000
END_ID = 0

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, nth long"
_ENCODERS: dict = {}

#: Longest run of blanks, or of anything else, that the rank-file encoder gets: its pattern engine overflows
#: its stack on some hundred thousand blanks, which ends the Python worker.
LONG_RUN = 10_000
_RUNS = re.compile(r"\s+|\S+")


def byte_level_ids(path: str, special: bool = True) -> Callable[[str], list[int]]:
    """Encoder of the JSON vocabulary at ``path``, without added tokens; one copy per Python worker.

    Where the rank-file form of the vocabulary (``.tiktoken``) lies next to
    it, ordinary texts are encoded with that, about four times as fast and
    with the same ids; texts with very long runs or special tokens never are.
    ``special=False``: the strings of special tokens are plain text.
    """
    if (path, special) not in _ENCODERS:
        from tokenizers import Tokenizer
        exact = Tokenizer.from_file(path)
        marks = [t.content for t in exact.get_added_tokens_decoder().values()] if special else []
        exact.encode_special_tokens = not special
        fast = _rank_encoder(path.removesuffix(".json") + ".tiktoken")

        def ids(text: str) -> list[int]:
            long = len(text) > LONG_RUN and any(m.end() - m.start() > LONG_RUN for m in _RUNS.finditer(text))
            if fast is None or long or any(m in text for m in marks):
                return exact.encode(text, add_special_tokens=False).ids
            return fast.encode_ordinary(text)

        _ENCODERS[path, special] = ids
    return _ENCODERS[path, special]


def _rank_encoder(path: str):
    import public_tokenizers
    import tiktoken
    if not os.path.exists(path):
        return None
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def cut_points(n: int, width: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; only the first may be shorter."""
    first = n % width or width
    return [(0, min(first, n))] + [(s, width) for s in range(first, n, width)]


def token_pieces(docs: DataFrame, tokenizer_path: str, width: int = WIDTH,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every document: its ids, then ``END_ID``, cut only when longer than ``width``.

    NULL and empty texts give one piece of length 1.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_level_ids(tokenizer_path)
        at = TaskContext.get().partitionId() * 7919  # a running number that deals pieces to lanes
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.array([*encode(text), END_ID], dtype="<u4")
                for k, (s, n) in enumerate(cut_points(len(ids), width)):
                    out.append((doc, k, s, n, zlib.crc32(ids[s:s + n].tobytes()), at))
                    at += 1
            cols = list(zip(*out)) if out else [()] * 6
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, kinds)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "nth"])

    wanted = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return map_arrow(wanted, run, PIECE_SCHEMA)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """Copies of each length whose sum is the largest possible within ``room``.

    Bit s of the set says that sum s can be made; copies enter in powers of
    two, longest lengths first, until ``room`` itself is reached.
    """
    full, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((x for x in counts if x <= room and counts[x] > 0), reverse=True):
        left, k = min(counts[length], room // length), 1
        while left > 0:
            k = min(k, left)
            steps.append((length, k, reach))
            reach |= (reach << (length * k)) & full
            left -= k
            k *= 2
        if reach >> room & 1:
            break
    goal, taken = reach.bit_length() - 1, {}
    for length, k, before in reversed(steps):
        if not before >> goal & 1:
            goal -= length * k
            taken[length] = taken.get(length, 0) + k
    return taken


def plan_bins(histogram: dict[int, int], width: int = WIDTH) -> list[tuple[int, dict[int, int]]]:
    """[(how often, {length: copies})]: minimum bin slack over the histogram.

    Taking a combination as often as the counts allow leaves some length with
    fewer copies than one bin uses, so the number of combinations is bounded
    by ``width`` (about width * ln(width)), not by the number of pieces.
    """
    left, plan = {k: v for k, v in histogram.items() if v > 0}, []
    while left:
        longest = max(left)
        left[longest] -= 1
        bin_ = fullest(left, width - longest)
        left[longest] += 1
        bin_[longest] = bin_.get(longest, 0) + 1
        times = min(left[x] // c for x, c in bin_.items())
        plan.append((times, bin_))
        for x, c in bin_.items():
            left[x] -= c * times
            if not left[x]:
                del left[x]
    return plan


def intervals(plan: list[tuple[int, dict[int, int]]]) -> dict[str, np.ndarray]:
    """Rank intervals per length, sorted by (length, first rank)."""
    rows, used, seq = [], {}, 0
    for times, bin_ in plan:
        offset = 0
        for length in sorted(bin_, reverse=True):
            c = bin_[length]
            rows.append((length, used.get(length, 0), c, seq, offset))
            used[length] = used.get(length, 0) + c * times
            offset += c * length
        seq += times
    rows.sort()
    cols = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return dict(zip(("length", "first", "copies", "seq", "offset"), cols))


def pack(docs: DataFrame, tokenizer_path: str, width: int = WIDTH, lane_rows: int = LANE_ROWS,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece.

    Repeated rows are packed once each; an empty table gives no rows.
    """
    spark = docs.sparkSession
    pieces = materialize(token_pieces(docs, tokenizer_path, width, id_col, text_col), "pieces")
    lanes = max(1, -(-pieces.count() // lane_rows))
    pieces = pieces.withColumn("lane", F.col("nth") % lanes)
    cells = pieces.groupBy("length", "lane").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    where = spark.sparkContext.broadcast(intervals(plan_bins(histogram, width)))
    earlier = Window.partitionBy("length").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select("length", "lane", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "lane").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (pieces.withColumn("at", F.row_number().over(order)).join(starts, ["length", "lane"])
              .select("doc_id", "piece", "start", "length", "ids_crc32",
                      (F.col("before") + F.col("at") - 1).alias("rank")))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = where.value
        big = np.int64(1) << np.int64(48)
        firsts = t["length"] * big + t["first"]
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            i = np.searchsorted(firsts, length * big + rank, side="right") - 1
            nth = rank - t["first"][i]
            seq = t["seq"][i] + nth // t["copies"][i]
            offset = t["offset"][i] + nth % t["copies"][i] * length
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(seq), pa.array(offset)],
                                             names=[*b.schema.names[:5], "sequence_id", "offset"])

    return map_arrow(ranked, place, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                    "sequence_id long, offset long")
