"""Line dedup with levelled sorted runs of line hashes.

Every document contributes its distinct long lines as 128-bit hashes.  A run
is a Parquet folder of (hash, number of documents, largest doc_id), sorted by
hash inside each file.  A new batch is counted by hash (partial counts first,
so a line that a third of all documents hold is no hot key), anti-joined by
merge with what the runs have settled already, and adds the rest as a run of
its own; ``fan`` runs of a level are compacted into one run of the next, so a
hash is rewritten a logarithmic number of times.  Settled means: enough
documents, and none of the batch's is larger than the largest known.  Such a
hash can't change any decision, whatever the order of the batches is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.llm.common import map_arrow, materialize, text_or_empty
from tenderlake.session import drop_scratch, scratch_path

MIN_DOCS = 3
MIN_CHARS = 20
BATCHES = 4
FAN = 2
BLANKS = " \t\n\x0b\x0c\r"


def line_hash(line: str, min_chars: int = MIN_CHARS) -> bytes | None:
    """128-bit hash of a line's key (stripped, A-Z lower-cased); None for a key that is too short."""
    key = line.strip(BLANKS)
    if len(key) < min_chars:
        return None
    return hashlib.blake2b(key.encode().lower(), digest_size=16).digest()  # bytes.lower() knows A-Z only


def _halves(h: bytes) -> tuple[int, int]:
    return int.from_bytes(h[:8], "big", signed=True), int.from_bytes(h[8:], "big", signed=True)


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and a hash of the text: rows equal in both have the same result."""
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
            .withColumn("text_key", F.xxhash64("text")))


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """doc_id, text_key, h1, h2: the distinct long lines of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, h1, h2 = [], [], [], []
            for doc, text, key in zip(*(c.to_pylist() for c in batch.columns)):
                seen = {line_hash(x, min_chars) for x in text.split("\n")} if len(text) >= min_chars else set()
                seen.discard(None)
                ids += [doc] * len(seen)
                keys += [key] * len(seen)
                for a, b in map(_halves, seen):
                    h1.append(a)
                    h2.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (ids, keys, h1, h2)],
                                             names=["doc_id", "text_key", "h1", "h2"])

    return map_arrow(_documents(docs, id_col, text_col), run, "doc_id long, text_key long, h1 long, h2 long")


class LineIndex:
    """Runs of (h1, h2, docs, top) by level; ``runs`` reopens an index from its (level, folder) pairs."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fan: int = FAN,
                 runs: list[tuple[int, str]] | None = None):
        self.spark, self.min_docs, self.fan = spark, min_docs, fan
        self.runs = list(runs or [])

    def _write(self, level: int, entries: DataFrame) -> None:
        path = scratch_path(self.spark, f"line-run-{level}")
        entries.sortWithinPartitions("h1", "h2").write.parquet(path)
        self.runs.append((level, path))

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema("h1 long, h2 long, docs long, top long").parquet(*paths)

    def add(self, lines: DataFrame) -> None:
        """A batch of (doc_id, h1, h2), one row per document and line.  NULL ids are below all others."""
        new = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("top"))
        if self.runs:
            settled = (self._read([p for _, p in self.runs]).where(F.col("docs") >= self.min_docs)
                       .select("h1", "h2", F.col("top").alias("known")).hint("merge"))
            same = (new["h1"] == settled["h1"]) & (new["h2"] == settled["h2"])
            decided = new["top"].isNull() | (settled["known"] >= new["top"])
            new = new.join(settled, same & decided, "left_anti")
        self._write(0, new)
        level = 0
        while len(full := [p for n, p in self.runs if n == level]) >= self.fan:
            self._write(level + 1, self._merged(full))
            self.runs = [r for r in self.runs if r[1] not in full]
            for path in full:
                drop_scratch(self.spark, path)
            level += 1

    def _merged(self, paths: list[str]) -> DataFrame:
        return self._read(paths).groupBy("h1", "h2").agg(F.sum("docs").alias("docs"), F.max("top").alias("top"))

    def repeated(self) -> DataFrame:
        """h1, h2, top of every line found in at least ``min_docs`` documents."""
        if not self.runs:
            return self.spark.createDataFrame([], "h1 long, h2 long, top long")
        return self._merged([p for _, p in self.runs]).where(F.col("docs") >= self.min_docs).select("h1", "h2", "top")


def _in_batches(lines: DataFrame, ids: DataFrame, batches: int) -> tuple[str, int]:
    """Write ``lines`` in folders by batch, the largest ids first (so that most repeats find their hash settled)."""
    shares = [k / batches for k in range(1, batches)]
    cuts = ids.agg(F.percentile_approx("doc_id", shares, 1000)).first()[0] if shares else []
    cuts = sorted(set(cuts or []), reverse=True)
    batch = reduce(lambda a, b: a + b, [F.coalesce(F.col("doc_id") < c, F.lit(True)).cast("int") for c in cuts],
                   F.lit(0))
    path = scratch_path(lines.sparkSession, "lines")
    lines.withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    return path, len(cuts) + 1


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, batches: int = BATCHES,
                fan: int = FAN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_dropped, text (the lines that stay) of every row.

    Lines whose key is found in at least ``min_docs`` rows go, except from the
    rows of the largest id that hold it.  NULL and empty texts have one empty
    line.  Repeated rows count once each and have the same result; a NULL id
    is below all others; an empty table gives no rows; other columns are not
    read.
    """
    spark = docs.sparkSession
    rows = _documents(docs, id_col, text_col)
    path, n = _in_batches(line_hashes(docs, min_chars, id_col, text_col), rows.select("doc_id"), batches)
    lines = spark.read.schema("doc_id long, text_key long, h1 long, h2 long, batch int").parquet(path)
    index = LineIndex(spark, min_docs, fan)
    for k in range(n):
        index.add(lines.where(F.col("batch") == k))
    # written first: a join whose sides come straight from their shuffles can split a line, or a row, that is hot
    repeated = materialize(index.repeated(), "repeated-lines")
    hits = materialize(lines.join(repeated, ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("top")))
                       .select("doc_id", "text_key", "h1", "h2"), "dropped-lines")
    gone = materialize(hits.groupBy("doc_id", "text_key")
                       .agg(F.collect_set(F.struct("h1", "h2")).alias("gone")), "dropped-by-document")
    same = rows["doc_id"].eqNullSafe(gone["doc_id"]) & (rows["text_key"] == gone["text_key"])
    # a document's repeated lines only: no larger than the document
    both = rows.join(gone, same, "left").select(
        rows["doc_id"], rows["text"], F.transform("gone", lambda g: g["h1"]).alias("h1"),
        F.transform("gone", lambda g: g["h2"]).alias("h2"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids, lengths, dropped, texts = [], [], [], []
            for doc, text, h1, h2 in zip(*(c.to_pylist() for c in part.columns)):
                total = text.count("\n") + 1
                ids.append(doc)
                lengths.append(total)
                if h1:
                    bad = set(zip(h1, h2))
                    keep = []
                    for line in text.split("\n"):
                        h = line_hash(line, min_chars)
                        if h is None or _halves(h) not in bad:
                            keep.append(line)
                    dropped.append(total - len(keep))
                    text = "\n".join(keep)
                else:
                    dropped.append(0)
                texts.append(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), pa.array(dropped, pa.int64()),
                 pa.array(texts, pa.string())], names=["doc_id", "n_lines", "n_dropped", "text"])

    return map_arrow(both, run, "doc_id long, n_lines long, n_dropped long, text string")
