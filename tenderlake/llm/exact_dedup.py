"""Exact dedup: 128-bit content hash groups, smallest id stays, bytes compared.

Texts are equal when identical after each run of white space became one space
(NULL counts as empty).  The grouping key is two independent 64-bit hashes
plus the normalised text itself: the hashes spread and sort the rows, and the
text in the key makes Spark compare the bytes, so a collision of the 128 bits
yields two groups.  Copies collapse before the shuffle (partial aggregation or
window group limit), so a text that a third of all rows share costs one row
per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenderlake.llm.common import free_name, text_or_empty


def normalized(c: str = "text") -> Column:
    return F.regexp_replace(text_or_empty(c), r"[\x20\x09-\x0D]+", " ")


def _hashes(norm: Column) -> tuple[Column, Column]:
    """Two hashes of the text with different seeds (the literal reseeds)."""
    return F.xxhash64(norm), F.xxhash64(F.lit(1), norm)


def duplicate_decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of rows that repeat both id and text exactly one is kept.  A NULL id never
    beats another id; a group of NULL ids only keeps one row, with keep_id
    NULL.  An empty table gives no rows.
    """
    norm = docs.select(F.col(id_col).alias("doc_id"), normalized(text_col).alias("norm"))
    h1, h2 = _hashes(F.col("norm"))
    keyed = norm.select("doc_id", h1.alias("h1"), h2.alias("h2"), "norm")
    groups = (keyed.groupBy("h1", "h2", "norm")
              .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("n"))
              .select("h1", "h2", F.sha2("norm", 256).alias("text_sha256"), "keep_id", "n"))
    # each (hash, sha256) must stand for one byte string, else rows could not be told apart below
    by_hash = (groups.groupBy("h1", "h2", "text_sha256")
               .agg(F.count("*").alias("texts"), F.min("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
               .select("h1", "h2", "text_sha256", "keep_id",
                       F.when(F.col("texts") == 1, F.col("group_size"))
                       .otherwise(F.raise_error(F.lit("two texts share all hashes"))).alias("group_size")))
    rows = (keyed.select("doc_id", "h1", "h2", F.sha2("norm", 256).alias("text_sha256"))
            .groupBy("doc_id", "h1", "h2", "text_sha256").agg(F.count("*").alias("copies")))
    # joined on another key than it was grouped by: both sides then get a shuffle of their own,
    # whose large partitions (a text that many rows share) adaptive execution splits
    out = rows.drop("h1", "h2").join(by_hash.drop("h1", "h2"), "text_sha256").withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return out.select("doc_id", "keep_id", "group_size",
                      (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
                      "text_sha256")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, all columns unchanged; each text is shuffled once.

    The window group limit keeps one row per text and map task before the
    shuffle.
    """
    names = {k: free_name(docs, f"_{k}") for k in ("norm", "h1", "h2", "rn")}
    h1, h2 = _hashes(F.col(names["norm"]))
    w = (Window.partitionBy(names["h1"], names["h2"], names["norm"])
         .orderBy(F.col(id_col).asc_nulls_last()))
    return (docs.withColumn(names["norm"], normalized(text_col))
            .withColumn(names["h1"], h1).withColumn(names["h2"], h2)
            .withColumn(names["rn"], F.row_number().over(w))
            .where(F.col(names["rn"]) == 1).drop(*names.values()))
