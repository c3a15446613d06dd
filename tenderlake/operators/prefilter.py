"""A fixed-size filter of hashes that drops most rows without a partner before they are shuffled.

The keys of the small side are hashed to one bit each of a bitmap with a
chosen number of 64-bit words.  The words that hold a bit are a table of at
most that many rows, whatever the number of keys, so it may be broadcast.  A
row whose bit is not set has no partner; a row whose bit is set may have one.
The more keys, the less the filter drops, but it never drops a row with a
partner, and it keeps or drops all rows of one key together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 64-bit words of a filter: 16.8 million bits, some 10 MB as a broadcast table at most.
WORDS = 1 << 18


def _place(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words * 64))


def hash_bits(df: DataFrame, key: Column, words: int = WORDS) -> DataFrame:
    """(_word, _bits): the words of the bitmap that hold a key of ``df``; NULL is a key like any other."""
    place = df.select(_place(key, words).alias("at"))
    word = F.shiftright("at", 6).alias("_word")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 64).cast("int"))
    return place.groupBy(word).agg(F.bit_or(bit).alias("_bits"))


def may_hold(df: DataFrame, key: Column, bits: DataFrame, words: int = WORDS) -> DataFrame:
    """The rows of ``df`` whose key has its bit set in ``bits``, columns unchanged; no shuffle."""
    placed = df.withColumn("_at", _place(key, words)).withColumn("_word", F.shiftright("_at", 6))
    return (placed.join(F.broadcast(bits), "_word").where(F.getbit("_bits", F.col("_at") % 64) == 1)
            .select(*df.columns))
