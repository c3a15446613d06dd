"""Fixed virtual slots: records hash into slots, a versioned map names shards.

A record's slot depends on its id only, and the map of version 0 on the slot
and shard counts only.  Growing by a shard moves slots into the new shard and
nowhere else.  Bytes are aggregated per slot, and ``rebalanced`` edits the map by
them (moves slots from heavy shards to light ones); ``shard`` stores the result
as a further version and places every record under each.  The number of slots
is a constant, so maps are driver-sized lists at any data size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenderlake.llm.common import text_or_empty

N_SLOTS = 8192
#: Parts that the slot of NULL ids is ranked in (all other slots hold few ids each).
NULL_LANES = 256


def grown(owners: list[int]) -> list[int]:
    """One more shard: it takes its even share of slots from the fullest shards."""
    new, out = max(owners) + 1, list(owners)
    held: list[list[int]] = [[] for _ in range(new)]
    for slot, shard in enumerate(out):
        held[shard].append(slot)
    for _ in range(len(out) // (new + 1)):
        out[max(held, key=len).pop()] = new
    return out


def initial_map(n_shards: int, n_slots: int = N_SLOTS) -> list[int]:
    """Owner of each slot, grown shard by shard so that any two counts nest."""
    owners = [0] * n_slots
    for _ in range(n_shards - 1):
        owners = grown(owners)
    return owners


def rebalanced(owners: list[int], slot_bytes: dict[int, int]) -> list[int]:
    """Edit a map: move slots from the heaviest shard to the lightest while that narrows the gap."""
    out, n = list(owners), max(owners) + 1
    load, held = [0] * n, [[] for _ in range(n)]
    for slot, shard in enumerate(out):
        load[shard] += slot_bytes.get(slot, 0)
        held[shard].append(slot)
    for _ in range(len(out)):
        hi, lo = max(range(n), key=load.__getitem__), min(range(n), key=load.__getitem__)
        gap = load[hi] - load[lo]
        fits = [s for s in held[hi] if 0 < slot_bytes.get(s, 0) < gap]
        if not fits:
            break
        s = min(fits, key=lambda x: abs(gap / 2 - slot_bytes[x]))
        held[hi].remove(s)
        held[lo].append(s)
        load[hi] -= slot_bytes[s]
        load[lo] += slot_bytes[s]
        out[s] = lo
    return out


def store_map(spark: SparkSession, owners: list[int], path: str, version: int) -> None:
    """Write one version of the map; an existing version is never overwritten."""
    rows = [(slot, shard) for slot, shard in enumerate(owners)]
    (spark.createDataFrame(rows, "vslot int, shard int").coalesce(1)
     .write.mode("errorifexists").parquet(f"{path}/version={version}"))


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema("vslot int, shard int").parquet(f"{path}/version={version}")


def records(docs: DataFrame, n_slots: int = N_SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, vslot of each row.  NULL text: no bytes; NULL id: one fixed slot."""
    raw = text_or_empty(text_col).cast("binary")
    return docs.select(F.col(id_col).alias("doc_id"),
                       (F.octet_length(raw) + F.lit(8)).cast("bigint").alias("size"),
                       F.crc32(raw).alias("text_crc32"),
                       F.pmod(F.xxhash64(F.col(id_col)), F.lit(n_slots)).cast("int").alias("vslot"))


def bytes_per_slot(recs: DataFrame) -> DataFrame:
    return recs.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def assign_shards(recs: DataFrame, slot_map: DataFrame, grown_map: DataFrame) -> DataFrame:
    """Shard, gapless place in the shard and shard under the grown map.

    ``slot_map`` / ``grown_map`` have one row per virtual slot (a constant
    count), hence the broadcast.  Places: virtual slots in order, inside one
    by id; equal rows collapse to a count first, so repeated rows neither meet
    in one sort nor share a place.  Rows without an id share a slot, which is
    ranked in ``NULL_LANES`` parts by the text's checksum.
    """
    both = slot_map.join(F.broadcast(grown_map.withColumnRenamed("shard", "grown_shard")), "vslot")
    lane = F.when(F.col("doc_id").isNull(), 1 + F.col("text_crc32") % NULL_LANES).otherwise(0).cast("int")
    recs = recs.withColumn("lane", lane)
    cells = recs.groupBy("vslot", "lane", "doc_id", "size", "text_crc32").agg(F.count("*").alias("copies"))
    totals = recs.groupBy("vslot", "lane").agg(F.count("*").alias("rows"))
    by_shard = Window.partitionBy("shard").orderBy("vslot", "lane").rowsBetween(Window.unboundedPreceding, -1)
    starts = (both.join(totals, "vslot")
              .withColumn("start", F.coalesce(F.sum("rows").over(by_shard), F.lit(0)))
              .select("vslot", "lane", *[c for c in both.columns if c != "vslot"], "start"))
    in_lane = (Window.partitionBy("vslot", "lane").orderBy("doc_id", "size", "text_crc32")
               .rowsBetween(Window.unboundedPreceding, -1))
    extra = [c for c in both.columns if c not in ("vslot", "shard", "grown_shard")]
    return (cells.withColumn("before", F.coalesce(F.sum("copies").over(in_lane), F.lit(0)))
            .join(F.broadcast(starts), ["vslot", "lane"])
            .withColumn("i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)))
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("start") + F.col("before") + F.col("i")).alias("slot"), "grown_shard", *extra))


def shard(docs: DataFrame, n_shards: int, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store the slot map under ``path`` and place every row of ``docs``.

    Version 0 has ``n_shards`` shards, version 1 one more, and version 2 is
    version 0 rebalanced by the bytes that its slots hold.  Columns as
    ``assign_shards``, and ``rebalanced_shard``: the shard under version 2.
    """
    spark = docs.sparkSession
    owners = initial_map(n_shards)
    recs = records(docs, id_col=id_col, text_col=text_col)
    weight = {r["vslot"]: r["bytes"] for r in bytes_per_slot(recs).collect()}  # a row per slot
    for version, m in enumerate((owners, grown(owners), rebalanced(owners, weight))):
        store_map(spark, m, path, version)
    edited = load_map(spark, path, 2).withColumnRenamed("shard", "rebalanced_shard")
    slots = load_map(spark, path, 0).join(F.broadcast(edited), "vslot")
    return assign_shards(recs, slots, load_map(spark, path, 1))
