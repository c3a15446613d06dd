"""Benchmark decontamination by spaced-seed hashing, DataFrame operations only.

A mask keeps some of consecutive words and ignores the rest, so a substituted
word hurts only the windows in which the mask keeps its position.  ``MASKS``
together hit every 20-word window with at most four substitutions; shorter
items have masks of their own size (:func:`masks_of`), so that at every size no
alteration within the default share is missed (checked exhaustively in the
tests).  Hashes of benchmark windows meet hashes of all document windows;
around each hit the words on the same diagonal are compared one by one.

A document leaks an item when some window of 20 consecutive item words (the
whole item when it is shorter), near a hit and on its diagonal, agrees with
the document in at least ``min_share`` of its positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlake.llm.common import materialize

MASKS = ((0, 5, 6, 7, 8), (0, 2, 4, 5, 8), (0, 3, 5, 7, 8))
SPAN = 9
#: A further mask of items with fewer than ``SHORT`` words.
SHORT_MASK = (0, 2, 3, 4, 7)
SHORT = 16
#: Masks of items under ``SPAN`` words: runs of words, no more than half such an item.
RUNS = ((0,), (0, 1), (0, 1, 2), (0, 1, 2, 3))
ALL_MASKS = (*MASKS, SHORT_MASK, *RUNS)
WINDOW = 20
STEP = 10
MIN_SHARE = 0.8

#: Benchmark windows that are broadcast at most (some 400 bytes each).  The
#: windows of a larger benchmark are joined by a shuffle instead.
BROADCAST_WINDOWS = 100_000

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased runs of letters, digits and non-ASCII characters; NULL: none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS, -1), "")


def masks_of(size: int) -> list[tuple[int, list[int] | None]]:
    """(number of the mask, item positions it is laid at or None for all) for items of ``size`` words.

    An item under ``SPAN`` words has room for one substitution at most, which
    spares its first or its second half; under five words there is no room and
    the whole item is one run.
    """
    if size >= SPAN:
        return [(k, None) for k in range(len(MASKS) + (size < SHORT))]
    runs = len(MASKS) + 1
    if size < 5:
        return [(runs + size - 1, [0])]
    half = size // 2
    return [(runs + half - 1, [0]), (runs + size - half - 1, [half])]


def _hash(ws: str, at: str, k: int) -> Column:
    """The mask's number keeps masks apart."""
    return F.xxhash64(F.lit(k), *[F.get(F.col(ws), F.col(at) + o) for o in ALL_MASKS[k]])


def _hashes(ws: str, at: str, wanted: dict[int, Column | None]) -> Column:
    """The hashes at word ``at`` of all masks (NULL where one doesn't fit); ``wanted`` has a condition for some."""
    room = F.size(ws) - F.col(at)
    each = []
    for k, when in wanted.items():
        fits = room > ALL_MASKS[k][-1]
        each.append(F.when(fits if when is None else fits & when, _hash(ws, at, k)))
    return F.explode(F.array(*each))  # no lambda here: the probe has to stay compiled


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return (benchmark.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("ws")).distinct()
            .where(F.size("ws") > 0))


def _masks_in_use(items: DataFrame) -> dict[int, Column | None]:
    """Masks that some item needs, with the condition on (item_size, item_at) under which an item has it."""
    short = [r[0] for r in items.where(F.size("ws") < SHORT).select(F.size("ws")).distinct().collect()]  # 15 numbers
    wanted: dict[int, Column | None] = {k: F.col("item_size") >= SPAN for k in range(len(MASKS))}
    for size in sorted(short):
        for k, places in masks_of(size):
            if k >= len(MASKS):
                here = F.col("item_size") == size
                if places is not None:
                    here &= F.col("item_at").isin(places)
                wanted[k] = (wanted[k] | here) if k in wanted else here
    return wanted


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                      wanted: dict[int, Column | None] | None = None) -> DataFrame:
    """hash, item_id, item_key, item_at of every masked window, with the item words around its block.

    Windows are blocked by ``STEP`` start positions; the words around a block
    reach far enough for any verification window around any of its hits.
    ``item_key`` tells apart texts that share an id.
    """
    items = (_items(benchmark, id_col, text_col)
             .withColumns({"item_key": F.xxhash64("ws"), "item_size": F.size("ws")}))
    if wanted is None:
        wanted = _masks_in_use(items)
    block = F.floor(F.col("item_at") / STEP).cast("int")
    start = F.greatest(F.lit(0), F.col("block") * STEP - (WINDOW - SPAN))
    stop = F.least(F.size("ws"), (F.col("block") + 1) * STEP + WINDOW)
    return (items.select("item_id", "item_key", "item_size", "ws",
                         F.explode(F.sequence(F.lit(0), F.size("ws") - 1)).alias("item_at"))
            .select("item_id", "item_key", "item_size", "ws", "item_at", block.alias("block"),
                    _hashes("ws", "item_at", wanted).alias("hash"))
            .where(F.col("hash").isNotNull())
            .select("hash", "item_id", "item_key", "item_at", "block", "item_size",
                    start.alias("start"), F.slice("ws", start + 1, stop - start).alias("item_part")))


def _best_overlap(window: int) -> Column:
    """Most agreeing positions of any window of ``item_part`` against ``doc_part``."""
    n = F.size("item_part")
    agree = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda j: F.when((j >= F.col("missing"))
                         & (F.get("doc_part", j - F.col("missing")) == F.get("item_part", j)), 1).otherwise(0))
    return F.array_max(F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), n - F.lit(window) + 1)),
        lambda s: F.aggregate(F.slice(agree, s, window), F.lit(0), lambda a, x: a + x)))


def _verified(hits: DataFrame, keys: list[str], min_share: float) -> DataFrame:
    """keys, overlap, window_words of the hits whose words agree well enough."""
    window = F.least(F.lit(WINDOW), F.col("item_size"))
    return (hits.select(*keys, _best_overlap(WINDOW).alias("overlap"), window.alias("window_words"))
            .where(F.col("overlap") >= F.ceil(F.lit(min_share) * F.col("window_words"))))


def _parts(shift: Column) -> list[Column]:
    """missing and doc_part: the document's words on the diagonal of ``item_part``."""
    first = F.greatest(F.lit(0), F.col("start") + shift)
    last = F.least(F.size("ws"), F.col("start") + shift + F.size("item_part"))
    return [(first - F.col("start") - shift).alias("missing"), F.slice("ws", first + 1, last - first).alias("doc_part")]


def _doc_windows(text: DataFrame, keys: list[str], wanted: dict[int, Column | None], *carried: str) -> DataFrame:
    """keys, carried, doc_at, hash of every masked window of every document."""
    masks = dict.fromkeys(wanted)
    shortest = min(ALL_MASKS[k][-1] for k in masks) + 1
    last = F.size("ws") - shortest
    return (text.select(*keys, "ws", F.explode(F.when(last >= 0, F.sequence(F.lit(0), last))).alias("doc_at"))
            .select(*keys, *carried, "doc_at", _hashes("ws", "doc_at", masks).alias("hash")))


def _by_broadcast(text: DataFrame, keys: list[str], seeds: DataFrame, wanted: dict[int, Column | None],
                  min_share: float) -> DataFrame:
    """One pass over the documents; no text is shuffled, hits carry only the words around them."""
    shift = F.col("doc_at") - F.col("item_at")
    at = _doc_windows(text, keys, wanted, "ws")
    hits = at.join(F.broadcast(seeds), "hash").select(
        *keys, "item_id", "item_key", "block", shift.alias("shift"), "item_size", "item_part", *_parts(shift))
    # A block's hits are the same row and verified once.  The item's size is an aggregate so that the filter on it,
    # whose lambdas are not compiled, stays above this step: rows with whole texts never leave the compiled probe.
    same = [c for c in hits.columns if c != "item_size"]
    once = hits.groupBy(*same).agg(F.max("item_size").alias("item_size"))
    return _verified(once, [*keys, "item_id"], min_share)


def _by_shuffle(text: DataFrame, keys: list[str], seeds: DataFrame, wanted: dict[int, Column | None],
                min_share: float) -> DataFrame:
    """Every distinct text once: its window hashes (with text key and position only) meet the seeds by a
    shuffle; hits fetch their words from the text and the item afterwards."""
    keyed = text.withColumn("text_md5", F.md5(F.concat_ws(" ", "ws")))
    texts = materialize(keyed.groupBy("text_md5").agg(F.first("ws").alias("ws")), "leak-texts")
    at = _doc_windows(texts, ["text_md5"], wanted)
    pairs = (at.join(seeds.select("hash", "item_id", "item_key", "item_at", "block"), "hash")
             .select("text_md5", "item_id", "item_key", "block", (F.col("doc_at") - F.col("item_at")).alias("shift"))
             .distinct())
    parts = seeds.select("item_key", "block", "item_size", "start", "item_part").distinct()
    hits = (pairs.join(parts, ["item_key", "block"]).join(texts, "text_md5")
            .select("text_md5", "item_id", "item_size", "item_part", *_parts(F.col("shift"))))
    found = (_verified(hits, ["text_md5", "item_id"], min_share)
             .groupBy("text_md5", "item_id", "window_words").agg(F.max("overlap").alias("overlap")))
    rows = keyed.select(*[k for k in keys if k != "doc_key"], "text_md5").distinct()
    return rows.join(found, "text_md5")


def leaks(docs: DataFrame, benchmark: DataFrame, min_share: float = MIN_SHARE,
          broadcast_windows: int = BROADCAST_WINDOWS,
          key_cols: tuple[str, ...] = ("doc_id",), text_col: str = "text",
          item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``key_cols``, item_id, overlap, window_words: one row per leaking document and item.

    Rows of ``docs`` with equal keys, and items of equal ids, are reported
    once with their best overlap.  NULL and empty texts never leak; neither
    does anything when the benchmark is empty.  A benchmark of more than
    ``broadcast_windows`` windows is joined by a shuffle, with the same result.
    """
    wanted = _masks_in_use(_items(benchmark, item_id_col, item_text_col))
    seeds = benchmark_windows(benchmark, item_id_col, item_text_col, wanted)
    # ``doc_key`` (which tells texts with equal keys apart) is computed before the words are exploded
    text = (docs.select(*key_cols, words(F.col(text_col)).alias("ws"))
            .withColumn("doc_key", F.xxhash64("ws")))
    small = seeds.count() <= broadcast_windows
    found = (_by_broadcast if small else _by_shuffle)(text, [*key_cols, "doc_key"], seeds, wanted, min_share)
    return (found.groupBy(*key_cols, "item_id")
            .agg(F.max(F.struct("overlap", (-F.col("window_words")).alias("shorter"))).alias("best"))
            .select(*key_cols, "item_id", (-F.col("best.shorter")).alias("window_words"), F.col("best.overlap")))


def drop_leaking(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **kw) -> DataFrame:
    """The rows that leak no item, all columns unchanged.

    Whether a row leaks depends on its text alone, so rows are told apart by
    the md5 of the text: NULL and repeated ids make no difference.
    """
    from tenderlake.llm.common import free_name
    key = free_name(docs, "_text_md5")
    keyed = docs.withColumn(key, F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    bad = leaks(keyed, benchmark, key_cols=(key,), text_col=text_col, **kw).select(key).distinct()
    return keyed.join(bad, key, "left_anti").drop(key)
