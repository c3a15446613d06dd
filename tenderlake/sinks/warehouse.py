"""Keyed parquet tables as immutable folders and published versions.

A table is a folder ``<root>/<layer>/<table>/``:

* ``data/<id>/`` holds files that one job wrote and nothing ever changes;
  tables written with a key have a sub-folder ``_bucket=<n>`` per hash bucket
  of the key (NULL keys in a bucket of their own).
* ``versions/<number>`` is a small text file that lists the folders a version
  consists of.  A version exists once this file does; it is written by the
  driver after the job has returned, in one create call.

Every write stages new folders first and publishes later, so checks can run
on rows nobody sees yet, and a failed or interrupted job leaves the current
version as it was.  An append adds a folder to the list.  An upsert reads and
rewrites only the buckets its batch falls into and carries all other folders
over by reference.

A table of which each batch touches most buckets can take its batches as they
come (``stage_pending``): the rows of such a batch are written once, without a
shuffle, and merged with the others of their key by whoever reads the table,
and for good by ``settle``, in one shuffle for any number of batches.

No update is lost to another writer: staged rows remember the version they were
staged from, and ``publish`` writes exactly the next one.  If the table has
moved on meanwhile, an append goes onto the newer version, an upsert too when
the other writer touched other buckets only; anything else raises
:class:`StaleWrite` (``append`` and ``upsert`` then merge anew).  Two writers
that publish in the same instant are told apart by the file system's
create-if-absent, which HDFS guarantees; on a store without it, one writer per
table.
"""

from __future__ import annotations

import json
import uuid
from importlib import import_module
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tenderlake.session import drop_scratch, hadoop_path, materialize, scratch_path

BUCKET = "_bucket"
NULL_BUCKET = -1

#: Hash buckets that a keyed table starts with.
BUCKETS = 16

#: Buckets are split once those that an upsert reads hold more bytes than this on
#: average, so that a batch costs by the buckets it falls into, however large the table.
BUCKET_BYTES = 1 << 30

#: Column of the shares that ``settle`` deals to tasks, several of each bucket.
SHARE = "_share"

#: Batches that a table keeps for its readers to merge before one settles them: at least so many,
#: if they hold as many bytes as the rest (so all rewrites add up to a few times the table) ...
PENDING = 8
#: ... and never more than so many.
MOST_PENDING = 128

#: Of data files: hashed keys, which snappy leaves as they are, take about half the space.
COMPRESSION = "zstd"

#: Times that an append or upsert is merged anew when other writers were faster.
ATTEMPTS = 5


class StaleWrite(RuntimeError):
    """The table has changed in a way that the staged rows don't take into account."""


@dataclass
class UpsertResult:
    version: int
    rows_in_batch: int
    null_keys_rejected: int
    buckets_rewritten: int = 0


@dataclass
class Staged:
    """Rows written but not yet visible; ``parts`` are [bucket or None, folder] pairs.

    ``base``: the version (0: none) and its parts that the rows were staged
    from; ``touched``: the buckets whose parts they replace (None: all).

    ``pending``: folders of batches that are not merged yet.  ``merge`` names
    (module:function) what chooses among the rows of a key.  ``key_sql``: the
    key as an expression of the other columns; such batches don't store it.
    """
    layer: str
    table: str
    schema: StructType
    key: str | None
    buckets: int
    parts: list[list]
    base: int = 0
    base_parts: list[list] = field(default_factory=list)
    touched: set[int | None] | None = None
    result: UpsertResult = field(default_factory=lambda: UpsertResult(-1, -1, 0))
    pending: list[str] = field(default_factory=list)
    base_pending: list[str] = field(default_factory=list)
    merge: str | None = None
    key_sql: str | None = None


def bucket_of(key: str, buckets: int) -> Column:
    k = F.col(key)
    return F.when(k.isNull(), NULL_BUCKET).otherwise(F.pmod(F.xxhash64(k), F.lit(buckets))).cast("int")


def _keyless(parts: list[list]) -> list[list]:
    return [p for p in parts if p[0] == NULL_BUCKET]


def _function(name: str) -> Callable[..., DataFrame]:
    module, function = name.split(":")
    return getattr(import_module(module), function)


def upsert_frame(target: DataFrame, batch: DataFrame, key: str, distinct: bool = True) -> DataFrame:
    """Target rows whose key is not in the batch, plus the distinct batch rows.

    Batch rows with a NULL key are left out: a NULL key never matches the
    delete, so inserting it would add one more NULL-key row per run.  Target
    rows with a NULL key are kept (NULL never equals a batch key) and bypass
    the join, where they would all hash to one reducer.  Columns are matched
    by name; the result has the target's column order.  ``distinct=False``
    skips the whole-row de-duplication (a shuffle of the batch) for batches
    that are already one row per key.
    """
    k = F.col(key)
    insert = batch.select(*target.columns).where(k.isNotNull())
    kept = target.where(k.isNotNull()).join(insert.select(key), on=key, how="left_anti").select(*target.columns)
    return (target.where(k.isNull()).unionByName(kept)
            .unionByName(insert.distinct() if distinct else insert))


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS, bucket_bytes: int = BUCKET_BYTES):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.bucket_bytes = bucket_bytes

    # -- paths and versions ------------------------------------------------
    def location(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def _names(self, path: str) -> list[str]:
        fs, p = hadoop_path(self.spark, path)
        return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []

    def versions(self, layer: str, table: str) -> list[int]:
        return [int(n) for n in self._names(f"{self.location(layer, table)}/versions") if n.isdigit()]

    def current(self, layer: str, table: str) -> int | None:
        v = self.versions(layer, table)
        return v[-1] if v else None

    def exists(self, layer: str, table: str) -> bool:
        return self.current(layer, table) is not None

    def _manifest(self, layer: str, table: str, version: int) -> Staged:
        fs, p = hadoop_path(self.spark, f"{self.location(layer, table)}/versions/{version:06d}")
        stream = fs.open(p)
        try:
            text = bytes(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()
        m = json.loads(text)
        return Staged(layer, table, StructType.fromJson(m["schema"]), m["key"], m["buckets"], m["parts"],
                      pending=m.get("pending", []), merge=m.get("merge"), key_sql=m.get("key_sql"))

    def rebased(self, staged: Staged) -> Staged:
        """``staged`` on top of the table's current version; raises :class:`StaleWrite` if it doesn't fit there."""
        v = self.current(staged.layer, staged.table) or 0
        if v == staged.base:
            return staged
        name = f"{staged.layer}.{staged.table}"
        if staged.touched is None:
            raise StaleWrite(f"{name} is at version {v}, the new content was staged from version {staged.base}")
        now = self._manifest(staged.layer, staged.table, v)
        fresh = [p for p in staged.parts if p not in staged.base_parts]
        in_buckets = staged.touched or fresh  # a pending batch is in none, however many there are by now
        if (now.schema, now.key) != (staged.schema, staged.key) or in_buckets and now.buckets != staged.buckets:
            raise StaleWrite(f"{name} has another layout since version {staged.base}")

        def of_touched(parts: list[list]) -> list[list]:
            return sorted(p for p in parts if p[0] in staged.touched)

        if of_touched(now.parts) != of_touched(staged.base_parts):
            raise StaleWrite(f"{name}: another writer changed the same buckets since version {staged.base}")
        kept = [p for p in now.parts if p[0] not in staged.touched]
        pending = now.pending + [p for p in staged.pending if p not in staged.base_pending]
        return replace(staged, base=v, base_parts=now.parts, parts=kept + fresh, buckets=now.buckets, pending=pending,
                       base_pending=now.pending, merge=staged.merge or now.merge, key_sql=staged.key_sql or now.key_sql)

    def publish(self, staged: Staged) -> int:
        """Make staged rows the table's next version, on top of whatever other writers published meanwhile."""
        for attempt in range(ATTEMPTS):
            at = self.rebased(staged)
            text = json.dumps({"schema": at.schema.jsonValue(), "key": at.key, "buckets": at.buckets,
                               "parts": at.parts, "pending": at.pending, "merge": at.merge, "key_sql": at.key_sql})
            fs, p = hadoop_path(self.spark, f"{self.location(at.layer, at.table)}/versions/{at.base + 1:06d}")
            try:
                out = fs.create(p, False)
            except Py4JJavaError as e:
                if "AlreadyExists" not in str(e.java_exception) or attempt == ATTEMPTS - 1:
                    raise
                continue
            try:
                out.write(bytearray(text.encode()))
            finally:
                out.close()
            staged.result.version = at.base + 1
            return at.base + 1
        raise StaleWrite(f"{staged.layer}.{staged.table}")

    def _retried(self, stage: Callable[[], Staged]) -> Staged:
        """Stage and publish, anew when another writer changed the same buckets."""
        for attempt in range(ATTEMPTS):
            staged = stage()
            try:
                self.publish(staged)
                return staged
            except StaleWrite:
                if attempt == ATTEMPTS - 1:
                    raise
        raise StaleWrite("never reached")

    # -- read ----------------------------------------------------------------
    def _rows(self, layer: str, table: str, schema: StructType, parts: list[list]) -> DataFrame:
        base = f"{self.location(layer, table)}/data"
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{base}/{folder}" for _, folder in parts])

    def preview(self, staged: Staged) -> DataFrame:
        """What the table will hold once ``staged`` is published."""
        if not staged.pending:
            return self._rows(staged.layer, staged.table, staged.schema, staged.parts)
        merged = _function(staged.merge)(self._unmerged(staged)).select(*staged.schema.fieldNames())
        keyless = _keyless(staged.parts)
        return (merged.unionByName(self._rows(staged.layer, staged.table, staged.schema, keyless)) if keyless else merged)

    def _unmerged(self, staged: Staged) -> DataFrame:
        """Rows with a key: the merged ones and those of pending batches together."""
        base = f"{self.location(staged.layer, staged.table)}/data"
        late = self.spark.read.schema(staged.schema).parquet(*[f"{base}/{folder}" for folder in staged.pending])
        if staged.key_sql:
            late = late.withColumn(staged.key, F.expr(staged.key_sql))
        parts = [p for p in staged.parts if p not in _keyless(staged.parts)]
        return self._rows(staged.layer, staged.table, staged.schema, parts).unionByName(late) if parts else late

    def read(self, layer: str, table: str, schema: StructType | None = None) -> DataFrame:
        """SRC-9: the current version of a table (empty with ``schema`` if none)."""
        v = self.current(layer, table)
        if v is None:
            if schema is None:
                raise FileNotFoundError(f"{layer}.{table} has no published version")
            return self.spark.createDataFrame([], schema)
        return self.preview(self._manifest(layer, table, v))

    # -- write ---------------------------------------------------------------
    def _write(self, df: DataFrame, layer: str, table: str, key: str | None, buckets: int,
               dealt: bool = False) -> list[list]:
        """Write rows to a new folder; its parts.  ``dealt``: tasks hold rows of few buckets each already."""
        new = uuid.uuid4().hex
        path = f"{self.location(layer, table)}/data/{new}"
        if key is None:
            df.write.mode("errorifexists").parquet(path, compression=COMPRESSION)
            return [[None, new]]
        # rebalancing by bucket gives few files per bucket and splits a bucket that is large
        rows = df.withColumn(BUCKET, bucket_of(key, buckets))
        ((rows if dealt else rows.hint("rebalance", BUCKET)).write.mode("errorifexists").partitionBy(BUCKET).parquet(path, compression=COMPRESSION))
        folders = [n for n in self._names(path) if n.startswith(f"{BUCKET}=")]
        return [[int(n.split("=")[1]), f"{new}/{n}"] for n in folders]

    def _base(self, layer: str, table: str) -> tuple[int, Staged | None]:
        v = self.current(layer, table)
        return (0, None) if v is None else (v, self._manifest(layer, table, v))

    def stage(self, df: DataFrame, layer: str, table: str, key: str | None = None,
              buckets: int | None = None) -> Staged:
        """Write a whole new content for a table, in buckets of ``key`` if given."""
        base = self.current(layer, table) or 0  # before the rows are read
        n = buckets or self.buckets
        return Staged(layer, table, df.schema, key, n, self._write(df, layer, table, key, n), base)

    def overwrite(self, df: DataFrame, layer: str, table: str, key: str | None = None) -> int:
        """SNK-1: replace the table's content with ``df`` (new version)."""
        return self.publish(self.stage(df, layer, table, key))

    def rebucket(self, layer: str, table: str, buckets: int) -> int:
        """Spread a table that grew by appends over more buckets (upserts split buckets by themselves)."""
        self.settle(layer, table)
        _, old = self._base(layer, table)
        return self.publish(self.stage(self.preview(old), layer, table, old.key, buckets))

    def stage_append(self, df: DataFrame, layer: str, table: str) -> Staged:
        self.settle(layer, table)
        v, old = self._base(layer, table)
        if old is None:
            return self.stage(df, layer, table)
        missing = set(old.schema.fieldNames()) - set(df.columns)
        if missing:
            raise ValueError(f"append to {layer}.{table}: batch lacks columns {sorted(missing)}")
        new = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in old.schema.fields])
        parts = old.parts + self._write(new, layer, table, old.key, old.buckets)
        return Staged(layer, table, old.schema, old.key, old.buckets, parts, v, old.parts, set())

    def append(self, df: DataFrame, layer: str, table: str) -> int:
        """SNK-4: add rows as a new version of the old folders and one more,
        columns matched by name (never by position)."""
        return self._retried(lambda: self.stage_append(df, layer, table)).result.version

    def stage_upsert(self, batch: DataFrame, layer: str, table: str, key: str, distinct: bool = True,
                     merge: Callable[[DataFrame], DataFrame] | None = None) -> Staged:
        """SNK-2: delete target rows whose key is in the batch and insert the
        distinct batch rows, in the buckets the batch falls into.

        ``merge`` decides instead between old and new rows of a key: it gets
        the old and new rows of the touched buckets together and returns the
        rows to keep.  NULL-key batch rows are rejected and counted.  A table
        without buckets of this key is rewritten once, into buckets; so is one
        whose touched buckets are larger than ``bucket_bytes`` on average, into
        twice as many (or four, eight ... times), which adds up to a few
        rewrites of its final size at most.
        """
        self.settle(layer, table)
        v, old = self._base(layer, table)
        if old is None or not old.parts:
            return self._first_upsert(batch, layer, table, key, distinct, batch.schema if old is None else old.schema, v)
        path = scratch_path(self.spark, f"upsert-{table}")
        rows = materialize(batch, f"upsert-{table}", path)
        try:
            buckets = old.buckets
            # one row, with a number per bucket at most, reaches the driver
            seen = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(key).isNull()).alias("rejected"),
                            F.collect_set(bucket_of(key, buckets)).alias("found")).first()
            found = set(seen["found"]) - {NULL_BUCKET}
            bucketed = old.key == key
            touched = [p for p in old.parts if not bucketed or p[0] in found]
            if bucketed and (times := self._split(layer, table, touched, len(found))) > 1:
                bucketed, buckets, touched = False, buckets * times, old.parts
            carried = [p for p in old.parts if p not in touched]
            target = self._rows(layer, table, old.schema, touched)
            fresh = rows.where(F.col(key).isNotNull())
            if merge is not None:
                keep_null = target.where(F.col(key).isNull())
                new = keep_null.unionByName(merge(target.where(F.col(key).isNotNull())
                                                  .unionByName(fresh.select(*target.columns))))
            else:
                new = upsert_frame(target, fresh, key, distinct)
            parts = carried + (self._write(new, layer, table, key, buckets) if found or touched else [])
            result = UpsertResult(-1, seen["n"], seen["rejected"], len(found) if bucketed else buckets)
            return Staged(layer, table, old.schema, key, buckets, parts, v, old.parts,
                          found if bucketed else None, result)
        finally:
            drop_scratch(self.spark, path)

    def stage_pending(self, batch: DataFrame, layer: str, table: str, key: str,
                      merge: Callable[..., DataFrame], key_sql: str | None = None) -> Staged:
        """SNK-2 for batches that fall into most buckets: write the rows as they come, to be merged by readers.

        ``merge`` (a module's function) decides between the rows of a key as in ``stage_upsert``; given the name of
        a column that follows from the key, it chooses within the groups of that column.  The rows are not counted, and a NULL key is
        left out.  Now and then (``PENDING``) the batches so far are settled first.
        """
        v, old = self._base(layer, table)
        name = f"{merge.__module__}:{merge.__qualname__}"
        if old is not None and (self._many_pending(old) or old.pending
                                and (old.key, old.merge, old.key_sql) != (key, name, key_sql)):
            self.settle(layer, table)
            v, old = self._base(layer, table)
        if old is not None and old.key != key:
            self._retried(lambda: self._stage_rekeyed(layer, table, key))
            v, old = self._base(layer, table)
        now = old or Staged(layer, table, batch.schema, key, self.buckets, [])
        new = uuid.uuid4().hex
        rows = (batch.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in now.schema.fields])
                .where(F.col(key).isNotNull()))
        (rows.drop(key) if key_sql else rows).write.mode("errorifexists").parquet(
            f"{self.location(layer, table)}/data/{new}", compression=COMPRESSION)
        return Staged(layer, table, now.schema, key, now.buckets, now.parts, v, now.parts, set(),
                      pending=now.pending + [new], base_pending=now.pending, merge=name, key_sql=key_sql)

    def _stage_rekeyed(self, layer: str, table: str, key: str) -> Staged:
        v, old = self._base(layer, table)
        return replace(self.stage(self.preview(old), layer, table, key), base=v)

    def _many_pending(self, old: Staged) -> bool:
        if len(old.pending) < PENDING:
            return False
        return (len(old.pending) >= MOST_PENDING or self._bytes(old.layer, old.table, old.pending)
                >= self._bytes(old.layer, old.table, [folder for _, folder in old.parts]))

    def settle(self, layer: str, table: str) -> int | None:
        """Merge the pending batches of a table, if any, into its buckets; the new version."""
        v, old = self._base(layer, table)
        if old is None or not old.pending:
            return None
        return self._retried(lambda: self._stage_settled(layer, table)).result.version

    def _stage_settled(self, layer: str, table: str) -> Staged:
        v, old = self._base(layer, table)
        folders = old.parts + [[None, f] for f in old.pending]
        buckets = old.buckets * self._split(layer, table, folders, old.buckets)
        # a share is a part of one bucket: rows of a key meet in one shuffle, and a task writes to a few buckets only
        shares = buckets * -(-4 * int(self.spark.conf.get("spark.sql.shuffle.partitions")) // buckets)
        rows = self._unmerged(old).withColumn(SHARE, bucket_of(old.key, shares))
        merged = _function(old.merge)(rows.repartition(SHARE), SHARE).select(*old.schema.fieldNames())
        parts = _keyless(old.parts) + self._write(merged, layer, table, old.key, buckets, dealt=True)
        return Staged(layer, table, old.schema, old.key, buckets, parts, v, old.parts)

    def _bytes(self, layer: str, table: str, folders: list[str]) -> int:
        size = 0
        for folder in folders:
            fs, p = hadoop_path(self.spark, f"{self.location(layer, table)}/data/{folder}")
            size += fs.getContentSummary(p).getLength()
        return size

    def _split(self, layer: str, table: str, parts: list[list], buckets: int) -> int:
        """How many buckets (a power of two) to make of each, by the average size of ``buckets`` ones with these parts."""
        size = self._bytes(layer, table, [folder for _, folder in parts])
        times = 1
        while size > times * buckets * self.bucket_bytes:
            times *= 2
        return times

    def _first_upsert(self, batch: DataFrame, layer: str, table: str, key: str, distinct: bool,
                      schema: StructType, base: int) -> Staged:
        """Into an empty table: nothing to match, so the batch is written as it comes (counted on the way)."""
        seen = Observation(f"{layer}.{table}")
        counted = batch.select(*schema.fieldNames()).observe(
            seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(key).isNull()).alias("rejected"))
        fresh = counted.where(F.col(key).isNotNull())
        parts = self._write(fresh.distinct() if distinct else fresh, layer, table, key, self.buckets)
        # inside a stream's batch function the metrics don't reach the observation: -1
        m = {} if self._in_stream() else seen.get
        result = UpsertResult(-1, int(m.get("rows", -1)), int(m.get("rejected", -1)), len(parts))
        return Staged(layer, table, schema, key, self.buckets, parts, base, result=result)

    def _in_stream(self) -> bool:
        return self.spark.sparkContext.getLocalProperty("sql.streaming.queryId") is not None

    def upsert(self, batch: DataFrame, layer: str, table: str, key: str, distinct: bool = True,
               merge: Callable[[DataFrame], DataFrame] | None = None) -> UpsertResult:
        return self._retried(lambda: self.stage_upsert(batch, layer, table, key, distinct, merge)).result

    def vacuum(self, layer: str, table: str, keep: int = 2) -> list[int]:
        """Delete all but the newest ``keep`` versions and every data folder no
        kept version lists (those of failed writes included).  Not to be run
        while another job writes the table."""
        vs = self.versions(layer, table)
        kept = vs[-keep:] if keep > 0 else []
        gone = [v for v in vs if v not in kept]
        base = self.location(layer, table)
        for v in gone:
            fs, p = hadoop_path(self.spark, f"{base}/versions/{v:06d}")
            fs.delete(p, False)
        manifests = [self._manifest(layer, table, v) for v in kept]
        used = {f for m in manifests for f in [folder for _, folder in m.parts] + m.pending}
        for name in self._names(f"{base}/data"):
            if not any(u == name or u.startswith(f"{name}/") for u in used):
                fs, p = hadoop_path(self.spark, f"{base}/data/{name}")
                fs.delete(p, True)
                continue
            for sub in self._names(f"{base}/data/{name}"):
                if sub.startswith(f"{BUCKET}=") and f"{name}/{sub}" not in used:
                    fs, p = hadoop_path(self.spark, f"{base}/data/{name}/{sub}")
                    fs.delete(p, True)
        return gone
