"""Keyed incremental loads: high-watermark slice, schema sync, upsert.

The stored table is a directory of immutable versions plus one commit record
per version (see ``VersionedTable``): an upsert writes the merged rows to a new
folder and only then adds its record.  Nothing that a reader may see is ever
overwritten, so a job that dies between any two steps leaves the last good
version readable.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dedup import latest_per_key

EPOCH = "1970-01-01 00:00:00"


def _ts(c: str, df: DataFrame) -> Column:
    """The column as TIMESTAMP; text is parsed leniently, typed columns stay."""
    t = df.schema[c].dataType
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return F.col(c).cast("timestamp")
    return F.col(c).try_cast("timestamp")


def watermark(target: DataFrame, wm_col: str) -> Column:
    """``(SELECT MAX(wm_col) FROM target)`` as a scalar subquery column."""
    return target.agg(F.max(F.col(wm_col)).cast("timestamp").alias("wm")).scalar()


def incremental_slice(df: DataFrame, ts_col: str, target: DataFrame | None, wm_col: str,
                      empty_target: str = "all", by: str | None = None,
                      inclusive: bool = False) -> DataFrame:
    """Rows newer than the target's high watermark.

    ``target=None`` is a first run: everything.  With an existing but empty
    target ``empty_target="all"`` compares with the epoch (all rows), while
    ``"none"`` keeps the plain SQL rule ``ts > NULL``, which selects nothing.

    ``by`` keeps one watermark per value of that column (compared trimmed and
    in upper case), so a source that lands late is not cut off by the others;
    a value that the target does not hold yet has no watermark.  ``inclusive``
    takes rows of the watermark's own instant again, for targets whose merge
    is idempotent: a loader may stamp several batches with one instant.

    Without ``by`` the watermark is one scalar subquery, compared in the scan's
    filter; with it, a few rows (one per source) that are joined.
    """
    if target is None:
        return df
    ts = _ts(ts_col, df)
    if by is None:
        wm = watermark(target, wm_col)
        if empty_target == "all":
            wm = F.coalesce(wm, F.lit(EPOCH).cast("timestamp"))
        return df.filter(ts >= wm if inclusive else ts > wm)
    key = F.upper(F.trim(F.col(by).cast("string")))
    marks = target.groupBy(key.alias("__by")).agg(F.max(F.col(wm_col).cast("timestamp")).alias("__wm"))
    out = df.withColumn("__key", key).join(marks, F.col("__key").eqNullSafe(F.col("__by")), "left")
    wm = F.col("__wm")
    if empty_target == "all":
        wm = F.coalesce(wm, F.lit(EPOCH).cast("timestamp"))
    return out.filter(ts >= wm if inclusive else ts > wm).select(*[F.col(f"`{c}`") for c in df.columns])


def region_marks(target: DataFrame | None, wm_col: str, by: str) -> dict[str, object] | None:
    """Newest instant per value of ``by`` (trimmed, upper case); None without a
    target.  One small row per source reaches the driver."""
    if target is None:
        return None
    rows = target.groupBy(F.upper(F.trim(F.col(by).cast("string"))).alias("by")).agg(F.max(F.col(wm_col).cast("timestamp")).alias("wm")).collect()
    return {r["by"]: r["wm"] for r in rows}


def partitions_since(df: DataFrame, marks: dict[str, object] | None, by: str, day: str) -> DataFrame:
    """Rows of the day partitions that can hold rows as new as their source's mark.

    ``by`` and ``day`` are partition columns and the marks are literals, so the
    other folders are neither listed in the plan's files nor read.  Sources
    without a mark, and rows without a day, stay.
    """
    if not marks:
        return df
    source = F.upper(F.trim(F.col(by).cast("string")))
    new = F.col(day).isNull() | F.col(by).isNull() | ~source.isin([k for k in marks if k is not None])
    for k, wm in marks.items():
        if k is not None:
            new = new | ((source == k) & (F.lit(True) if wm is None else F.col(day) >= F.lit(wm).cast("date")))
    return df.where(new)


def sync_columns(target: DataFrame, schema: T.StructType) -> DataFrame:
    """``target`` re-shaped to ``schema``: new columns NULL, vanished ones dropped,
    common ones cast to the new type."""
    have = set(target.columns)
    cols = []
    for f in schema.fields:
        if f.name in have:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return target.select(*cols)


def upsert(target: DataFrame | None, updates: DataFrame, keys: Sequence[str],
           sync_schema: bool = True, collapse_order: Sequence | None = None) -> DataFrame:
    """A new row replaces the stored row with the same key, else it is appended.

    ``target`` rows whose key appears in ``updates`` are removed with a LEFT
    ANTI join on the keys (only the key columns of the batch are shuffled, or
    broadcast by AQE when the batch is small) and the batch is appended.
    ``collapse_order`` first reduces a batch that repeats a key to its latest
    row; without it the caller guarantees unique keys.  Key columns compare
    NULL-safe, so loading a row again replaces it whatever its key holds.
    """
    if collapse_order is not None:
        updates = latest_per_key(updates, keys, collapse_order)
    if target is None:
        return updates
    if sync_schema:
        target = sync_columns(target, updates.schema)
    else:
        updates = updates.select(*target.columns)
    batch_keys = updates.select(*keys)
    cond = None
    for k in keys:
        e = target[k].eqNullSafe(batch_keys[k])
        cond = e if cond is None else (cond & e)
    kept = target.join(batch_keys, cond, "left_anti")
    return kept.unionByName(updates)


#: Buckets of key hashes told apart by ``upsert_stored``: its broadcast set holds at most so many numbers.
BUCKETS = 1 << 20


def upsert_stored(target: DataFrame, updates: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """``upsert`` of a stored batch into a stored table, most of whose rows stay as they are.

    Hashes of the keys alone are joined first.  Rows in whose bucket of hashes none is in the
    batch, too, stay where they are; only the others are shuffled and compared with
    the batch's keys.  Both tables are read several times.  The rows are those of ``upsert``.
    """
    target = sync_columns(target, updates.schema)
    if any(isinstance(updates.schema[k].dataType, (T.FloatType, T.DoubleType)) or not _plain(updates.schema[k].dataType) for k in keys):
        return upsert(target, updates, keys)  # equal keys may hash apart
    key = F.xxhash64(*[F.col(k) for k in keys])
    bucket = lambda h: F.coalesce(F.pmod(h, F.lit(buckets)), F.lit(0))  # noqa: E731  never null
    old, new = target.select(key.alias("__h")), updates.select(key.alias("__h2"))
    both = old.join(new, F.col("__h") == F.col("__h2"), "left_semi").select(bucket(F.col("__h")).alias("__hit")).distinct()
    marked = target.withColumn("__b", bucket(key))
    on = F.col("__b") == F.col("__hit")
    rest = marked.join(F.broadcast(both), on, "left_anti").drop("__b")
    return rest.unionByName(upsert(marked.join(F.broadcast(both), on, "left_semi").drop("__b"), updates, keys))


def _plain(t: T.DataType) -> bool:
    """Types of which equal values have equal bytes."""
    if isinstance(t, T.StringType):
        return t == T.StringType()
    return isinstance(t, (T.IntegralType, T.DecimalType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType))


def changed_rows(batch: DataFrame, stored: DataFrame | None, ignore: Sequence[str] = ()) -> DataFrame:
    """The rows of a batch that a merge would change or add: those without an
    equal stored row (in all columns but ``ignore``).

    Joined on a hash of the columns, then compared in full.
    """
    if stored is None:
        return batch
    cols = [c for c in batch.columns if c not in ignore]
    if any(c not in stored.columns for c in cols):
        return batch
    digest = F.xxhash64(*[F.col(f"`{c}`") for c in cols])
    old = stored.select(digest.alias("__hash"), F.struct(*[F.col(f"`{c}`") for c in cols]).alias("__old"))
    new = batch.withColumn("__own", digest)
    same = (F.col("__own") == F.col("__hash")) & F.struct(*[new[f"`{c}`"] for c in cols]).eqNullSafe(F.col("__old"))
    return new.join(old, same, "left_anti").drop("__own")


class VersionedTable:
    """Parquet versions in ``<path>/data`` and one commit record each in ``<path>/log``.

    A version's folder has a name of its own and is never written again; its
    record (one row: version, folder, and the epoch of the stream's batch, if
    any) is written last, under the next free number and without overwriting, so
    of two writers that publish at once one fails.  The newest record names the
    current version.  What a writer that died left of a record counts as none,
    and its number is not used again.
    """

    RECORD = "version long, folder string, epoch long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _log(self) -> DataFrame | None:
        from ..session import read_parquet_or_none
        return read_parquet_or_none(self.spark, f"{self.path}/log/*", self.RECORD)

    def _current(self):
        log = self._log()
        return None if log is None else log.orderBy(F.desc("version")).first()

    def current_version(self) -> int | None:
        row = self._current()
        return None if row is None else row["version"]

    def read(self, version: int | None = None) -> DataFrame | None:
        """The current version, or an older one that is still kept."""
        row = self._current() if version is None else self._log().where(F.col("version") == version).first()
        return None if row is None else self.spark.read.parquet(f"{self.path}/data/{row['folder']}")

    def has_epoch(self, epoch: int) -> bool:
        """Whether a stream's batch of this epoch is in the table."""
        log = self._log()
        return log is not None and not log.where(F.col("epoch") == epoch).isEmpty()

    def commit(self, df: DataFrame, partition_by: Sequence[str] = (), epoch: int | None = None,
               unique: Sequence[str] | None = None) -> int:
        """Write a version and publish it; with ``unique`` only if no two of its rows share these keys."""
        from ..session import PACKED, child_names, delete_path
        from .staged import shuffles_freed
        v = max([int(n) for n in child_names(self.spark, f"{self.path}/log") if n.isdigit()], default=0) + 1
        folder = f"v{v}-{uuid.uuid4().hex[:12]}"
        w = df.write.mode("error").options(**PACKED)
        if partition_by:
            w = w.partitionBy(*partition_by)
        with shuffles_freed(self.spark):
            w.parquet(f"{self.path}/data/{folder}")
        if unique is not None:
            try:
                require_unique(self.spark.read.schema(df.schema).parquet(f"{self.path}/data/{folder}"), unique)
            except ValueError:
                delete_path(self.spark, f"{self.path}/data/{folder}")
                raise
        self._publish(v, folder, epoch)
        return v

    def _publish(self, v: int, folder: str, epoch: int | None = None) -> None:
        (self.spark.createDataFrame([(v, folder, epoch)], self.RECORD)
             .coalesce(1).write.mode("error").parquet(f"{self.path}/log/{v:012d}"))

    def vacuum(self, keep: int = 2) -> list[int]:
        """Delete all but the newest ``keep`` versions; the deleted ones.  For
        times when no reader still uses them."""
        from ..session import delete_path
        log = self._log()
        rows = [] if log is None else sorted(map(tuple, log.select("version", "folder").collect()))
        gone = rows[:-keep] if keep > 0 else []
        for v, folder in gone:  # the record first: it never names a folder that is gone
            delete_path(self.spark, f"{self.path}/log/{v:012d}")
            delete_path(self.spark, f"{self.path}/data/{folder}")
        return [v for v, _ in gone]


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise ``ValueError`` when two rows of the batch have one key: which of
    them a merge would keep is not defined."""
    from .staged import shuffles_freed
    with shuffles_freed(df.sparkSession):
        twice = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(3).collect()
    if twice:
        raise ValueError(f"the batch repeats keys {list(keys)}, e.g. {[tuple(r)[:-1] for r in twice]}")


def settled_batch(updates: DataFrame, keys: Sequence[str], collapse_order: Sequence | None = None) -> DataFrame:
    """The batch of a merge, computed once and reread, with one row per key:
    collapsed by ``collapse_order``, or rejected if it repeats a key."""
    return _settled(updates, keys, collapse_order)[0]


def _settled(updates: DataFrame, keys: Sequence[str], collapse_order: Sequence | None) -> tuple[DataFrame, str]:
    """``settled_batch`` and its folder."""
    from ..session import PACKED, scratch_path
    from .staged import shuffles_freed
    if collapse_order is not None:
        updates = latest_per_key(updates, keys, collapse_order)
    path = scratch_path(updates.sparkSession, f"batch-{uuid.uuid4().hex[:12]}")
    with shuffles_freed(updates.sparkSession):
        updates.write.options(**PACKED).parquet(path)
    batch = updates.sparkSession.read.schema(updates.schema).parquet(path)
    if collapse_order is None:
        require_unique(batch, keys)
    return batch, path


def upsert_table(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str],
                 collapse_order: Sequence | None = None,
                 partition_by: Sequence[str] = (), epoch: int | None = None) -> DataFrame:
    """Upsert ``updates`` into the versioned table at ``path``; return the new version.

    A batch that repeats a key is collapsed by ``collapse_order``, or rejected
    without it.  An empty batch leaves the stored version as it is.  The batch is
    computed once and stored apart until it is merged, then deleted; a first load has nothing
    to be merged with and is written as the version itself.  ``epoch`` is recorded
    with the version.
    """
    table = VersionedTable(spark, path)
    stored = table.read()
    if stored is None:
        if collapse_order is not None:
            updates = latest_per_key(updates, keys, collapse_order)
        table.commit(updates, partition_by, epoch, None if collapse_order is not None else keys)
        return table.read()
    from ..session import delete_path
    batch, folder = _settled(updates, keys, collapse_order)
    if not batch.isEmpty():
        table.commit(upsert_stored(stored, batch, keys), partition_by, epoch)
        stored = table.read()
    delete_path(spark, folder)
    return stored


def upsert_partitions(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str],
                      partition_by: Sequence[str], collapse_order: Sequence | None = None,
                      staging: str | None = None) -> DataFrame:
    """Keyed upsert into a partitioned parquet table, rewriting only the
    partitions that the batch touches.

    A key's partition value must not change between loads (partition by an
    attribute fixed at creation, such as the event date); a stored key that
    the batch moves to another partition raises ``ValueError`` before anything
    is written.  The stored rows of the touched partitions are selected with a
    semi join on the partition columns (dynamic partition pruning skips the
    other folders) and merged with the batch; the result is staged under
    ``staging`` (default: the shared checkpoint folder), which cuts the lineage
    to the table being replaced; finally the staged partitions replace theirs
    with a dynamic partition overwrite.  If that last step fails, running it
    again from the staged copy gives the same table.

    The batch's schema becomes the table's: added, dropped and changed columns are
    reconciled per partition (see ``stored_schema``).  Values of a dropped column stay
    in the folders that no batch has touched since, unread unless the column comes back.
    """
    from ..session import read_parquet_or_none, scratch_path
    updates = settled_batch(updates, keys, collapse_order)
    # read with the batch's schema: partition values keep their declared
    # types instead of the types inferred from folder names
    read = lambda p, schema=updates.schema: spark.read.schema(schema).parquet(p)
    before = read_parquet_or_none(spark, path)
    if before is None:
        updates.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
        return read(path)
    stored_as, in_place = stored_schema(before.schema, updates.schema, partition_by)
    stored = sync_columns(read(path, stored_as), updates.schema)
    new = updates.select(*keys, F.struct(*partition_by).alias("__new"))
    moved = (stored.select(*keys, F.struct(*partition_by).alias("__old")).join(new, list(keys))
             .where(~F.col("__old").eqNullSafe(F.col("__new"))).limit(3).collect())
    if moved:
        raise ValueError(f"keys change their partition, e.g. {[tuple(r)[:len(keys)] for r in moved]}")
    old = stored
    if in_place:
        touched = updates.select(*[F.col(c).alias(f"__t_{c}") for c in partition_by]).distinct()
        cond = None
        for c in partition_by:
            e = stored[c].eqNullSafe(touched[f"__t_{c}"])
            cond = e if cond is None else (cond & e)
        old = stored.join(touched, cond, "left_semi")
    merged = upsert(old, updates.select(*stored.columns), keys, sync_schema=False)
    if staging is None:
        staging = scratch_path(spark, f"upsert-staging-{uuid.uuid4().hex[:12]}")
    merged.write.mode("overwrite").partitionBy(*partition_by).parquet(staging)
    (read(staging).select(*stored.columns).write.mode("overwrite")
          .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))
    return read(path)


_WIDEST = {T.ByteType: T.LongType(), T.ShortType: T.LongType(), T.IntegerType: T.LongType(), T.LongType: T.LongType(),
           T.FloatType: T.DoubleType(), T.DoubleType: T.DoubleType()}


def stored_schema(stored: T.StructType, wanted: T.StructType, partition_by: Sequence[str]) -> tuple[T.StructType, bool]:
    """How to read partitions of different age for a batch of schema ``wanted``.

    Returns the schema to read with, and whether folders that the batch does not
    touch may stay as they are: columns that they lack read as NULL, dropped ones
    are passed over, and whole (or floating) numbers of less width are widened by the reader.
    Any other change of a type means that every partition is rewritten once.
    """
    have, fields, in_place = {f.name: f.dataType for f in stored.fields}, [], True
    for f in wanted.fields:
        old = have.get(f.name, f.dataType)
        if f.name in partition_by or old == f.dataType:
            fields.append(f)
        elif _WIDEST.get(type(old)) == f.dataType:
            fields.append(f)
        else:
            fields.append(T.StructField(f.name, _WIDEST.get(type(old), old), True))
            in_place = False
    return T.StructType(fields), in_place
