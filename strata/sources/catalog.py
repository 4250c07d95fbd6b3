"""Layer tables in the catalog: staged writes, published by swapping a view.

``<root>/<layer>/<name>`` holds one folder per version, written once and never
changed: ``v000007-<unique>``.  A version is complete when the writer has left
its success mark; until then nobody reads it.  Publishing swaps the view
``<layer>.<name>`` to the new folder, one catalog change.  So a reader of the
view, or of the newest complete folder, always sees the whole old or the whole
new table, wherever a writer stops.

``BucketedTable`` keeps a table bucketed and sorted by its merge keys, so a
merge shuffles the batch only.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import PACKED, child_names, create_empty, delete_path, scratch_path
from .landing import layer_path

#: Setting that a writer leaves a success mark.
_MARKS = "mapreduce.fileoutputcommitter.marksuccessfuljobs"

_VERSION = re.compile(r"v(\d{6,})-[0-9a-f]+(?:-b(\d+))?$")


def _quoted(*parts: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


class LayerCatalog:
    """Tables under ``root``; views in the schemas ``<prefix><layer>``.

    Sessions whose catalog outlives them need no more than the view; in others
    ``register`` puts the view back from the folders.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        self.spark, self.root, self.prefix = spark, root.rstrip("/"), prefix

    def schema(self, layer: str) -> str:
        return self.prefix + layer

    def view(self, layer: str, name: str) -> str:
        return _quoted(self.schema(layer), name)

    def versions(self, layer: str, name: str) -> list[tuple[int, str, bool]]:
        """``(number, folder, complete)`` of all versions, oldest first."""
        path = layer_path(self.root, layer, name)
        found = [(int(m[1]), n) for n in child_names(self.spark, path) if (m := _VERSION.match(n))]
        return [(v, f"{path}/{n}", "_SUCCESS" in child_names(self.spark, f"{path}/{n}")) for v, n in sorted(found)]

    def current(self, layer: str, name: str) -> str | None:
        """Folder of the newest complete version."""
        whole = [folder for _, folder, complete in self.versions(layer, name) if complete]
        return whole[-1] if whole else None

    def new_folder(self, layer: str, name: str, mark: str = "") -> str:
        number = max([v for v, _, _ in self.versions(layer, name)], default=0) + 1
        return f"{layer_path(self.root, layer, name)}/v{number:06d}-{uuid.uuid4().hex[:12]}{mark}"

    def stage(self, df: DataFrame, layer: str, name: str, partition_by: Sequence[str] = ()) -> str:
        """Write a new version that nobody reads yet; its folder."""
        folder = self.new_folder(layer, name)
        w = df.write.mode("error").options(**PACKED)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(folder)
        return folder

    def swap(self, layer: str, name: str, folder: str) -> None:
        """Point the view at a complete version."""
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_quoted(self.schema(layer))}")
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.view(layer, name)} AS SELECT * FROM parquet.{_quoted(folder)}")

    def publish(self, df: DataFrame, layer: str, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Full refresh: stage, then swap.  ``df`` may read the table it replaces."""
        folder = self.stage(df, layer, name, partition_by)
        self.swap(layer, name, folder)
        return self.spark.read.parquet(folder)

    def table(self, layer: str, name: str) -> DataFrame | None:
        """The newest complete version; it stays readable while others are published."""
        folder = self.current(layer, name)
        return None if folder is None else self.spark.read.parquet(folder)

    def register(self, layer: str, name: str) -> bool:
        """Put the view back where it is missing or behind; False without a complete version."""
        folder = self.current(layer, name)
        if folder is not None:
            self.swap(layer, name, folder)
        return folder is not None

    def vacuum(self, layer: str, name: str, keep: int = 2) -> list[str]:
        """Delete all but the newest ``keep`` complete versions, and what broken
        writers left.  For times without readers of old versions and without writers."""
        found = self.versions(layer, name)
        kept = {folder for _, folder, complete in [v for v in found if v[2]][-keep:]} if keep > 0 else set()
        gone = [folder for _, folder, _ in found if folder not in kept]
        for folder in gone:
            delete_path(self.spark, folder)
        return gone


class BucketedTable:
    """A keyed table, bucketed and sorted by ``keys``; versions and view as above.

    The stored side of a merge is read bucket by bucket, as it lies: only the
    batch is shuffled, into as many partitions as there are buckets.  A bucket
    holds the rows of its keys' hash, so ``buckets`` should be the stored bytes
    over some 256 MB.  Changing it costs one shuffle of the table.
    """

    def __init__(self, catalog: LayerCatalog, layer: str, name: str, keys: Sequence[str], buckets: int):
        self.catalog, self.layer, self.name, self.keys, self.buckets = catalog, layer, name, list(keys), buckets

    def _table_name(self, folder: str) -> str:
        return _quoted(self.catalog.schema(self.layer), f"{self.name}__{folder.rsplit('/', 1)[1].replace('-', '_')}")

    def read(self, folder: str | None = None) -> DataFrame | None:
        """The current version as a bucketed table."""
        spark = self.catalog.spark
        folder = folder or self.catalog.current(self.layer, self.name)
        if folder is None:
            return None
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_quoted(self.catalog.schema(self.layer))}")
        table = self._table_name(folder)
        if not spark.catalog.tableExists(table):
            columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in spark.read.parquet(folder).schema.fields)
            by = ", ".join(_quoted(k) for k in self.keys)
            spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
                      f"INTO {_VERSION.match(folder.rsplit('/', 1)[1])[2]} BUCKETS LOCATION '{folder}'")
        return spark.table(table)

    def merged(self, stored: DataFrame, batch: DataFrame) -> DataFrame:
        """Stored rows without those that the batch replaces, and the batch.

        Equality of the keys alone lets Spark use the buckets; rows with a null
        in their key compare null-safe apart, and without a shuffle if there are none.
        """
        batch = batch.repartition(self.buckets, *[F.col(k) for k in self.keys])
        return self._kept(stored, batch).unionByName(batch)

    def _kept(self, stored: DataFrame, batch: DataFrame) -> DataFrame:
        """Stored rows without those that the batch replaces."""
        from ..operators.incremental import sync_columns
        stored = sync_columns(stored, batch.schema)
        whole, none = F.lit(True), F.lit(False)
        for k in self.keys:
            whole, none = whole & F.col(k).isNotNull(), none | F.col(k).isNull()
        on = batch.where(whole).select(*[F.col(k).alias(f"__{i}") for i, k in enumerate(self.keys)])
        same = F.lit(True)
        for i, k in enumerate(self.keys):
            same = same & (F.col(k) == F.col(f"__{i}"))
        kept = stored.where(whole).join(on, same, "left_anti")
        void, rest, same = stored.where(none), batch.where(none).select(*[F.col(k).alias(f"__{i}") for i, k in enumerate(self.keys)]), F.lit(True)
        for i, k in enumerate(self.keys):
            same = same & F.col(k).eqNullSafe(F.col(f"__{i}"))
        return kept.unionByName(void.join(rest, same, "left_anti"))

    def merge(self, updates: DataFrame, collapse_order: Sequence | None = None) -> DataFrame:
        """Upsert ``updates`` and publish; the new version.  The batch is computed once,
        stored, and deleted when it is merged.

        The rows of a large batch are shuffled and written in parts of the buckets, one after
        the other, so that disk holds one part's shuffle at a time.  The version is
        marked as complete after the last.
        """
        from ..operators.incremental import _settled
        from ..operators.staged import slices_for, shuffles_freed
        spark = self.catalog.spark
        batch, scratch = _settled(updates, self.keys, collapse_order)
        stored = self.read()
        if stored is not None and batch.isEmpty():
            delete_path(spark, scratch)
            return stored
        n = slices_for(batch)
        keys = [F.col(k) for k in self.keys]
        part = lambda i: (batch if n == 1 else batch.where(F.pmod(F.pmod(F.hash(*keys), F.lit(self.buckets)), F.lit(n)) == i)).repartition(self.buckets, *keys)
        if n == 1:
            parts = [part(0) if stored is None else self.merged(stored, batch)]
        else:
            parts = [*([] if stored is None else [self._kept(stored, batch)]), *[part(i) for i in range(n)]]
        folder = self.catalog.new_folder(self.layer, self.name, f"-b{self.buckets}")
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_quoted(self.catalog.schema(self.layer))}")
        with shuffles_freed(spark):
            for i, out in enumerate(parts):
                (out.write.mode("error" if i == 0 else "append").options(**PACKED).bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
                    .option(_MARKS, "false").option("path", folder).format("parquet").saveAsTable(self._table_name(folder)))
        create_empty(spark, f"{folder}/_SUCCESS")
        delete_path(spark, scratch)
        self.catalog.swap(self.layer, self.name, folder)
        return self.read(folder)


class AppendedTable:
    """A table that grows by batches, each a folder of its own partitioned by
    ``partition_by``: ``<path>/batch=<n>-<unique>/<day>=.../``.

    A batch counts once its writer has left the success mark, so a reader sees
    whole batches only, and nothing stored is copied when one is added.
    """

    def __init__(self, spark: SparkSession, path: str, partition_by: Sequence[str]):
        self.spark, self.path, self.partition_by = spark, path.rstrip("/"), list(partition_by)

    def batches(self) -> list[str]:
        found = sorted(n for n in child_names(self.spark, self.path) if n.startswith("batch="))
        return [n for n in found if "_SUCCESS" in child_names(self.spark, f"{self.path}/{n}")]

    def read(self, schema=None) -> DataFrame | None:
        """All complete batches, without the batch column."""
        names = self.batches()
        if not names:
            return None
        reader = self.spark.read.option("basePath", self.path)
        if schema is not None:
            reader = reader.schema(schema)
        else:
            reader = reader.option("mergeSchema", "true")
        return reader.parquet(*[f"{self.path}/{n}" for n in names]).drop("batch")

    def append(self, df: DataFrame) -> str | None:
        """Add a batch.  An empty one leaves no partitions and is not kept."""
        number = len([n for n in child_names(self.spark, self.path) if n.startswith("batch=")]) + 1
        name = f"batch={number:06d}-{uuid.uuid4().hex[:8]}"
        df.write.mode("error").partitionBy(*self.partition_by).parquet(f"{self.path}/{name}")
        if not [n for n in child_names(self.spark, f"{self.path}/{name}") if "=" in n]:
            delete_path(self.spark, f"{self.path}/{name}")
            return None
        return name


def scratch_catalog(spark: SparkSession, label: str) -> LayerCatalog:
    """A catalog of its own under the shared scratch folder."""
    mark = uuid.uuid4().hex[:12]
    return LayerCatalog(spark, scratch_path(spark, f"{label}-{mark}"), prefix=f"{label}_{mark}_")
