"""Wide steps over stored slices, so that disk holds a share of a step's shuffle at a time.

A plan's shuffle files stay until the query that wrote them ends.  A row that
meets several large tables in one plan lies on disk once per join, unpacked.  Here
such a plan is cut: rows are stored (packed columns) apart by a hash of the next
step's keys, each slice takes the step on its own, its shuffle files go with its
write, and so does the slice.  Equal keys share a slice, so the rows are those of
the plan in one piece.  Tables below ``SLICE_BYTES`` are not cut and nothing runs early.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import PACKED, child_names, delete_path, scratch_path
from .lookup import _pairs, lookup

#: Spark's setting that shuffle files go as soon as the query that wrote them ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes that a plan reads for each slice, and the most slices.
SLICE_BYTES, MOST_SLICES = 512 << 20, 8

_SLICE = "__slice"


@contextmanager
def shuffles_freed(spark: SparkSession, **more: str) -> Iterator[None]:
    """Queries that end in here leave no shuffle files; ``more`` settings hold as long."""
    conf = {CLEANUP: "true", **more}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def read_bytes(df: DataFrame) -> int:
    """Bytes of the files that a plan scans (as often as it scans them); from the
    footers and file lists, no job."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def slices_for(df: DataFrame) -> int:
    return max(1, min(MOST_SLICES, math.ceil(read_bytes(df) / SLICE_BYTES)))


def settle(df: DataFrame, label: str = "settled") -> DataFrame:
    """``df`` stored once and reread; its shuffle files go with the write."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{label}-{uuid.uuid4().hex[:12]}")
    with shuffles_freed(spark):
        df.write.options(**PACKED).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slice_of(keys: Sequence[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(n)).cast("int")


class Stage:
    """A scratch folder of slices; ``clear`` deletes what is left of it."""

    def __init__(self, spark: SparkSession, label: str = "stage"):
        self.spark, self.root = spark, scratch_path(spark, f"{label}-{uuid.uuid4().hex[:12]}")

    def _write(self, df: DataFrame, path: str, by: Column | None, n: int) -> None:
        # as many open files as slices, else each task sorts its rows by slice first
        with shuffles_freed(self.spark, **{"spark.sql.maxConcurrentOutputFileWriters": str(n + 1)}):
            if by is None:
                df.write.mode("append").options(**PACKED).parquet(path)
            else:
                df.withColumn(_SLICE, by).write.mode("append").options(**PACKED).partitionBy(_SLICE).parquet(path)

    def run(self, df: DataFrame, steps: Sequence[tuple[Column, Callable[[DataFrame, int], DataFrame]]], n: int) -> DataFrame:
        """``df`` through ``steps``: each a slice number (0 to n - 1) of its input's rows,
        and what is done to the rows of one slice."""
        path, schema = f"{self.root}/0-{uuid.uuid4().hex[:8]}", df.schema
        self._write(df, path, steps[0][0], n)
        for k, (_, step) in enumerate(steps):
            out, by = f"{self.root}/{k + 1}-{uuid.uuid4().hex[:8]}", steps[k + 1][0] if k + 1 < len(steps) else None
            stored = set(child_names(self.spark, path))
            for i in range(n):
                folder = f"{path}/{_SLICE}={i}"
                if folder.rsplit("/", 1)[1] not in stored:
                    continue
                self._write(step(self.spark.read.schema(schema).parquet(folder), i), out, by, n)
                delete_path(self.spark, folder)
            empty = step(self.spark.createDataFrame([], schema), 0)
            self._write(empty, out, by, n)  # rows or none, the folder is there
            delete_path(self.spark, path)
            path, schema = out, empty.schema
        return self.spark.read.schema(schema).parquet(path)

    def clear(self) -> None:
        delete_path(self.spark, self.root)


def lookups(fact: DataFrame, steps: Sequence[tuple[DataFrame, object, Sequence[str], bool]], keep: Sequence[str],
            stage: Stage | None = None) -> DataFrame:
    """``lookup`` of several dimensions ``(dim, on, take, required)`` in turn; the
    ``keep`` columns and all that were taken.

    With a ``stage``, and where the tables are large, each lookup is done in slices of its key.
    A key that is not kept goes with its last lookup.
    """
    n = slices_for(fact) if stage is not None else 1
    keys = [[f for f, _ in _pairs(on)] for _, on, _, _ in steps]
    taken = [list(t.values()) if isinstance(t, Mapping) else list(t) for _, _, t, _ in steps]

    def held(k: int) -> list[str]:
        """Columns before step ``k``."""
        named = [*keep, *[c for t in taken[:k] for c in t], *[c for ks in keys[k:] for c in ks]]
        return [c for c in dict.fromkeys(named) if c not in {c for t in taken[k:] for c in t}]

    def one(k: int) -> Callable[..., DataFrame]:
        dim, on, take, required = steps[k]
        return lambda df, _=0: lookup(df, dim, on, take, required).select(*held(k + 1))

    fact = fact.select(*held(0))
    if n == 1:
        return reduce(lambda df, k: one(k)(df), range(len(steps)), fact)
    return stage.run(fact, [(slice_of(keys[k], n), one(k)) for k in range(len(steps))], n)
