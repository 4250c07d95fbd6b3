"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyspark
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import delete_path, scratch_path

#: A word of the contracts: a run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def text_of(col: str = "text") -> Column:
    """The text, a null one as the empty string."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def sealed(df: DataFrame, **needed: Column) -> DataFrame:
    """The ``needed`` columns and one struct ``__row`` of all of ``df``'s own, so
    that nothing that is added can clash with their names."""
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)])
    return df.select(*[c.alias(name) for name, c in needed.items()], row.alias("__row"))


def unsealed(df: DataFrame, like: DataFrame, changed: dict[str, Column] | None = None, **more: Column) -> DataFrame:
    """The columns of ``like`` out of ``__row``, some of them ``changed``, and some ``more``."""
    taken = [c for c in more if c in like.columns]
    if taken:
        raise ValueError(f"the input has columns that the result adds: {taken}")
    old = [(changed or {}).get(c, F.col(f"__row.c{i}")).alias(c) for i, c in enumerate(like.columns)]
    return df.select(*old, *[c.alias(name) for name, c in more.items()])


#: Spark's setting that shuffle files go as soon as the query that wrote them ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return it reread.

    This is the lineage cut of the operators: the files outlive any executor,
    and what follows does not compute ``df`` again.  So its shuffle files are of no
    use any more and go with the write, not when the driver collects its garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", f"{label}-{uuid.uuid4().hex}")
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*stored: DataFrame) -> None:
    """Delete what ``store`` wrote for these; for tables that nothing reads any more."""
    for df in stored:
        delete_path(df.sparkSession, df._stored_at)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared scratch folder (URI or plain path)."""
    return scratch_path(spark, "llm", f"{label}-{uuid.uuid4().hex}")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def worker_cached(key: tuple, make: Callable):
    """``make()``, kept as long as the Python worker lives: its next tasks find
    vocabularies and remembered words in place.  One object per kind, key[0]."""
    held = vars(pyspark).setdefault("_strata_worker_cache", {})
    if held.get(key[0], (None, None))[0] != key:
        held[key[0]] = key, make()
    return held[key[0]][1]
