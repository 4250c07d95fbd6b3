"""Table sinks: full refresh (published through the catalog) and keyed incremental writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.incremental import upsert_table
from .catalog import LayerCatalog
from .landing import layer_path


def write_table(df: DataFrame, root: str, layer: str, name: str,
                partition_by: Sequence[str] = (), catalog: LayerCatalog | None = None) -> str:
    """Full refresh of ``<root>/<layer>/<name>``; the folder of the new version.

    The table is written beside the old one and counts once it is complete;
    with a ``catalog`` its view is swapped to it, too.
    """
    folder = (catalog or LayerCatalog(df.sparkSession, root)).stage(df, layer, name, partition_by)
    if catalog is not None:
        catalog.swap(layer, name, folder)
    return folder


def write_incremental(spark: SparkSession, df: DataFrame, root: str, layer: str, name: str,
                      keys: Sequence[str], collapse_order: Sequence | None = None) -> DataFrame:
    """Keyed upsert into a versioned table; returns the new version."""
    return upsert_table(spark, layer_path(root, layer, name), df, keys,
                        collapse_order=collapse_order)
