"""Session construction and shared-storage helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job of this library is written for.  Adaptive execution
# re-plans joins and coalesces/splits shuffle partitions from runtime
# statistics; the session time zone is pinned so that TIMESTAMP <-> DATE and
# HOUR() give the same answer on every executor.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


#: How the library's own tables are packed: hex keys and texts take about half of snappy's space.
PACKED = {"compression": "zstd"}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "strata", extra: dict | None = None) -> SparkSession:
    """Return a session with the library's defaults.

    On a cluster ``master`` stays ``None`` so that spark-submit decides, and
    ``shuffle_partitions`` should be sized so that one shuffle partition is
    roughly 128-256 MB of the largest exchange (AQE coalesces small ones).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # getOrCreate() ignores builder options for an existing session; runtime
    # SQL options can still be applied.
    for k, v in conf.items():
        if k.startswith("spark.sql.") and not k.startswith("spark.sql.warehouse"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf of an already running session
                pass
    return spark


def scale_conf(largest_shuffle_bytes: int, total_cores: int,
               target_partition_bytes: int = 192 * 1024 * 1024) -> dict[str, str]:
    """Shuffle and scan sizing for a given data volume.

    ``spark.sql.shuffle.partitions`` = enough partitions for about
    ``target_partition_bytes`` each of the largest exchange, and at least two
    waves of tasks; AQE coalesces partitions that turn out small and splits
    skewed ones.  Example: 30 TB of shuffled fact rows on 8,000 cores gives
    163,840 partitions of ~192 MB.
    """
    parts = max(2 * total_cores, -(-largest_shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and versioned scratch tables.

    The cluster names it in ``spark.checkpoint.dir`` (a core setting, fixed
    when the application starts).  Only in local mode, where one machine holds
    everything, a scratch folder is created when it is unset (tests); on a
    cluster each executor would write to its own disk, so that is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder."""
    return "/".join([checkpoint_dir(spark), *[p.strip("/") for p in parts]])


def read_parquet_or_none(spark: SparkSession, path: str, schema: str | None = None, **options):
    """``spark.read.parquet(path)``, or ``None`` when the path does not exist.
    Any other error is raised.  With a ``schema`` a folder may hold no data yet."""
    from pyspark.errors import AnalysisException
    reader = spark.read.options(**options)
    try:
        return (reader.schema(schema) if schema else reader).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder (none if there is no such folder)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder through Hadoop's file system (whatever store holds it)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def create_empty(spark: SparkSession, path: str) -> None:
    """An empty file, through Hadoop's file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True).close()


__all__ = ["get_session", "checkpoint_dir", "scratch_path", "read_parquet_or_none", "child_names", "create_empty", "delete_path",
           "scale_conf", "DEFAULT_CONF"]
