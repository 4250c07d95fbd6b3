"""Continuous keyed loads with Structured Streaming.

``run_available_now`` reads new files of a source folder as a stream
(``trigger(availableNow=True)`` processes what is there, in bounded
micro-batches, then stops), transforms each micro-batch with the same
batch model builder, and merges it into a versioned table with the keyed
upsert inside ``foreachBatch``.  The stream checkpoint records which files
were consumed, so a restarted run continues where the last one stopped.  A
micro-batch's number (epoch) is recorded with the version that it commits, so
one that is replayed after a failure is recognised and skipped; where the
failure came before the record, merging it again is harmless (same keys, same
values).  Repeats of a row in different micro-batches can be kept from the
merge by watermarked state.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.incremental import VersionedTable, upsert_partitions, upsert_table
from ..session import child_names


def run_available_now(spark: SparkSession, source_dir: str, schema: T.StructType,
                      transform: Callable[[DataFrame], DataFrame], table_path: str,
                      keys: Sequence[str], checkpoint_location: str,
                      file_glob: str | None = None, max_files_per_trigger: int | None = None,
                      collapse_order: Sequence | None = None,
                      partition_by: Sequence[str] = (),
                      repeats: tuple[Sequence[str], str, str] | None = None) -> DataFrame | None:
    """Process every unread file under ``source_dir`` and return the merged table.

    ``partition_by`` stores the table partitioned and merges each micro-batch
    into the partitions it touches only (``upsert_partitions``); without it the
    table is a versioned whole-table rewrite (``upsert_table``).

    ``repeats=(keys, event_time, delay)`` drops rows whose keys came before,
    within ``delay`` (an interval such as ``"2 days"``) of event time; the state
    is let go as the watermark passes.  Rows later than the watermark are dropped,
    so ``delay`` is also the lateness that is allowed.
    """
    reader = spark.readStream.schema(schema)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)
    if repeats:
        repeat_keys, event_time, delay = repeats
        timed = stream.withColumn("__event_time", F.col(event_time).cast("timestamp")).withWatermark("__event_time", delay)
        stream = timed.dropDuplicatesWithinWatermark(list(repeat_keys)).drop("__event_time")

    def merge(batch: DataFrame, epoch_id: int) -> None:
        done = f"{table_path}/_epochs/{epoch_id}"  # readers pass over names with an underscore
        if (child_names(spark, done) if partition_by else VersionedTable(spark, table_path).has_epoch(epoch_id)):
            if repeats:  # the state of this epoch has to be committed all the same
                batch.write.format("noop").mode("overwrite").save()
            return  # a replay
        rows = transform(batch)
        if partition_by:
            upsert_partitions(spark, table_path, rows, keys, partition_by,
                              collapse_order=collapse_order)
            spark.range(1).write.mode("overwrite").parquet(done)
        else:
            upsert_table(spark, table_path, rows, keys, collapse_order=collapse_order, epoch=epoch_id)

    q = (stream.writeStream.foreachBatch(merge)
         .option("checkpointLocation", checkpoint_location)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    if partition_by:
        from ..session import read_parquet_or_none
        return read_parquet_or_none(spark, table_path)
    return VersionedTable(spark, table_path).read()
