"""Periodic, idempotent re-ingest of new landing files.

``readStream`` over the lines of landed JSON Lines files, parsed, flattened and
rejected as in a batch, then a streaming aggregate that holds each key's first
valid record in the state store: copies of a work may lie in any files and
micro-batches of an export. Its order is (latest export, then first place in
it): an export is the folder ``run=<stamp>`` of a file, or the file itself at its modification time.
So the first record wins within an export, whichever comes first in time,
and a later export's record replaces an earlier one's. Keys that a micro-batch touches
are upserted by ``foreachBatch``.

``trigger(availableNow=True)`` processes what has landed and stops, so a
scheduler can run it like a batch job. The checkpoint records which files are
done and the state of each batch; a replayed micro-batch upserts the same rows again.
The state holds one record per key, on disk (RocksDB) and in the checkpoint folder; a run that stops keeps
only the checkpoint's. A file belongs to one micro-batch; without ``places`` its lines are numbered, by one pass of Arrow batches.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from worklake.operators import upsert
from worklake.operators.flatten import accepted, flatten
from worklake.schema import FLAT_COLUMNS, KEY, ORDER_COLUMNS
from worklake.sources.works import works_of_lines

#: Files of a micro-batch: each one is a load, so few large ones are better than many small.
FILES_PER_TRIGGER = 256
_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A record per key, lz4 in blocks of 4 KB unless set: twice as large.
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.blockSizeKB": "32",
    # A micro-batch's shuffle files go when it ends; the stream itself holds on to those of the one before.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}
#: A run that ends keeps no local copy of the state beside the checkpoint's, but while a task works on its part.
_SETTINGS_OF_A_RUN = {"spark.sql.streaming.stateStore.unloadOnCommit": "true"}


def export_time(file: Column, modified: Column) -> Column:
    """When a file's export was made: the stamp of its ``run=`` folder, else the file's own time (microseconds)."""
    stamp = F.regexp_extract(file, "/run=([0-9]{8}_[0-9]{6})/", 1)
    return F.coalesce(F.unix_micros(F.try_to_timestamp(stamp, F.lit("yyyyMMdd_HHmmss"))), F.unix_micros(modified))


def numbered(lines: DataFrame) -> DataFrame:
    """Lines with their running number in the task as ``_row`` (a stream has no built-in for it)."""
    def run(batches):
        import pyarrow as pa

        at = 0
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(range(at, at + b.num_rows), pa.int64())], [*b.schema.names, "_row"])
            at += b.num_rows

    return lines.drop("_row").mapInArrow(run, T.StructType([*lines.drop("_row").schema.fields, T.StructField("_row", T.LongType())]))


def first_records(lines: DataFrame, places: bool = True) -> DataFrame:
    """The winning flat row of each key; ``lines`` has ``value``, ``_file``, ``_row`` and ``_exported``.

    Without ``places`` (records that carry no ``_src``/``_pos``) lines are numbered in their tasks.
    """
    works = works_of_lines((lines if places else numbered(lines)).withColumn("_tie", F.xxhash64("value")), "_exported", "_tie")
    flat = accepted(flatten(works, (*ORDER_COLUMNS, "_exported", "_tie")))
    order = F.struct((-F.col("_exported")).alias("exported"), *ORDER_COLUMNS, "_tie")
    first = flat.groupBy(KEY).agg(F.min_by(F.struct(*[c for c in FLAT_COLUMNS if c != KEY]), order).alias("v"))
    return first.select(*[F.col(c) if c == KEY else F.col(f"v.{c}").alias(c) for c in FLAT_COLUMNS])


def start_incremental_ingest(spark: SparkSession, landing: str, table: str, checkpoint: str,
                             loaded_at: dt.datetime | None = None, max_files_per_trigger: int = FILES_PER_TRIGGER,
                             available_now: bool = True, buckets: int | None = None, places: bool = True):
    """Start the stream; returns the StreamingQuery."""
    source = (spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(landing)
              .select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_row"),
                      export_time(F.col("_metadata.file_path"), F.col("_metadata.file_modification_time")).alias("_exported")))

    def load(batch: DataFrame, epoch_id: int) -> None:
        upsert.upsert_table(batch.sparkSession, table, batch, loaded_at, buckets=buckets)

    writer = first_records(source, places).writeStream.outputMode("update").foreachBatch(load).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    settings = _SETTINGS | (_SETTINGS_OF_A_RUN if available_now else {})
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():  # a query keeps the settings it was started with
        spark.conf.set(k, v)
    try:
        return writer.start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def incremental_ingest(spark: SparkSession, landing: str, table: str, checkpoint: str,
                       loaded_at: dt.datetime | None = None, max_files_per_trigger: int = FILES_PER_TRIGGER,
                       buckets: int | None = None, places: bool = True) -> None:
    """Run the available-now stream to completion."""
    q = start_incremental_ingest(spark, landing, table, checkpoint, loaded_at, max_files_per_trigger, buckets=buckets, places=places)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
