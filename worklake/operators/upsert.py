"""Keyed upsert as one full outer join of the stored papers and the batch.

The stored version is bucketed and sorted by the key. It is joined with the
batch on the key: only the batch is shuffled, to the stored buckets, and each
task writes its bucket of the next version. Of a table with fewer buckets than a shuffle
has partitions, both sides are shuffled, and several tasks write a bucket, a file each. A key that the batch holds takes ALL
columns of the batch (NULLs overwrite, no recency guard) and keeps its first
``ingested_at``; other stored rows pass through. A load that is repeated leaves the
same rows, one that broke off leaves the version before in force.

A load writes the whole table, so few large loads are better than many small
ones; tables that need partial rewrites belong into a table format with MERGE.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from worklake.schema import FLAT_COLUMNS, KEY, PAPERS_SCHEMA
from worklake.sources import tables

COLUMNS = [f.name for f in PAPERS_SCHEMA.fields]


def _loaded_at(loaded_at) -> Column:
    if loaded_at is None:
        return F.current_timestamp()
    if isinstance(loaded_at, Column):
        return loaded_at
    return F.lit(loaded_at).cast("timestamp")


def with_ingested_at(inc: DataFrame, loaded_at=None) -> DataFrame:
    """The rows of a load as they are stored."""
    return inc.select(*FLAT_COLUMNS, _loaded_at(loaded_at).alias("ingested_at"))


def merge(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Every key of either side once, with the batch's columns and the first ``ingested_at``."""
    s, b = stored.alias("s"), batch.alias("b")
    sent = F.col(f"b.{KEY}").isNotNull()
    columns = [F.coalesce(f"b.{c}", f"s.{c}") if c == KEY else F.coalesce(f"s.{c}", f"b.{c}") if c == "ingested_at"
               else F.when(sent, F.col(f"b.{c}")).otherwise(F.col(f"s.{c}")) for c in COLUMNS]
    return s.join(b, F.col(f"s.{KEY}") == F.col(f"b.{KEY}"), "full_outer").select(
        *[c.alias(n) for c, n in zip(columns, COLUMNS, strict=True)])


@contextmanager
def bucketed(spark: SparkSession, folder: str, buckets: int):
    """The papers in ``folder`` as a table that Spark knows to be bucketed by the key.

    The catalog entry lasts as long as the block; the files aren't its own.
    """
    name = f"worklake_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in PAPERS_SCHEMA.fields)
    place = folder.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({KEY}) "
              f"INTO {int(buckets)} BUCKETS LOCATION '{place}'")
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _write_version(df: DataFrame, folder: str, buckets: int) -> None:
    """Write papers that are distributed by the key's buckets, one file per bucket."""
    name = f"worklake_{uuid.uuid4().hex}"
    (df.write.format("parquet").mode("errorifexists").bucketBy(buckets, KEY).sortBy(KEY)
     .option("path", folder).saveAsTable(name))
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")  # external: the files stay


def observed(counted: Observation) -> dict:
    """What was counted while rows were written; rows that Spark plans away as empty have no counts."""
    try:
        return counted.get
    except Py4JJavaError as e:
        if "AssertionError" not in str(e.java_exception):
            raise
        return {}


def default_buckets(spark: SparkSession) -> int:
    """Buckets of a new table unless given: as many as a shuffle has partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tasks_per_bucket(spark: SparkSession, buckets: int) -> int:
    """How many tasks share a bucket, so that few buckets don't make large tasks.

    The hash of a key modulo a multiple of ``buckets`` gives its bucket modulo ``buckets``.
    """
    return max(1, default_buckets(spark) // buckets)


@contextmanager
def stored_papers(spark: SparkSession, folder: str, buckets: int):
    """The papers of a version: one task per bucket, unless several tasks share a bucket."""
    if tasks_per_bucket(spark, buckets) > 1:
        yield spark.read.schema(PAPERS_SCHEMA).parquet(folder)
    else:
        with bucketed(spark, folder, buckets) as stored:
            yield stored


def load(spark: SparkSession, path: str, inc: DataFrame, loaded_at=None, run: dict | Callable[[], dict] | None = None,
         buckets: int | None = None) -> tuple[int, int | None]:
    """Upsert accepted, de-duplicated rows into the table at ``path``: (rows sent, the run's id).

    ``run`` is the load's run-log row without its id, or gives it once the rows are written. ``buckets`` sizes the next
    version (about the table's bytes by 128 MB); without it the stored number stays. If it
    differs from the stored one, the merged rows are shuffled once more.
    """
    if loaded_at is None:
        loaded_at = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    tables.ensure_tables(spark, path)
    before = tables.table_state(spark, path)
    version = f"{before.seq + 1:08d}-{uuid.uuid4().hex[:8]}"
    buckets = buckets or before.buckets or default_buckets(spark)
    counted = Observation(f"sent-{version}")
    batch = with_ingested_at(inc, loaded_at).observe(counted, F.count(F.lit(1)).alias("n"))
    folder, share = tables.version_folder(path, version), tasks_per_bucket(spark, buckets)
    if before.version is None:
        _write_version(batch.repartition(buckets * share, KEY), folder, buckets)
    else:
        with stored_papers(spark, tables.version_folder(path, before.version), before.buckets) as stored:
            merged = merge(stored, batch)
            if buckets != before.buckets or share > 1:
                merged = merged.repartition(buckets * share, KEY)
            _write_version(merged, folder, buckets)
    run_id = tables.append_log(spark, path, before, run() if callable(run) else run, version, buckets)
    if before.previous:  # the version before this one stays for readers under way
        tables.delete(spark, tables.version_folder(path, before.previous))
    return observed(counted).get("n", 0), run_id


def upsert_table(spark: SparkSession, path: str, inc: DataFrame, loaded_at=None, run: dict | None = None,
                 buckets: int | None = None) -> int:
    """``load``, returning the number of rows sent (inserted and updated)."""
    return load(spark, path, inc, loaded_at, run, buckets)[0]


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The stored papers (38 columns) as of the last load."""
    return tables.read_papers(spark, path)
