"""The stored table's folders and its log of loads.

    <table>/papers/<version>/   all papers as of one load: Parquet, bucketed and sorted by the key
    <table>/log/                JSON rows, one per load or run row (``LOG_SCHEMA``)

The newest log row names the version in force. A load writes a version folder,
then appends its log row; until then readers see the version before, and a
load that broke off leaves an unnamed folder. The log is one small file per load,
of which a load reads the newest row only. One writer at a time: concurrent writers,
time travel and partial rewrites are what a table format is for, not this.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worklake.schema import LOG_SCHEMA, PAPERS_SCHEMA


@dataclass(frozen=True)
class TableState:
    """The newest log row: version in force, the one before, its buckets, last log and run numbers."""

    seq: int = 0
    version: str | None = None
    previous: str | None = None
    buckets: int | None = None
    last_run: int = 0


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file is there, on whatever store the path names; errors are raised."""
    p, fs = _path(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def version_folder(table: str, version: str) -> str:
    return f"{table.rstrip('/')}/papers/{version}"


def log_folder(table: str) -> str:
    return f"{table.rstrip('/')}/log"


def ensure_tables(spark: SparkSession, table: str) -> list[str]:
    """Create the table empty if it is absent; returns the names of what was created.

    Idempotent, called before every load. Parquet enforces no NOT NULL and no
    key: the operators do (reject routing, first-wins), and the DQ checks verify it.
    """
    if exists(spark, log_folder(table)):
        return []
    for folder in (log_folder(table), version_folder(table, "")):
        p, fs = _path(spark, folder)
        fs.mkdirs(p)
    return ["papers", "runs"]


def load_log(spark: SparkSession, table: str) -> DataFrame:
    """All log rows; an absent table has none, an unreadable row is an error."""
    if not exists(spark, log_folder(table)):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).option("mode", "FAILFAST").json(log_folder(table))


def read_runs(spark: SparkSession, table: str) -> DataFrame:
    """The run log: the run rows of the loads."""
    return load_log(spark, table).where("run IS NOT NULL").select("run.*")


def table_state(spark: SparkSession, table: str) -> TableState:
    newest = load_log(spark, table).orderBy(F.desc("seq")).limit(1).collect()
    if not newest:
        return TableState()
    return TableState(**{k: newest[0][k] for k in ("seq", "version", "previous", "buckets", "last_run")})


def read_papers(spark: SparkSession, table: str) -> DataFrame:
    """The stored papers (38 columns) of the version in force."""
    version = table_state(spark, table).version
    if version is None:
        return spark.createDataFrame([], PAPERS_SCHEMA)
    return spark.read.schema(PAPERS_SCHEMA).parquet(version_folder(table, version))


def append_log(spark: SparkSession, table: str, before: TableState, run: dict | None = None,
               version: str | None = None, buckets: int | None = None) -> int | None:
    """Append the row that follows ``before``; returns the run's id.

    With ``version`` that version comes into force, without it the one before stays.
    """
    run_id = None if run is None else before.last_run + 1
    row = {"seq": before.seq + 1, "version": version or before.version,
           "previous": before.version if version else before.previous, "buckets": buckets or before.buckets,
           "last_run": run_id or before.last_run, "run": None if run is None else {"id": run_id, **run}}
    (spark.createDataFrame([json.dumps(row, ensure_ascii=False, default=_text)], "string").coalesce(1)
     .write.mode("append").text(log_folder(table)))
    return run_id


def _text(value) -> str:
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ", timespec="microseconds")
    return value.isoformat()
