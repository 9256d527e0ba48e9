"""Run log: one row per load (id = max + 1), part of the load's log row."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worklake.sources import tables

HEADER_FIELDS = ("fetched_at", "from_date", "to_date", "subfield_id")


class RunHeaderError(ValueError):
    """The export header misses a field the run log requires (all NOT NULL)."""


def envelope_headers(envelopes: DataFrame) -> DataFrame:
    """P5: the run fields of every envelope; missing parents give NULL."""
    return envelopes.select(
        "_src",
        F.try_to_timestamp("fetched_at").alias("fetched_at"),
        F.try_to_date(F.col("date_range.from"), "yyyy-MM-dd").alias("from_date"),
        F.try_to_date(F.col("date_range.to"), "yyyy-MM-dd").alias("to_date"),
        F.col("subfield.id").alias("subfield_id"),
        F.col("subfield.display_name").alias("subfield_name"))


def validate_header(header: dict) -> dict:
    missing = [k for k in HEADER_FIELDS if header.get(k) is None]
    if missing:
        raise RunHeaderError("export header lacks required field(s): " + ", ".join(missing))
    return header


def run_fields(header: dict, paper_count: int, created_at: dt.datetime) -> dict:
    """The run-log row of a load without its id, which the log gives."""
    validate_header(header)
    return {**{k: header[k] for k in HEADER_FIELDS}, "paper_count": paper_count, "created_at": created_at}


def append_run(spark: SparkSession, table: str, header: dict, paper_count: int,
               created_at: dt.datetime | None = None) -> int:
    """M4 alone: append a run row without a load; returns its id."""
    created_at = created_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    run = run_fields(header, paper_count, created_at)
    tables.ensure_tables(spark, table)
    return tables.append_log(spark, table, tables.table_state(spark, table), run)
