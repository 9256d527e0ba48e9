"""Tables the queries run on, all derived by Spark from the driver's test data.

raw works  → flatten → first valid row per key = the stored papers table
(``ingested_at`` = the load time of the one batch); the run log holds one
run per publication year (a batch per yearly window), ``paper_count`` being
the raw batch size, as the source records it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from worklake.operators.dedup import batch_dedup
from worklake.operators.flatten import flatten
from worklake.operators.upsert import with_ingested_at
from worklake.sources.testdata import SUBFIELD_BASE, works_from_testdata

# Fixed values of the test binding: load time of the batch, the "today" of
# the date-sanity check, the subfield the data-quality check expects, the
# full publication window of the test data.
LOAD_TS = dt.datetime(2026, 6, 15, 0, 0, 0)
AS_OF = dt.date(1999, 12, 31)
EXPECTED_SUBFIELD = "BUILDING"
FULL_FROM = dt.date(1995, 1, 1)
FULL_TO = dt.date(2001, 12, 31)

# Upsert scenario: two fetches over overlapping windows; the second is a
# later snapshot (DOI withdrawn → NULL must overwrite, one more citation).
BATCH1 = (dt.date(1995, 1, 1), dt.date(1998, 12, 31))
BATCH2 = (dt.date(1998, 1, 1), dt.date(2001, 12, 31))
LOAD2_TS = dt.datetime(2026, 6, 16, 0, 0, 0)

# Window of the job keys.
JOB_FROM, JOB_TO = dt.date(1996, 1, 1), dt.date(1998, 12, 31)


def raw_works(spark: SparkSession, sf_dir: str, files: int | None = None) -> DataFrame:
    """The raw works; with ``files`` dealt by their place to so many partitions."""
    return works_from_testdata(spark, sf_dir, files=files)


def flat_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(raw_works(spark, sf_dir))


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table after loading all raw works once (38 columns)."""
    return with_ingested_at(batch_dedup(flat_works(spark, sf_dir)), LOAD_TS)


def valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted rows *before* de-duplication (what Q1 must catch)."""
    from worklake.operators.flatten import accepted

    return with_ingested_at(accepted(flat_works(spark, sf_dir)), LOAD_TS)


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run log: one run per publication year of the raw works."""
    return runs_of(raw_works(spark, sf_dir))


def runs_of(raw: DataFrame) -> DataFrame:
    """One run per publication year of ``raw``; paper_count = raw batch size.

    The group-by is partial-aggregated; the numbering window then runs over
    one row per year (bounded by the calendar, not by the data).
    """
    d = F.try_to_date(F.col("publication_date"), "yyyy-MM-dd")
    per_year = (raw.select(F.year(d).alias("y")).filter(F.col("y").isNotNull())
                .groupBy("y").agg(F.count(F.lit(1)).alias("paper_count")))
    fetched = F.make_timestamp(F.col("y") + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    return per_year.select(
        F.row_number().over(Window.orderBy("y")).cast("int").alias("id"),
        fetched.alias("fetched_at"),
        F.make_date(F.col("y"), F.lit(1), F.lit(1)).alias("from_date"),
        F.make_date(F.col("y"), F.lit(12), F.lit(31)).alias("to_date"),
        F.lit(SUBFIELD_BASE + EXPECTED_SUBFIELD).alias("subfield_id"),
        F.col("paper_count").cast("long").alias("paper_count"),
        fetched.alias("created_at"),
    )


def in_window(raw: DataFrame, window: tuple[dt.date, dt.date]) -> DataFrame:
    d = F.try_to_date(F.col("publication_date"), "yyyy-MM-dd")
    return raw.filter(d.between(F.lit(window[0]), F.lit(window[1])))


def second_snapshot(raw: DataFrame) -> DataFrame:
    """Later fetch of the same works: DOI gone, one more citation."""
    return (raw.withColumn("doi", F.lit(None).cast("string"))
            .withColumn("cited_by_count", F.col("cited_by_count") + 1))


def batch(spark: SparkSession, sf_dir: str, which: int) -> DataFrame:
    """Accepted, de-duplicated rows of upsert batch 1 or 2."""
    raw = raw_works(spark, sf_dir)
    if which == 1:
        return batch_dedup(flatten(in_window(raw, BATCH1)))
    return batch_dedup(flatten(second_snapshot(in_window(raw, BATCH2))))


def spoilt_lines(raw: DataFrame) -> DataFrame:
    """The works as JSON lines (``value``, ``_pos``), some of them spoilt by the order key k = ``_pos``.

    Fixed values: no JSON if k%131=0; else a date that isn't if k%137=0; cited_by_count a word if
    k%139=0, beyond its column if k%149=0, 3.0 if k%151=0; is_retracted 'maybe' if k%157=0, the
    text "FALSE" if k%163=0.
    """
    from worklake.schema import ORDER_COLUMNS, WORK_SCHEMA
    from worklake.sources.works import json_line

    k, line = F.col("_pos"), json_line(raw, [*ORDER_COLUMNS, *WORK_SCHEMA.fieldNames()])
    cited = lambda v: F.regexp_replace(line, '"cited_by_count":(null|-?[0-9]+)', f'"cited_by_count":{v}')
    flag = lambda v: F.regexp_replace(line, '"is_retracted":(true|false)', f'"is_retracted":"{v}"')
    date = F.regexp_replace(line, '"publication_date":"[^"]*"', '"publication_date":"1998-02-30"')
    spoilt = (F.when(k % 131 == 0, F.lit('"no work"')).when(k % 137 == 0, date).when(k % 139 == 0, cited('"many"'))
              .when(k % 149 == 0, cited("3000000000")).when(k % 151 == 0, cited("3.0"))
              .when(k % 157 == 0, flag("maybe")).when(k % 163 == 0, flag("FALSE")).otherwise(line))
    return raw.select("_pos", spoilt.alias("value"))
