"""A report page from one scan, and date bounds from file footers.

All breakdowns of a page are groupings of the same filtered papers. One scan
turns each paper into one row per grouping it belongs to (its day, topic,
status, venue, citation count, and each of its countries), like GROUPING SETS
but without repeating a paper's rows once per country; one partial aggregate and one
shuffle then count all groupings at once. The counts are written by grouping,
and every table of the page reads its own part of them only.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worklake.operators import reports
from worklake.schema import PAPERS_SCHEMA
from worklake.session import ensure_checkpoint_dir
from worklake.sources import tables

CUBE = "grouping string, label string, day date, number int, papers bigint, oa bigint, n_oa bigint, authors bigint, n_authors bigint"


def groupings(papers: DataFrame, state: reports.FilterState) -> DataFrame:
    """(grouping, label / day / number, counts) of the filtered papers, in one pass."""
    def key(grouping, label=None, day=None, number=None):
        return F.struct(F.lit(grouping).alias("grouping"), (F.lit(None).cast("string") if label is None else label).alias("label"),
                        (F.lit(None).cast("date") if day is None else day).alias("day"),
                        (F.lit(None).cast("int") if number is None else number).alias("number"))

    own = F.array(
        key("day", day=F.col("publication_date")), key("topic", F.col("primary_topic_name")),
        key("status", F.coalesce("oa_status", F.lit("unknown"))), key("venue", F.coalesce("source_name", F.lit("Unknown"))),
        key("citations", number=F.col("cited_by_count")))
    countries = F.transform(F.coalesce("country_codes", F.array().cast("array<string>")), lambda c: key("country", c))
    each = reports.filtered(papers, state).select(F.explode(F.concat(own, countries)).alias("k"), "is_oa", "author_count")
    return each.groupBy("k.grouping", "k.label", "k.day", "k.number").agg(
        F.count(F.lit(1)).alias("papers"), F.sum(F.col("is_oa").cast("int")).alias("oa"), F.count("is_oa").alias("n_oa"),
        F.sum("author_count").alias("authors"), F.count("author_count").alias("n_authors"))


@dataclass(frozen=True)
class Page:
    """The tables of a report page; ``reports`` has the same ones, each with a scan of its own."""

    by_date: DataFrame
    topics: DataFrame
    oa_status: DataFrame
    venues: DataFrame
    countries: DataFrame
    kpis: DataFrame
    trend: DataFrame
    trend_kpis: DataFrame


def page_view(papers: DataFrame, state: reports.FilterState, k: int = reports.TOP_K) -> Page:
    """All tables of a page from one scan of ``papers``.

    The counts (one row per day, topic, venue, ...) are written under the checkpoint folder, parted by grouping.
    """
    import uuid

    spark = papers.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/page-{uuid.uuid4().hex[:12]}"
    groupings(papers, state).write.partitionBy("grouping").parquet(folder)
    cube = spark.read.schema(CUBE).parquet(folder)

    def part(grouping):
        return cube.where(F.col("grouping") == grouping)

    def ranked(grouping, name):
        return (part(grouping).where("label IS NOT NULL").select(F.col("label").alias(name), "papers")
                .orderBy(F.desc("papers"), F.asc(name)))

    by_date = part("day").select(F.col("day").alias("publication_date"), "papers").orderBy("publication_date")
    trend = reports.trend_of(spark, by_date, state)
    return Page(
        by_date, ranked("topic", "topic").limit(k), ranked("status", "oa_status"), ranked("venue", "venue").limit(k),
        ranked("country", "country").limit(k),
        reports.kpis_of(part("citations").select(F.col("number").alias("cited_by_count"), F.col("papers").alias("n"),
                                                 "oa", "n_oa", "authors", "n_authors"),
                        part("topic").select(F.col("label").alias("primary_topic_name"))),
        trend, reports.trend_kpis_of(trend))


def page_rows(page: Page) -> DataFrame:
    """The page as rows (report, label, measure, value), for export."""
    out = None
    for table in fields(Page):
        df = getattr(page, table.name)
        label = F.lit("") if table.name in ("kpis", "trend_kpis") else F.col(df.columns[0]).cast("string")
        values = [c for c in df.columns if table.name == "kpis" or c != df.columns[0] or table.name == "trend_kpis"]
        rows = df.select(F.lit(table.name).alias("report"), label.alias("label"), F.explode(F.array(*[
            F.struct(F.lit(c).alias("measure"), _number(df, c).alias("value")) for c in values])).alias("m"))
        rows = rows.select("report", "label", "m.measure", "m.value")
        out = rows if out is None else out.unionByName(rows)
    return out


def _number(df: DataFrame, column: str):
    """A measure as a double; a day as its number."""
    if dict(df.dtypes)[column] == "date":
        return F.unix_date(column).cast("double")
    return F.round(F.col(column).cast("double"), 4)


def stored_date_bounds(spark: SparkSession, table: str, as_of: dt.date | None = None) -> DataFrame:
    """A6 of a stored table from the footers of its files: no row is read.

    The files are read through the V2 source, which pushes MIN and MAX down. That is set in a
    session of its own; the caller's settings stay as they are.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    version = tables.table_state(spark, table).version
    papers = (own.createDataFrame([], PAPERS_SCHEMA) if version is None
              else own.read.schema(PAPERS_SCHEMA).parquet(tables.version_folder(table, version)))
    return reports.date_bounds(papers, as_of)
