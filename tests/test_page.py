"""The page from one scan, and bounds from footers."""

import datetime as dt
from dataclasses import fields

import pytest
from pyspark.sql import functions as F

from test_plans import plan
from worklake.operators import page, reports, upsert
from worklake.operators.dedup import batch_dedup
from worklake.operators.flatten import flatten
from worklake.plans import derived as D
from worklake.plans.queries import FILTERED, FULL
from worklake.schema import PAPERS_SCHEMA
from worklake.sources.tables import ensure_tables


@pytest.fixture(scope="module")
def table(spark, sf_small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("page") / "papers")
    upsert.upsert_table(spark, path, batch_dedup(flatten(D.raw_works(spark, sf_small))), D.LOAD_TS)
    return path


def _rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("state", [FULL, FILTERED, reports.FilterState.make("1960-01-01", "1960-01-09")])
def test_page_equals_the_single_reports(spark, table, state):
    papers = upsert.read_table(spark, table)
    got = page.page_view(papers, state)
    single = {"by_date": reports.by_date, "topics": reports.top_topics, "oa_status": reports.oa_status_breakdown,
              "venues": reports.top_venues, "countries": reports.top_countries, "kpis": reports.kpis,
              "trend": reports.trend, "trend_kpis": reports.trend_kpis}
    assert set(single) == {f.name for f in fields(page.Page)}
    for name, report in single.items():
        assert getattr(got, name).columns == report(papers, state).columns
        assert _rows(getattr(got, name)) == _rows(report(papers, state)), name


def test_one_scan_and_one_shuffle(spark, table):
    text = plan(page.groupings(upsert.read_table(spark, table), FILTERED))
    tree = text.split("(1)")[0]
    assert tree.count("Scan parquet") == 1 and tree.count("Exchange") == 1 and "partial_count" in text
    pushed = [line for line in text.splitlines() if "PushedFilters" in line][0]
    assert "publication_date" in pushed and "title" not in [line for line in text.splitlines() if "ReadSchema" in line][0]
    # Each table reads its own part of the counts.
    text = plan(page.page_view(upsert.read_table(spark, table), FULL).venues)
    assert "(grouping#" in [line for line in text.splitlines() if "PartitionFilters" in line][0] and "TakeOrderedAndProject" in text


def test_bounds_come_from_footers(spark, table, tmp_path):
    df = page.stored_date_bounds(spark, table)
    assert "PushedAggregation: [MIN(publication_date), MAX(publication_date)]" in plan(df)
    assert _rows(df) == _rows(reports.date_bounds(upsert.read_table(spark, table)))
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""
    empty, as_of = str(tmp_path / "empty"), dt.date(1999, 12, 31)
    ensure_tables(spark, empty)
    assert _rows(page.stored_date_bounds(spark, empty, as_of)) == [(as_of, as_of)]
    upsert.upsert_table(spark, empty, spark.createDataFrame([], PAPERS_SCHEMA).drop("ingested_at"), D.LOAD_TS)
    assert _rows(page.stored_date_bounds(spark, empty, as_of)) == [(as_of, as_of)]


def test_null_countries_and_labels(spark):
    papers = spark.range(4).select(
        F.lit(dt.date(2000, 1, 1)).alias("publication_date"), F.lit(None).cast("string").alias("primary_topic_name"),
        F.lit(None).cast("string").alias("oa_status"), F.lit(None).cast("string").alias("source_name"),
        F.when(F.col("id") > 0, F.array(F.lit("US"), F.lit("DE"))).alias("country_codes"),
        F.col("id").cast("int").alias("cited_by_count"), (F.col("id") == 1).alias("is_oa"), F.lit(2).cast("short").alias("author_count"))
    got = page.page_view(papers, reports.FilterState.make("2000-01-01", "2000-01-01"))
    assert _rows(got.countries) == [("DE", 3), ("US", 3)] and _rows(got.topics) == []
    assert _rows(got.oa_status) == [("unknown", 4)] and _rows(got.venues) == [("Unknown", 4)]
    assert _rows(got.kpis) == [(4, 25.0, 1.5, 0, 2.0)]
