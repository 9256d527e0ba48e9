"""Filtered report queries over the stored papers table.

Every report takes the papers DataFrame and a ``FilterState`` and returns a
DataFrame; only bounded results (≤ 10 rows for top-k, one row for KPIs, one
row per calendar day for the trend) ever leave the executors. The filter is
a plain Column predicate with literal bounds, so it reaches the Parquet scan
(``PushedFilters``) and partition pruning.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from worklake.functions.scalar import bool_label, join_list, work_url

# Size of the top-k reports and the rolling-mean window (days).
TOP_K = 10
ROLLING_DAYS = 7

# Columns of the paper list report, in order.
PAPER_LIST_COLUMNS = (
    "openalex_id", "doi", "title", "landing_page_url", "oa_url", "publication_date",
    "publication_year", "work_type", "language", "is_oa", "oa_status", "is_retracted",
    "has_fulltext", "primary_topic_name", "primary_topic_score", "subfield_name",
    "field_name", "source_name", "source_type", "host_organization", "cited_by_count",
    "fwci", "author_count", "countries_count", "institutions_count", "country_codes",
    "ingested_at",
)

# Columns of the display table, in order.
DISPLAY_COLUMNS = (
    "title", "openalex_url", "publication_date", "primary_topic_name", "source_name",
    "oa", "cited_by_count", "author_count", "countries",
)


def _as_date(value) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(str(value))


@dataclass(frozen=True)
class FilterState:
    """Report filter: inclusive date window, optional topic list, OA-only flag."""

    from_date: dt.date
    to_date: dt.date
    topics: tuple[str, ...] = field(default_factory=tuple)
    oa_only: bool = False

    @classmethod
    def make(cls, from_date, to_date, topics=None, oa_only: bool = False) -> "FilterState":
        return cls(_as_date(from_date), _as_date(to_date), tuple(topics or ()), bool(oa_only))

    def predicate(self) -> Column:
        """F5 = F1 ∧ F2 ∧ F3; optional parts are added only when set."""
        cond = F.col("publication_date").between(F.lit(self.from_date), F.lit(self.to_date))
        if self.topics:
            cond = cond & F.col("primary_topic_name").isin(list(self.topics))
        if self.oa_only:
            cond = cond & F.col("is_oa")
        return cond


def filtered(papers: DataFrame, state: FilterState) -> DataFrame:
    return papers.filter(state.predicate())


def paper_list(papers: DataFrame, state: FilterState) -> DataFrame:
    """P2 + T1: the filtered papers, newest first, most cited first (key breaks ties)."""
    return (filtered(papers, state).select(*PAPER_LIST_COLUMNS)
            .orderBy(F.desc("publication_date"), F.desc("cited_by_count"), F.asc("openalex_id")))


def display_table(papers: DataFrame, state: FilterState) -> DataFrame:
    """Presentation columns (work URL, Yes/No, joined country list)."""
    return (paper_list(papers, state)
            .withColumns({
                "openalex_url": work_url(F.col("openalex_id")),
                "oa": bool_label(F.col("is_oa")),
                "countries": join_list(F.col("country_codes")),
            })
            .select(*DISPLAY_COLUMNS))


def by_date(papers: DataFrame, state: FilterState) -> DataFrame:
    """A1 + T3: papers per publication date, ascending."""
    return (filtered(papers, state).groupBy("publication_date")
            .agg(F.count(F.lit(1)).alias("papers")).orderBy("publication_date"))


def _top(df: DataFrame, label: str, k: int = TOP_K) -> DataFrame:
    """Top-k by count, ties broken by the label (TakeOrderedAndProject)."""
    return (df.groupBy(label).agg(F.count(F.lit(1)).alias("papers"))
            .orderBy(F.desc("papers"), F.asc(label)).limit(k))


def top_topics(papers: DataFrame, state: FilterState, k: int = TOP_K) -> DataFrame:
    """A2 + F4: top topics; papers without a topic are left out."""
    df = (filtered(papers, state).filter(F.col("primary_topic_name").isNotNull())
          .select(F.col("primary_topic_name").alias("topic")))
    return _top(df, "topic", k)


def oa_status_breakdown(papers: DataFrame, state: FilterState) -> DataFrame:
    """A3: papers per OA status, NULL reported as 'unknown', all statuses."""
    return (filtered(papers, state)
            .select(F.coalesce("oa_status", F.lit("unknown")).alias("oa_status"))
            .groupBy("oa_status").agg(F.count(F.lit(1)).alias("papers"))
            .orderBy(F.desc("papers"), F.asc("oa_status")))


def top_venues(papers: DataFrame, state: FilterState, k: int = TOP_K) -> DataFrame:
    """A4: top venues; a missing venue counts as 'Unknown'.

    'Unknown' can be a very heavy key; the partial aggregate before the
    shuffle reduces it to one row per map task.
    """
    df = filtered(papers, state).select(F.coalesce("source_name", F.lit("Unknown")).alias("venue"))
    return _top(df, "venue", k)


def top_countries(papers: DataFrame, state: FilterState, k: int = TOP_K) -> DataFrame:
    """A5 + J4: one row per (paper, country); NULL arrays contribute nothing."""
    df = filtered(papers, state).select(F.explode("country_codes").alias("country"))
    return _top(df, "country", k)


def date_bounds(papers: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Earliest and latest publication date; empty table → (as_of, as_of)."""
    today = F.lit(as_of) if as_of else F.current_date()
    return papers.agg(F.coalesce(F.min("publication_date"), today).alias("min_date"),
                      F.coalesce(F.max("publication_date"), today).alias("max_date"))


def topic_list(papers: DataFrame) -> DataFrame:
    """A7 + U1: distinct topic names, ascending."""
    return (papers.filter(F.col("primary_topic_name").isNotNull())
            .select("primary_topic_name").distinct().orderBy("primary_topic_name"))


def kpis(papers: DataFrame, state: FilterState) -> DataFrame:
    """Count, OA %, exact median citations, topics, mean authors, in one row.

    The topics are a group-by of their own: a distinct count beside the median
    would group all rows by topic with a median state each. The median is taken
    over the histogram of citation counts (partially aggregated, one row per
    distinct count).
    Empty selection → 0, 0.0, 0, 0, 0.0.
    """
    rows = filtered(papers, state)
    histogram = rows.groupBy("cited_by_count").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("is_oa").cast("int")).alias("oa"), F.count("is_oa").alias("n_oa"),
        F.sum("author_count").alias("authors"), F.count("author_count").alias("n_authors"))
    return kpis_of(histogram, rows.select("primary_topic_name").distinct())


def kpis_of(histogram: DataFrame, topics: DataFrame) -> DataFrame:
    """A8 of the histogram of citation counts and the distinct topics."""
    one = histogram.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("publications"),
        F.coalesce(F.sum("oa") / F.sum("n_oa") * 100, F.lit(0.0)).alias("oa_pct"),
        F.coalesce(F.expr("percentile(cited_by_count, 0.5D, n)"), F.lit(0.0)).alias("median_citations"),
        F.coalesce(F.sum("authors") / F.sum("n_authors"), F.lit(0.0)).alias("avg_authors"))
    both = one.unionByName(topics.agg(F.count("primary_topic_name").alias("topics")), allowMissingColumns=True)  # two rows
    return both.agg(*[F.max(c).alias(c) for c in (
        "publications", "oa_pct", "median_citations", "topics", "avg_authors")])


def calendar(spark, state: FilterState) -> DataFrame:
    """One row per day of the filter window (bounded by the calendar)."""
    return spark.range(1).select(F.explode(F.sequence(
        F.lit(state.from_date), F.lit(state.to_date), F.expr("INTERVAL 1 DAY"))).alias("publication_date"))


def trend(papers: DataFrame, state: FilterState) -> DataFrame:
    """Gap-free daily series with a 7-day trailing mean (half-even, 1 decimal).

    J5/U3: calendar LEFT JOIN counts, missing days = 0, days outside dropped.
    W1: the window has no partition key, but it runs over one row per day
    of the filter window, never over paper rows.
    """
    return trend_of(papers.sparkSession, by_date(papers, state), state)


def trend_of(spark, counts: DataFrame, state: FilterState) -> DataFrame:
    """E6 of the counts by date."""
    daily = (calendar(spark, state).join(counts, "publication_date", "left")
             .select("publication_date",
                     F.coalesce(F.col("papers"), F.lit(0)).cast("bigint").alias("daily_papers")))
    w = Window.orderBy("publication_date").rowsBetween(-(ROLLING_DAYS - 1), 0)
    return (daily.withColumn("avg_7d", F.bround(F.avg("daily_papers").over(w), 1))
            .orderBy("publication_date"))


def topic_trend(papers: DataFrame, state: FilterState) -> DataFrame:
    """W1 by topic: every day of the filter window for each topic in it, with its 7-day trailing mean.

    Papers are counted per topic and day before any window, so that a topic
    with a third of all papers is as many rows as any other: its days. The
    frame is a range of days and holds for gaps as well; days without papers come from the spine.
    """
    day = F.unix_date("publication_date")
    counts = (filtered(papers, state).where("primary_topic_name IS NOT NULL")
              .groupBy(F.col("primary_topic_name").alias("topic"), "publication_date").agg(F.count(F.lit(1)).alias("n")))
    spine = counts.select("topic").distinct().select("topic", F.explode(F.sequence(
        F.lit(state.from_date), F.lit(state.to_date), F.expr("INTERVAL 1 DAY"))).alias("publication_date"))
    w = Window.partitionBy("topic").orderBy(day).rangeBetween(-(ROLLING_DAYS - 1), 0)
    return (spine.join(counts, ["topic", "publication_date"], "left")
            .select("topic", "publication_date", F.coalesce("n", F.lit(0)).cast("bigint").alias("daily_papers"))
            .withColumn("avg_7d", F.bround(F.avg("daily_papers").over(w), 1)))


def trend_kpis(papers: DataFrame, state: FilterState) -> DataFrame:
    """A10: total, mean per calendar day, peak day (earliest on ties), peak count.

    An all-zero series has no KPIs: the result is then empty.
    """
    return trend_kpis_of(trend(papers, state))


def trend_kpis_of(series: DataFrame) -> DataFrame:
    """A10 of a daily series."""
    return (series.agg(
        F.sum("daily_papers").alias("total"),
        F.avg("daily_papers").alias("avg_per_day"),
        F.min_by("publication_date", F.struct(-F.col("daily_papers"), F.col("publication_date")))
        .alias("peak_day"),
        F.max("daily_papers").alias("peak_count"))
        .filter(F.col("total") > 0))


def ingest_runs(runs: DataFrame, n: int = 5) -> DataFrame:
    """S6 + P4 + T4: the n most recent runs."""
    return (runs.select("id", "fetched_at", "from_date", "to_date", "paper_count", "created_at")
            .orderBy(F.desc("id")).limit(n))


class ResultTooLarge(RuntimeError):
    """A result meant for the driver exceeded its bound."""


def to_local(df: DataFrame, max_rows: int):
    """A bounded result as a pandas frame; refuses to pull more than ``max_rows``,
    the natural bound of the report (its n, its days), which the caller states.

    Reads at most ``max_rows + 1`` rows, so an unexpectedly large result
    fails fast instead of flooding the driver.
    """
    pdf = df.limit(max_rows + 1).toPandas()
    if len(pdf) > max_rows:
        raise ResultTooLarge(f"result has more than {max_rows} rows; write it out instead")
    return pdf


def kpi_labels(k) -> dict[str, str]:
    """Display strings for a ``kpis`` row (numbers stay numbers elsewhere).

    Python's float formatting rounds half-even on the exact binary value, so
    ``0.25`` shows as ``0.2`` and ``2.5`` as ``2`` (not Spark's half-up).
    """
    return {
        "Publications": f"{k['publications']:,}",
        "Open access": f"{k['oa_pct']:.1f}%",
        "Median citations": f"{k['median_citations']:.0f}",
        "Topics": f"{k['topics']:,}",
        "Avg authors": f"{k['avg_authors']:.1f}",
    }


def trend_kpi_labels(k) -> dict[str, str]:
    """Display strings for a ``trend_kpis`` row."""
    return {
        "Total in range": f"{k['total']:,}",
        "Avg per day": f"{k['avg_per_day']:.1f}",
        "Peak day": k["peak_day"].strftime("%Y-%m-%d"),
        "Peak count": f"{k['peak_count']:,}",
    }
