"""One named plan per operator key; each takes (spark, sf_dir) → DataFrame.

Every plan reads the test tables through the binding (``plans.derived``), so
its work grows with the data. Array columns are returned joined with ','
(``country_codes``) to keep results comparable across engines.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from worklake.operators import dedup, dq, page, reports, upsert
from worklake.operators.flatten import REJECT, flatten, rejected
from worklake.operators.runlog import append_run
from worklake.plans import derived as D
from worklake.plans import job
from worklake.schema import KEY, WORK_SCHEMA
from worklake.session import ensure_checkpoint_dir, release, stage
from worklake.sources import tables
from worklake.sources import works as W
from worklake.sources.testdata import SUBFIELD_BASE

QueryFn = Callable[[SparkSession, str], DataFrame]

# Report filters used by the keys.
FULL = reports.FilterState.make(D.FULL_FROM, D.FULL_TO)
FILTERED = reports.FilterState.make("1998-01-01", "1998-12-31",
                                    ["NATION_1", "NATION_7", "NATION_19"], oa_only=True)
SOURCE_WINDOW = (dt.date(1998, 1, 1), dt.date(1998, 12, 31))
SUBFIELD_TERM = "building"


def arrays_as_text(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.array_join(F.col(f.name), ",").alias(f.name) if isinstance(f.dataType, T.ArrayType)
        else F.col(f.name) for f in df.schema.fields])


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def _checks():
    return dq.default_checks(D.EXPECTED_SUBFIELD, D.AS_OF)


def _check(name: str) -> dq.Check:
    return next(c for c in _checks() if c.name == name)


# --- flatten / reject / dedup -------------------------------------------------

def flatten_papers(spark, sf):
    return arrays_as_text(D.flat_works(spark, sf))


def flatten_rejects(spark, sf):
    return (rejected(D.flat_works(spark, sf))
            .select("_src", "_pos", KEY, REJECT))


def first_wins_fetch(spark, sf):
    return dedup.fetch_dedup(D.raw_works(spark, sf)).select("id", "_src", "_pos", "title")


def first_wins_batch(spark, sf):
    return dedup.batch_dedup(D.flat_works(spark, sf)).select(KEY, "_src", "_pos", "title")


def ingest_counters(spark, sf):
    return dedup.ingest_counters(D.raw_works(spark, sf))


# --- sources ------------------------------------------------------------------

def subfield_lookup(spark, sf):
    """The dimension of the works, with 30 longer names beside each that contain it."""
    dim = W.subfields(D.raw_works(spark, sf))
    longer = dim.select(F.explode(F.sequence(F.lit(0), F.lit(29))).alias("i"), "id", "display_name").select(
        F.concat_ws("/", "id", F.col("i").cast("string")).alias("id"),
        F.concat(F.lit("A"), F.lpad(F.col("i").cast("string"), 2, "0"), F.lit(" "), "display_name",
                 F.lit(" and more")).alias("display_name"))
    found = W.resolve_subfield(dim.unionByName(longer), SUBFIELD_TERM)  # as the job does
    return W.lookup_subfield(dim.unionByName(longer), found["display_name"])


def source_filter(spark, sf):
    raw = D.raw_works(spark, sf)
    return (W.select_recent(raw, SUBFIELD_BASE + SUBFIELD_TERM.upper(), *SOURCE_WINDOW)
            .select("id", "publication_date", "title", "_src", "_pos"))


def classification_mismatches(spark, sf):
    return dq.classification_mismatches(D.raw_works(spark, sf), SUBFIELD_TERM)


def export_round_trip(spark, sf):
    """S4 then S3: write the raw works as an export, read it back, flatten."""
    out = scratch(spark, "exports")
    header = {"fetched_at": D.LOAD_TS.isoformat(timespec="seconds"),
              "subfield": {"id": SUBFIELD_BASE + "BUILDING", "display_name": "BUILDING"},
              "date_range": {"from": D.FULL_FROM.isoformat(), "to": D.FULL_TO.isoformat()},
              "stamp": D.LOAD_TS.strftime("%Y%m%d_%H%M%S")}
    folder = W.write_export(D.raw_works(spark, sf), out, header)
    return arrays_as_text(flatten(W.read_export_folder(spark, folder)))


# --- reports ------------------------------------------------------------------

def papers_list(spark, sf):
    return arrays_as_text(reports.paper_list(D.papers(spark, sf), FULL))


def papers_filtered_topics_oa(spark, sf):
    return arrays_as_text(reports.paper_list(D.papers(spark, sf), FILTERED))


def papers_display(spark, sf):
    return reports.display_table(D.papers(spark, sf), FULL)


def papers_by_date(spark, sf):
    return reports.by_date(D.papers(spark, sf), FULL)


def top_topics(spark, sf):
    return reports.top_topics(D.papers(spark, sf), FULL)


def oa_status_breakdown(spark, sf):
    return reports.oa_status_breakdown(D.papers(spark, sf), FULL)


def top_venues(spark, sf):
    return reports.top_venues(D.papers(spark, sf), FULL)


def top_countries(spark, sf):
    return reports.top_countries(D.papers(spark, sf), FULL)


def date_bounds(spark, sf):
    return reports.date_bounds(D.papers(spark, sf), D.AS_OF)


def page_view(spark, sf):
    """E5: all tables of the report page as rows, from one scan."""
    return page.page_rows(page.page_view(D.papers(spark, sf), FULL))


def page_view_filtered(spark, sf):
    return page.page_rows(page.page_view(D.papers(spark, sf), FILTERED))


def stored_date_bounds(spark, sf):
    """A6 of a stored table, from file footers."""
    table = scratch(spark, "table")
    upsert.upsert_table(spark, table, dedup.batch_dedup(D.flat_works(spark, sf)), D.LOAD_TS)
    return page.stored_date_bounds(spark, table, D.AS_OF)


def topic_list(spark, sf):
    return reports.topic_list(D.papers(spark, sf))


def kpis(spark, sf):
    k = reports.kpis(D.papers(spark, sf), FULL)
    return k.select("publications", F.round("oa_pct", 4).alias("oa_pct"), "median_citations",
                    "topics", F.round("avg_authors", 4).alias("avg_authors"))


def trend_7d(spark, sf):
    return reports.trend(D.papers(spark, sf), FULL)


def trend_kpis(spark, sf):
    t = reports.trend_kpis(D.papers(spark, sf), FULL)
    return t.select("total", F.round("avg_per_day", 4).alias("avg_per_day"), "peak_day", "peak_count")


def recent_runs(spark, sf):
    return reports.ingest_runs(D.runs(spark, sf))


# --- data quality -------------------------------------------------------------

def dq_duplicate_key(spark, sf):
    return dq.duplicate_keys(D.valid_rows(spark, sf))


def _row_check(name: str) -> QueryFn:
    def run(spark, sf):
        return arrays_as_text(_check(name).violations(D.papers(spark, sf)))
    run.__name__ = f"dq_{name}"
    return run


def dq_ingest_reconciliation(spark, sf):
    return dq.reconcile(D.papers(spark, sf), D.runs(spark, sf))


def dq_reconcile_runs(spark, sf):
    """Every run of the log against the rows of its window."""
    return dq.reconcile_runs(D.papers(spark, sf), D.runs(spark, sf))


def landing_window(spark, sf):
    """The source query over a landing parted by publication month."""
    path = scratch(spark, "landing")
    W.write_landing(D.raw_works(spark, sf), path)
    return (W.read_window(spark, path, SUBFIELD_BASE + SUBFIELD_TERM.upper(), *SOURCE_WINDOW)
            .select("id", "publication_date", "title", "_src", "_pos"))


def trend_by_topic(spark, sf):
    return reports.topic_trend(D.papers(spark, sf), FULL)


#: Columns that the checks count by.
COUNTED = (KEY, "publication_date", "publication_year", "is_oa", "oa_status", "primary_topic_name", "primary_topic_score",
           "subfield_name", "field_name", "cited_by_count", "fwci", "citation_percentile", "is_top_1_percent", "is_top_10_percent",
           "referenced_works_count", "author_count", "countries_count", "country_codes")


def _dq_summary(spark, sf):
    papers = stage(D.papers(spark, sf).select(*COUNTED), "papers")  # read by two passes
    return dq.summary(papers, D.runs(spark, sf), _checks())


def dq_summary(spark, sf):
    return _dq_summary(spark, sf)


def dq_samples(spark, sf):
    papers = stage(D.papers(spark, sf), "papers")  # read by three passes
    return dq.samples(papers, _checks(), runs=D.runs(spark, sf))


def dq_gate(spark, sf):
    return dq.gate_frame(_dq_summary(spark, sf))


# --- load ---------------------------------------------------------------------

def upsert_merge(spark, sf):
    """Two overlapping loads through the stored table."""
    table = scratch(spark, "table")
    upsert.upsert_table(spark, table, D.batch(spark, sf, 1), D.LOAD_TS)
    upsert.upsert_table(spark, table, D.batch(spark, sf, 2), D.LOAD2_TS)
    return arrays_as_text(upsert.read_table(spark, table))


def upsert_idempotent(spark, sf):
    """All papers loaded twice, the second time into other buckets: the rows of the first load."""
    table = scratch(spark, "table")
    inc = dedup.batch_dedup(D.flat_works(spark, sf))
    upsert.upsert_table(spark, table, inc, D.LOAD_TS)
    upsert.upsert_table(spark, table, inc, D.LOAD2_TS, buckets=5)
    return arrays_as_text(upsert.read_table(spark, table))


def run_log_append(spark, sf):
    """The run log of a table to which one run per year, then one over all works, was appended."""
    table = scratch(spark, "table")
    for r in D.runs(spark, sf).orderBy("id").collect():  # one row per calendar year
        append_run(spark, table, r.asDict(), r["paper_count"], r["created_at"])
    header = {"fetched_at": D.LOAD_TS, "from_date": D.FULL_FROM, "to_date": D.FULL_TO,
              "subfield_id": SUBFIELD_BASE + D.EXPECTED_SUBFIELD}
    append_run(spark, table, header, D.raw_works(spark, sf).count(), D.LOAD_TS)
    return tables.read_runs(spark, table)


def _verdicts(raw: DataFrame) -> DataFrame:
    flat = flatten(raw)
    valid = F.col(REJECT).isNull()
    return (flat.select(KEY, REJECT, F.when(valid, F.col("cited_by_count")).alias("cited_by_count"),
                        F.when(valid, F.col("is_retracted")).alias("is_retracted"))
            .groupBy(KEY, REJECT, "cited_by_count", "is_retracted").agg(F.count(F.lit(1)).alias("n")))


def _spoilt_landing(spark, sf) -> DataFrame:
    path = scratch(spark, "landing")
    D.spoilt_lines(D.raw_works(spark, sf)).select("value").write.options(**W.PACKED).text(path)
    return W.read_works(spark, path)


def landing_verdicts(spark, sf):
    return _verdicts(_spoilt_landing(spark, sf))


def landing_counters(spark, sf):
    return dedup.ingest_counters(_spoilt_landing(spark, sf))


def envelope_verdicts(spark, sf):
    """The same records as papers of envelopes of a few thousand orders each."""
    path = scratch(spark, "envelopes")
    papers = D.spoilt_lines(D.raw_works(spark, sf)).groupBy(F.floor(F.col("_pos") / 2000).alias("g")).agg(
        F.concat(F.lit('{"fetched_at": "2001-08-02T00:00:00", "papers": ['), F.array_join(F.collect_list("value"), ", "),
                 F.lit("]}")).alias("value"))
    # One line is one document: one file each.
    papers.select("value").write.option("maxRecordsPerFile", 1).options(**W.PACKED).text(path)
    return _verdicts(W.read_export(spark, path))


def envelope_records(spark, sf):
    """Places of the papers in envelopes of a few thousand orders each, and the envelopes' own counts."""
    path = scratch(spark, "envelopes")
    raw = D.raw_works(spark, sf)
    line = F.struct("_src", "_pos", W.json_line(raw, WORK_SCHEMA.fieldNames()).alias("line"))
    group = raw.groupBy(F.floor(F.col("_pos") / 2000).alias("g")).agg(F.array_sort(F.collect_list(line)).alias("w"))
    document = F.concat(F.lit('{"papers": ['), F.array_join("w.line", ", "), F.lit('], "subfield": {"id": "'), "g",
                        F.lit('"}, "count": '), F.size("w"), F.lit("}"))
    group.select(document.alias("value")).write.option("maxRecordsPerFile", 1).options(**W.PACKED).text(path)
    own = W.read_envelopes(spark, path).select("_src", F.col("subfield.id").cast("long").alias("envelope"), "count")
    return W.read_export(spark, path).join(own, "_src").select("envelope", "count", F.col("_pos").alias("place"), "id", "title")


def _job(spark, sf) -> tuple[str, job.JobConfig]:
    """Landed works and the configuration of the job keys."""
    header = {"fetched_at": D.LOAD_TS.isoformat(timespec="seconds"),
              "subfield": {"id": SUBFIELD_BASE + D.EXPECTED_SUBFIELD, "display_name": D.EXPECTED_SUBFIELD},
              "date_range": {"from": D.FULL_FROM.isoformat(), "to": D.FULL_TO.isoformat()}}
    landed = W.write_export(D.raw_works(spark, sf), scratch(spark, "landing"), header)
    cfg = job.JobConfig(table=scratch(spark, "table"), landing=f"{landed}/papers", subfield_search=SUBFIELD_TERM,
                        as_of=D.JOB_TO, days_back=(D.JOB_TO - D.JOB_FROM).days, save_export=True,
                        export_dir=scratch(spark, "exports"), fail_on_dq_errors=False)
    return landed, cfg


def job_run_batch(spark, sf):
    """Landing to stored table."""
    _, cfg = _job(spark, sf)
    job.run_batch(spark, cfg)
    stored = upsert.read_table(spark, cfg.table).withColumn("ingested_at", F.lit(D.LOAD_TS).cast("timestamp"))
    return arrays_as_text(stored)


def job_manifest(spark, sf):
    """The manifest of the export that a run saves."""
    _, cfg = _job(spark, sf)
    m = W.read_manifest(spark, job.run_batch(spark, cfg).export_path)
    return m.select(m["filters"]["primary_topic.subfield.id"].alias("subfield_id"),
                    m["filters"]["from_publication_date"].alias("from_date"),
                    m["filters"]["to_publication_date"].alias("to_date"), "count", "duplicates_skipped")


def job_from_export(spark, sf):
    """A saved export loaded into a new table: its run row and the stored papers."""
    _, cfg = _job(spark, sf)
    export = job.run_batch(spark, cfg).export_path
    again = job.JobConfig(table=scratch(spark, "table"), run_data_quality=False)
    job.run_from_export(spark, export, again)
    stored = upsert.read_table(spark, again.table).count()
    return tables.read_runs(spark, again.table).select(
        "id", "subfield_id", "from_date", "to_date", "paper_count", F.lit(stored).cast("long").alias("stored"))


def incremental_ingest(spark, sf):
    """Land the raw works as one export, stream its files in with foreachBatch
    upserts, read the resulting table.

    Works are dealt to the files by their place, so that copies of a work lie in
    different files and micro-batches, in any order. There are as many files as a shuffle
    has partitions, in two micro-batches.
    """
    from worklake.streaming.incremental import incremental_ingest as run

    root = scratch(spark, "stream")
    header = {"fetched_at": D.LOAD_TS.isoformat(timespec="seconds"), "stamp": D.LOAD_TS.strftime("%Y%m%d_%H%M%S")}
    files = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    W.write_export(D.raw_works(spark, sf, files), f"{root}/landing", header)
    release(spark)  # line items and orders as they were dealt
    run(spark, f"{root}/landing/*/papers", f"{root}/table", f"{root}/checkpoint", D.LOAD_TS, max_files_per_trigger=-(-files // 2))
    return arrays_as_text(upsert.read_table(spark, f"{root}/table"))


QUERIES: dict[str, QueryFn] = {
    "flatten_papers": flatten_papers,
    "flatten_rejects": flatten_rejects,
    "first_wins_fetch": first_wins_fetch,
    "first_wins_batch": first_wins_batch,
    "ingest_counters": ingest_counters,
    "subfield_lookup": subfield_lookup,
    "source_filter": source_filter,
    "classification_mismatches": classification_mismatches,
    "papers_list": papers_list,
    "papers_filtered_topics_oa": papers_filtered_topics_oa,
    "papers_display": papers_display,
    "papers_by_date": papers_by_date,
    "top_topics": top_topics,
    "oa_status_breakdown": oa_status_breakdown,
    "top_venues": top_venues,
    "top_countries": top_countries,
    "date_bounds": date_bounds,
    "page_view": page_view,
    "page_view_filtered": page_view_filtered,
    "stored_date_bounds": stored_date_bounds,
    "topic_list": topic_list,
    "kpis": kpis,
    "trend_7d": trend_7d,
    "trend_kpis": trend_kpis,
    "dq_duplicate_key": dq_duplicate_key,
    "dq_id_format": _row_check("openalex_id_format"),
    "dq_year_matches_date": _row_check("publication_year_matches_date"),
    "dq_subfield": _row_check("ai_subfield"),
    "dq_date_sanity": _row_check("publication_date_sanity"),
    "dq_oa_consistency": _row_check("oa_flag_status_consistency"),
    "dq_percentile_hierarchy": _row_check("citation_percentile_hierarchy"),
    "dq_metric_ranges": _row_check("non_negative_metrics"),
    "dq_countries_count": _row_check("countries_count_matches_array"),
    "dq_missing_hierarchy": _row_check("missing_topic_hierarchy"),
    "dq_ingest_reconciliation": dq_ingest_reconciliation,
    "dq_reconcile_runs": dq_reconcile_runs,
    "landing_window": landing_window,
    "trend_by_topic": trend_by_topic,
    "dq_summary": dq_summary,
    "dq_samples": dq_samples,
    "dq_gate": dq_gate,
    "upsert_merge": upsert_merge,
    "upsert_idempotent": upsert_idempotent,
    "run_log_append": run_log_append,
    "landing_verdicts": landing_verdicts,
    "landing_counters": landing_counters,
    "envelope_verdicts": envelope_verdicts,
    "envelope_records": envelope_records,
    "job_run_batch": job_run_batch,
    "job_manifest": job_manifest,
    "job_from_export": job_from_export,
    "recent_runs": recent_runs,
    "export_round_trip": export_round_trip,
    "incremental_ingest": incremental_ingest,
}
