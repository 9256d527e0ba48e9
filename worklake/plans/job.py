"""Job entry points: batch run, load from export, ingest, recent selection.

    spark-submit -m worklake.plans.job --landing <dir> --table <dir> [...]

Paths are folders (HDFS / object store on a cluster). A run:

  ensure tables → scan landing (S1) → resolve subfield (S2) → source filter
  (F6) → fetch-time dedup (M1) → classification check (Q15) → optional
  export (S4) → flatten / reject / first-wins (P1 F7 M2) → upsert (M3),
  put in force with its run-log row by one log row (M4/M5) → DQ (Q12) →
  gate (Q13/Q14).

DQ results are always returned (and may be persisted) before the gate
raises, so a failing run still leaves its full report.
"""

from __future__ import annotations

import argparse
import datetime as dt
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from worklake.operators import dedup, dq, runlog, upsert
from worklake.operators.flatten import REJECT, assert_no_constraint_violations, flatten
from worklake.session import stage, unstage
from worklake.sources import works as W
from worklake.sources.tables import ensure_tables, read_runs

# Job defaults (days back, searched subfield).
DEFAULT_DAYS_BACK = 3
DEFAULT_SUBFIELD_SEARCH = "Artificial Intelligence"


@dataclass
class JobConfig:
    table: str
    landing: str | None = None
    days_back: int = DEFAULT_DAYS_BACK
    subfield_search: str = DEFAULT_SUBFIELD_SEARCH
    export_dir: str | None = None
    save_export: bool = False
    run_data_quality: bool = True
    fail_on_dq_errors: bool = True
    fail_on_dq_warnings: bool = False
    strict: bool = False                         # fail on values that the table can't store
    buckets: int | None = None                   # of the stored table; None keeps or derives them
    as_of: dt.date | None = None
    dq_report: str | None = None

    def date_range(self) -> tuple[dt.date, dt.date]:
        """Window ending today (``as_of``), ``days_back`` days long; 0 = today only."""
        today = self.as_of or dt.date.today()
        return today - dt.timedelta(days=self.days_back), today


@dataclass
class IngestResult:
    ingest_run_id: int
    upserted: int
    skipped_invalid: int
    duplicates_in_file: int
    papers: int
    row_checks: dict[str, int] = field(default_factory=dict)  # violations among the rows of this load


@dataclass
class PipelineResult:
    ingest: IngestResult | None
    data_quality: list = field(default_factory=list)
    export_path: str | None = None
    duplicates_skipped: int = 0


def ingest(spark: SparkSession, raw: DataFrame, header: dict, cfg: JobConfig,
           loaded_at: dt.datetime | None = None) -> IngestResult:
    """Flatten, reject, de-duplicate, then store facts and run row together (E3 inner).

    One job: the counters (A13) and the row checks of the load's rows are observed
    while its rows are merged. Only ``strict`` reads the batch before.
    """
    runlog.validate_header(header)  # the run row is required: fail before writing facts
    ensure_tables(spark, cfg.table)
    loaded_at = loaded_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    flat = flatten(raw)
    if cfg.strict:
        assert_no_constraint_violations(flat)
    seen, checked = Observation("flattened"), Observation("sent rows")
    checks = [c for c in dq.default_checks(cfg.subfield_search, cfg.as_of) if c.predicate is not None]
    counted = flat.observe(seen, F.count(F.lit(1)).alias("papers"), F.count_if(F.col(REJECT).isNotNull()).alias("invalid"))
    batch = dedup.batch_dedup(counted).observe(checked, *[dq.count_if_true(c.predicate).alias(c.name) for c in checks])

    def run() -> dict:
        return runlog.run_fields(header, upsert.observed(seen).get("papers", 0), loaded_at)

    sent, run_id = upsert.load(spark, cfg.table, batch, loaded_at, run, cfg.buckets)
    c = {"papers": 0, "invalid": 0, **upsert.observed(seen)}
    found = {c.name: 0 for c in checks} | upsert.observed(checked)
    return IngestResult(run_id, sent, c["invalid"], c["papers"] - c["invalid"] - sent, c["papers"], found)


def run_quality(spark: SparkSession, cfg: JobConfig, subfield_name: str | None = None) -> list:
    papers = upsert.read_table(spark, cfg.table)
    checks = dq.default_checks(subfield_name or cfg.subfield_search, cfg.as_of)
    results = dq.run_checks(papers, read_runs(spark, cfg.table), checks)
    if cfg.dq_report:
        dq.result_frame(spark, results).withColumn("run_at", F.current_timestamp()).write.mode("append").parquet(cfg.dq_report)
    return results


def _gate(cfg: JobConfig, results: list) -> None:
    if cfg.fail_on_dq_errors or cfg.fail_on_dq_warnings:  # errors always fail once it runs
        dq.gate(results, fail_on_warnings=cfg.fail_on_dq_warnings)


def select_recent(spark: SparkSession, cfg: JobConfig) -> tuple[DataFrame, dict, int]:
    """Subfield lookup, date window, M1 dedup and classification check.

    Besides the subfield list only the window is read, once: its records are
    staged, and all later steps read the staged copy.
    """
    sub = W.resolve_subfield(W.landed_subfields(spark, cfg.landing), cfg.subfield_search)
    start, end = cfg.date_range()
    found = Observation("selected")
    has_id = F.coalesce(F.col("id") != "", F.lit(False))
    window = W.read_window(spark, cfg.landing, sub["id"], start, end).observe(found, F.count_if(has_id).alias("n"))
    selected = stage(dedup.fetch_dedup(window), "selected")
    # Records with an id that the first-wins step dropped: those it read less those it kept.
    skipped = found.get["n"] - selected.where(has_id).count()
    dq.assert_classification(selected, cfg.subfield_search)
    header = {"fetched_at": dt.datetime.now().replace(microsecond=0),
              "subfield": sub, "from_date": start, "to_date": end, "subfield_id": sub["id"]}
    return selected, header, skipped


def run_batch(spark: SparkSession, cfg: JobConfig) -> PipelineResult:
    """The full run from the landing folder."""
    selected, header, skipped = select_recent(spark, cfg)
    export_path = None
    try:
        if cfg.save_export and cfg.export_dir:
            newest_first = W.select_recent(selected, header["subfield_id"], header["from_date"], header["to_date"])
            export_path = W.write_export(newest_first, cfg.export_dir, {
                "fetched_at": header["fetched_at"].isoformat(timespec="seconds"),
                "subfield": header["subfield"],
                "date_range": {"from": header["from_date"].isoformat(), "to": header["to_date"].isoformat()},
            }, duplicates_skipped=skipped)
        result = ingest(spark, selected, header, cfg)
    finally:
        unstage(selected)
    dq_results = run_quality(spark, cfg, header["subfield"]["display_name"])
    _gate(cfg, dq_results)
    return PipelineResult(result, dq_results, export_path, skipped)


def _export_parts(spark: SparkSession, path: str) -> list[tuple[DataFrame, dict]]:
    """(raw works, header) of an export folder, or of each envelope at ``path`` in order."""
    if path.rstrip("/").split("/")[-1].startswith("run="):
        m = W.read_manifest(spark, path)
        header = runlog.envelope_headers(m.withColumn("_src", F.lit(path))).first()
        return [(W.read_export_folder(spark, path), header.asDict())]
    envelopes = W.read_envelopes(spark, path)
    W.check_envelopes(envelopes)
    # One header per envelope file: rows in the number of files, not of papers.
    headers = runlog.envelope_headers(envelopes).orderBy("fetched_at", "_src").collect()
    return [(W.read_export(spark, unquote(h["_src"])), h.asDict()) for h in headers]  # file names are URIs


def ingest_exports(spark: SparkSession, path: str, cfg: JobConfig) -> list[tuple[IngestResult, dict]]:
    """Load an export folder, or each envelope with a run row of its own, oldest first."""
    parts = _export_parts(spark, path)
    for _, header in parts:
        runlog.validate_header(header)
    return [(ingest(spark, raw, header, cfg), header) for raw, header in parts]


def ingest_export(spark: SparkSession, path: str, cfg: JobConfig) -> IngestResult:
    """E3 without DQ; for several envelopes the last one's result."""
    return ingest_exports(spark, path, cfg)[-1][0]


def run_from_export(spark: SparkSession, path: str, cfg: JobConfig) -> PipelineResult:
    """Ingest an export, then optional DQ and gate. The expected subfield is the export's own."""
    result, header = ingest_exports(spark, path, cfg)[-1]
    dq_results = run_quality(spark, cfg, header.get("subfield_name")) if cfg.run_data_quality else []
    if cfg.run_data_quality:
        _gate(cfg, dq_results)
    return PipelineResult(result, dq_results, path)


def main(argv: list[str] | None = None) -> int:
    """Thin command line."""
    from worklake.session import build_session

    ap = argparse.ArgumentParser(prog="worklake")
    ap.add_argument("--table", required=True)
    ap.add_argument("--landing")
    ap.add_argument("--from-export", dest="export_path")
    ap.add_argument("--days-back", type=int, default=DEFAULT_DAYS_BACK)
    ap.add_argument("--subfield", default=DEFAULT_SUBFIELD_SEARCH)
    ap.add_argument("--save-export", action="store_true")
    ap.add_argument("--export-dir")
    ap.add_argument("--skip-dq", action="store_true", help="only with --from-export")
    ap.add_argument("--fail-on-warnings", action="store_true")
    ap.add_argument("--dq-report")
    ap.add_argument("--buckets", type=int, help="buckets of the stored table, about its bytes by 128 MB")
    ap.add_argument("--strict", action="store_true", help="fail on values that the table can't store")
    a = ap.parse_args(argv)
    cfg = JobConfig(table=a.table, landing=a.landing, days_back=a.days_back,
                    subfield_search=a.subfield, export_dir=a.export_dir, save_export=a.save_export,
                    run_data_quality=not (a.skip_dq and a.export_path),
                    fail_on_dq_warnings=a.fail_on_warnings, dq_report=a.dq_report,
                    strict=a.strict, buckets=a.buckets)
    spark = build_session()
    try:
        res = run_from_export(spark, a.export_path, cfg) if a.export_path else run_batch(spark, cfg)
    except dq.DataQualityError as e:
        print(e)
        return 1
    i = res.ingest
    print(f"run {i.ingest_run_id}: upserted {i.upserted}, invalid {i.skipped_invalid}, "
          f"duplicates {i.duplicates_in_file}")
    for line in dq.report_lines(res.data_quality):
        print(line)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
