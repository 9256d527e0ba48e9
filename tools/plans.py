"""Print the physical plan trees of the headline flows (for docs/PLANS.md).

    python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    head = text.split("\n\n\n")[0]
    keep = [ln for ln in text.splitlines()
            if ln.startswith(("PushedFilters", "PartitionFilters")) and ln.rstrip() not in
            ("PushedFilters: []", "PartitionFilters: []")]
    return head + ("\n" + "\n".join(keep) if keep else "")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    scratch = tempfile.mkdtemp(prefix="worklake-plans-", dir="/tmp")
    from worklake.session import build_session

    spark = build_session("local[8]", 8, extra={"spark.checkpoint.dir": f"{scratch}/ckpt"})
    from worklake.operators import dedup, dq, page, reports, upsert
    from worklake.operators.flatten import flatten
    from worklake.plans import derived as D
    from worklake.plans.queries import FULL
    from worklake.sources import tables

    landing = f"{scratch}/landing"
    D.raw_works(spark, sf_dir).write.parquet(landing)
    raw = spark.read.parquet(landing)
    table = f"{scratch}/papers"
    upsert.upsert_table(spark, table, dedup.batch_dedup(flatten(raw)), D.LOAD_TS)
    papers = upsert.read_table(spark, table)
    state = reports.FilterState.make("1998-01-01", "1998-03-31", ["NATION_1", "NATION_7"], True)
    checks = dq.default_checks(D.EXPECTED_SUBFIELD, D.AS_OF)
    runs = D.runs_of(raw)
    updates = dedup.batch_dedup(flatten(D.second_snapshot(D.in_window(raw, D.BATCH2))))
    state_of_table = tables.table_state(spark, table)
    flows = {
        "binding: nested works from the test tables": D.raw_works(spark, sf_dir),
        "flatten + reject + first-wins (batch M2)": dedup.batch_dedup(flatten(raw)),
        "ingest counters (A13)": dedup.ingest_counters(raw),
        "paper list, filtered (F5 P2 T1)": reports.paper_list(papers, state),
        "top topics (A2 T2)": reports.top_topics(papers, FULL),
        "top countries (A5 J4)": reports.top_countries(papers, FULL),
        "KPIs (A8)": reports.kpis(papers, FULL),
        "trend (J5 W1)": reports.trend(papers, FULL),
        "DQ summary (Q12, fused Q2-Q11 + Q1)": dq.summary(papers, runs, checks),
        "DQ samples (T5)": dq.samples(papers, checks),
        "all tables of a page (E5)": page.groupings(papers, FULL),
        "date bounds from footers (A6)": page.stored_date_bounds(spark, table),
        "every run against its window (J1)": dq.reconcile_runs(papers, runs),
        "trend by topic (W1)": reports.topic_trend(papers, FULL),
    }
    for name, df in flows.items():
        print(f"### {name}\n\n```\n{tree(df)}\n```\n")
    with upsert.bucketed(spark, tables.version_folder(table, state_of_table.version), state_of_table.buckets) as stored:
        merged = upsert.merge(stored, upsert.with_ingested_at(updates, D.LOAD2_TS))
        print(f"### merge of a batch into the stored table (M3, J6)\n\n```\n{tree(merged)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
