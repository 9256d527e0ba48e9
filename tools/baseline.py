"""

    python tools/baseline.py [sf_dir] [cpus] [runs]

Per key: median of ``runs`` warm runs (full execution into the no-op sink).
Shuffle and spill come from Spark's event log (task metrics), written to a
fresh scratch folder.
"""

from __future__ import annotations

import glob
import io
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _events(folder: str) -> list[dict]:
    import zstandard

    out = []
    for d in glob.glob(f"{folder}/*"):
        for fn in sorted(glob.glob(f"{d}/events*") if os.path.isdir(d) else [d]):
            with open(fn, "rb") as fh:
                raw = (io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), errors="ignore").read()
                       if fn.endswith("zstd") else fh.read().decode(errors="ignore"))
            for line in raw.splitlines():
                try:
                    out.append(json.loads(line))
                except ValueError:
                    pass
    return out


def _task_totals(events: list[dict], group: str) -> tuple[float, float]:
    """Shuffle-write and spill MB of the jobs tagged with job group ``group``."""
    jobs_stages = set()
    for e in events:
        if e["Event"] == "SparkListenerJobStart" and e.get("Properties", {}).get("spark.jobGroup.id") == group:
            jobs_stages.update(s["Stage ID"] for s in e["Stage Infos"])
    shuffle = spill = 0
    for e in events:
        if e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in jobs_stages:
            m = e.get("Task Metrics") or {}
            shuffle += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
            spill += m.get("Disk Bytes Spilled", 0)
    return round(shuffle / 2**20, 2), round(spill / 2**20, 2)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    cpus = int(sys.argv[2]) if len(sys.argv) > 2 else 4
    runs = int(sys.argv[3]) if len(sys.argv) > 3 else 5
    scratch = tempfile.mkdtemp(prefix="worklake-baseline-", dir="/tmp")
    from worklake.session import build_session

    os.makedirs(f"{scratch}/events", exist_ok=True)
    spark = build_session(f"local[{cpus}]", cpus * 2, extra={
        "spark.driver.memory": "7g", "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": f"{scratch}/events", "spark.checkpoint.dir": f"{scratch}/ckpt"})
    from worklake.operators import dedup, dq
    from worklake.operators.flatten import flatten
    from worklake.plans import derived as D
    from worklake.plans.queries import QUERIES

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    result = {}
    for key, fn in QUERIES.items():
        times = []
        for i in range(runs + 1):
            spark.sparkContext.setJobGroup(f"{key}-{i}", key)
            t = time.perf_counter()
            run(fn(spark, sf_dir))
            if i:  # first run warms up
                times.append(time.perf_counter() - t)
        result[key] = {"median_s": round(statistics.median(times), 3)}
    spark.sparkContext.setJobGroup("rows", "rows")
    raw = D.raw_works(spark, sf_dir)
    n = raw.count()
    t = time.perf_counter()
    run(dedup.batch_dedup(flatten(raw)))
    rows_per_s = n / (time.perf_counter() - t)
    papers = D.papers(spark, sf_dir)
    checks = dq.default_checks(D.EXPECTED_SUBFIELD, D.AS_OF)
    row_checks = tuple(c for c in checks if c.predicate is not None)
    from worklake.session import stage
    stored = stage(papers, "baseline-papers")
    t = time.perf_counter()
    dq.summary(stored, None, row_checks).collect()
    fused = time.perf_counter() - t
    t = time.perf_counter()
    for c in row_checks:
        c.violations(stored, None).count()
    separate = time.perf_counter() - t
    spark.stop()
    events = _events(f"{scratch}/events")
    for key in ("first_wins_batch", "upsert_merge"):
        sh, sp = _task_totals(events, f"{key}-1")
        result[key].update({"shuffle_mb": sh, "spill_mb": sp})
    print(json.dumps({"sf_dir": sf_dir, "cpus": cpus, "runs": runs, "keys": result,
                      "flatten_dedup_rows_per_s": round(rows_per_s), "raw_rows": n,
                      "dq_fused_s": round(fused, 3), "dq_separate_s": round(separate, 3)}, indent=1))


if __name__ == "__main__":
    main()
