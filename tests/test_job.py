"""Job wiring (E1–E4, E9, M5, Q14): landing → load → run log → DQ → gate."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from worklake.operators import dq, upsert
from worklake.plans import derived as D
from worklake.plans import job
from worklake.sources import tables
from worklake.sources import works as W


@pytest.fixture(scope="module")
def landing(spark, sf_small, tmp_path_factory):
    root = tmp_path_factory.mktemp("job")
    folder = W.write_export(D.raw_works(spark, sf_small), str(root / "exports"), {
        "fetched_at": "2001-08-02T00:00:00",
        "subfield": {"id": "https://openalex.org/subfields/BUILDING", "display_name": "BUILDING"},
        "date_range": {"from": "1995-01-01", "to": "2001-08-01"}, "stamp": "20010802_000000"})
    return root, folder


def _cfg(root, name, **kw):
    base = dict(table=str(root / name / "papers"), subfield_search="building", as_of=dt.date(2001, 8, 1), days_back=3000)
    base.update(kw)
    return job.JobConfig(**base)


def test_run_batch_gates_on_errors(spark, landing):
    root, folder = landing
    cfg = _cfg(root, "a", landing=f"{folder}/papers")
    with pytest.raises(dq.DataQualityError) as e:
        job.run_batch(spark, cfg)
    assert "openalex_id_format" in str(e.value)
    # facts and run row were stored before the gate ran (M5)
    stored = upsert.read_table(spark, cfg.table)
    assert stored.count() > 0
    assert stored.filter(F.col("subfield_name") != "BUILDING").count() == 0
    runs = tables.read_runs(spark, cfg.table).collect()
    assert len(runs) == 1 and runs[0]["subfield_id"].endswith("BUILDING")


def test_run_batch_without_gate(spark, landing):
    root, folder = landing
    cfg = _cfg(root, "b", landing=f"{folder}/papers", fail_on_dq_errors=False)
    res = job.run_batch(spark, cfg)
    by = {r.check.name: r.violation_count for r in res.data_quality}
    assert by["ai_subfield"] == 0 and by["openalex_id_format"] > 0
    assert res.ingest.upserted == upsert.read_table(spark, cfg.table).count()
    # warnings-only flag still fails on errors (Q14)
    cfg2 = _cfg(root, "b", landing=f"{folder}/papers", fail_on_dq_errors=False, fail_on_dq_warnings=True)
    with pytest.raises(dq.DataQualityError):
        job.run_batch(spark, cfg2)


def test_run_from_export_idempotent(spark, landing):
    root, folder = landing
    cfg = _cfg(root, "c", run_data_quality=False)
    r1 = job.run_from_export(spark, folder, cfg).ingest
    assert (r1.upserted, r1.skipped_invalid, r1.duplicates_in_file) == (1481, 20, 78)
    first = sorted(tuple(r) for r in upsert.read_table(spark, cfg.table).collect())
    r2 = job.run_from_export(spark, folder, cfg).ingest
    again = sorted(tuple(r) for r in upsert.read_table(spark, cfg.table).collect())
    assert r2.ingest_run_id == r1.ingest_run_id + 1
    assert again == first and len(again) == 1481  # ingested_at kept from the first load


def test_main_cli(spark, landing, capsys):
    root, folder = landing
    rc = job.main(["--table", str(root / "d" / "papers"), "--from-export", folder, "--skip-dq"])
    assert rc == 0 and "upserted 1481" in capsys.readouterr().out
