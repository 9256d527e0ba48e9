"""Upsert pairs U1–U4, idempotence, run log, export envelopes and landing files."""

import datetime as dt
import json

import pytest
from pyspark.errors import AnalysisException

from rawworks import B, frame, work
from worklake.operators import dedup, runlog, upsert
from worklake.operators.flatten import flatten
from worklake.sources import tables
from worklake.sources import works as W

T1 = dt.datetime(2026, 6, 15)
T2 = dt.datetime(2026, 6, 16)


def _inc(spark, rows):
    return dedup.batch_dedup(flatten(frame(spark, rows)))


def _table(spark, path):
    return {r["openalex_id"]: r for r in upsert.read_table(spark, path).collect()}


def test_upsert_pairs(spark, tmp_path):
    path = str(tmp_path / "papers")
    first = [work(B + "W1", doi="d1", updated_date="2026-06-10"), work(B + "W2"), work(B + "W3")]
    assert upsert.upsert_table(spark, path, _inc(spark, first), T1) == 3
    # Same batch again → same facts
    upsert.upsert_table(spark, path, _inc(spark, first), T2)
    t = _table(spark, path)
    assert len(t) == 3 and all(r["ingested_at"] == T1 for r in t.values())
    # U2 + U3 + U4: NULL doi overwrites, older record still wins, date change keeps one row
    second = [work(B + "W1", doi=None, date="2025-01-01", year=2025, updated_date="2020-01-01"),
              work(B + "W9")]
    assert upsert.upsert_table(spark, path, _inc(spark, second), T2) == 2
    t = _table(spark, path)
    assert len(t) == 4
    w1 = t["W1"]
    assert w1["doi"] is None and w1["publication_date"] == dt.date(2025, 1, 1)
    assert w1["ingested_at"] == T1 and t["W9"]["ingested_at"] == T2
    assert upsert.read_table(spark, path).filter("openalex_id = 'W1'").count() == 1


def test_run_log_append(spark, tmp_path):
    path = str(tmp_path / "table")
    header = {"fetched_at": T1, "from_date": dt.date(2026, 6, 12), "to_date": dt.date(2026, 6, 15),
              "subfield_id": "S1"}
    assert runlog.append_run(spark, path, header, 7, created_at=T1) == 1
    assert runlog.append_run(spark, path, header, 2**33, created_at=T2) == 2
    with pytest.raises(runlog.RunHeaderError):
        runlog.append_run(spark, path, dict(header, subfield_id=None), 7)
    rows = sorted(tables.read_runs(spark, path).collect())
    assert [(r["id"], r["paper_count"], r["created_at"], r["from_date"]) for r in rows] == [
        (1, 7, T1, dt.date(2026, 6, 12)), (2, 2**33, T2, dt.date(2026, 6, 12))]


def test_envelope_read_keeps_positions(spark, tmp_path):
    env = {"fetched_at": "2026-06-15T10:00:00",
           "filters": {"primary_topic.subfield.id": "S1", "from_publication_date": "2026-06-12",
                       "to_publication_date": "2026-06-15"},
           "subfield": {"id": "S1", "display_name": "AI"},
           "date_range": {"from": "2026-06-12", "to": "2026-06-15"},
           "count": 3, "duplicates_skipped": 0,
           "papers": [work(B + "W1"), work(B + "W2"), work(B + "W1", title="later")]}
    p = tmp_path / "ai_papers_20260615_100000.json"
    p.write_text(json.dumps(env, indent=2, ensure_ascii=False))
    raw = W.read_export(spark, str(p))
    assert [r["_pos"] for r in raw.orderBy("_pos").collect()] == [0, 1, 2]
    kept = dedup.batch_dedup(flatten(raw)).orderBy("openalex_id").collect()
    assert [(r["openalex_id"], r["title"]) for r in kept] == [("W1", "T"), ("W2", "T")]
    header = runlog.envelope_headers(W.read_envelopes(spark, str(p))).first()
    assert header["subfield_id"] == "S1" and header["from_date"] == dt.date(2026, 6, 12)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        W.read_export(spark, str(tmp_path / "missing.json"))
    bad = tmp_path / "bad.json"
    bad.write_text('{"papers": [')
    with pytest.raises(W.EnvelopeError):
        W.check_envelopes(W.read_envelopes(spark, str(bad)))
    empty = tmp_path / "empty.json"
    empty.write_text(json.dumps({"fetched_at": "2026-06-15T10:00:00", "papers": None}))
    assert W.read_export(spark, str(empty)).count() == 0


def test_export_round_trip(spark, tmp_path):
    rows = [work(B + "W1", authorships=[{"countries": ["US"]}]), work(B + "W2"), work(B + "W1", title="x")]
    raw = frame(spark, rows)
    folder = W.write_export(raw, str(tmp_path / "exp"), {
        "fetched_at": "2026-06-15T10:00:00", "subfield": {"id": "S1", "display_name": "AI"},
        "date_range": {"from": "2026-06-12", "to": "2026-06-15"}, "stamp": "20260615_100000"})
    assert folder.endswith("run=20260615_100000")
    back = W.read_export_folder(spark, folder)
    a = sorted(tuple(r) for r in flatten(raw).drop("_corrupt_record").collect())
    b = sorted(tuple(r) for r in flatten(back).collect())
    assert a == b
    m = W.read_manifest(spark, folder).first()
    assert m["count"] == 3 and m["subfield"]["id"] == "S1"


def test_subfield_lookup_errors(spark):
    dim = spark.createDataFrame([("s1", "Artificial Intelligence"), ("s2", "Artificial Life")],
                                "id string, display_name string")
    assert W.resolve_subfield(dim, "artificial intelligence")["id"] == "s1"
    with pytest.raises(W.SubfieldLookupError, match="names that contain it: none"):
        W.resolve_subfield(dim, "chemistry")
    with pytest.raises(W.SubfieldLookupError, match="'Artificial Intelligence', 'Artificial Life'"):
        W.resolve_subfield(dim, "artificial")


def test_ensure_tables_idempotent(spark, tmp_path):
    from worklake.sources.tables import ensure_tables

    p = str(tmp_path / "papers")
    assert ensure_tables(spark, p) == ["papers", "runs"]
    assert ensure_tables(spark, p) == []
    assert upsert.read_table(spark, p).count() == 0 and tables.read_runs(spark, p).count() == 0
    assert upsert.upsert_table(spark, p, _inc(spark, [work(B + "W1")]), T1) == 1
    assert ensure_tables(spark, p) == []


def _files(root):
    import os

    out = {}
    for d, _, fs in os.walk(root):
        for f in fs:
            if f.endswith(".parquet"):
                p = os.path.join(d, f)
                out[p] = os.stat(p).st_mtime_ns
    return out


def _lost(*a, **k):
    raise RuntimeError("driver lost")


def test_a_broken_load_shows_the_old_state(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "papers")
    run = {"fetched_at": T1, "from_date": T1.date(), "to_date": T1.date(), "subfield_id": "s", "paper_count": 1, "created_at": T1}
    upsert.upsert_table(spark, path, _inc(spark, [work(B + "W1")]), T1, run)
    inc = _inc(spark, [work(B + "W1", title="x"), work(B + "W2")])
    for name in ("_write_version", "tables.append_log"):
        with monkeypatch.context() as m:
            m.setattr(f"worklake.operators.upsert.{name}", _lost)
            with pytest.raises(RuntimeError, match="driver lost"):
                upsert.upsert_table(spark, path, inc, T2, run)
        t = _table(spark, path)
        assert sorted(t) == ["W1"] and t["W1"]["title"] == "T" and tables.read_runs(spark, path).count() == 1
    upsert.upsert_table(spark, path, inc, T2, run)
    t = _table(spark, path)
    assert sorted(t) == ["W1", "W2"] and t["W1"]["title"] == "x"
    assert sorted(r["id"] for r in tables.read_runs(spark, path).collect()) == [1, 2]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("worklake_")]


def test_versions_before_the_last_two_are_deleted(spark, tmp_path):
    path = str(tmp_path / "it's a table")
    for k in range(4):
        upsert.upsert_table(spark, path, _inc(spark, [work(B + f"W{i}", title=f"t{k}") for i in range(k, 9)]), T1 + dt.timedelta(days=k))
    runlog.append_run(spark, path, {"fetched_at": T1, "from_date": T1.date(), "to_date": T1.date(), "subfield_id": "s"}, 1, T1)
    assert {k: (r["title"], r["ingested_at"]) for k, r in _table(spark, path).items()} == {
        f"W{i}": (f"t{min(i, 3)}", T1) for i in range(9)}
    state = tables.table_state(spark, path)
    kept = sorted(p.name for p in (tmp_path / "it's a table" / "papers").iterdir() if p.is_dir())
    assert kept == [state.previous, state.version] and state.seq == 5


def test_stray_folders_and_errors(spark, tmp_path):
    path = str(tmp_path / "papers")
    inc = _inc(spark, [work(B + f"W{i}") for i in range(5)])
    upsert.upsert_table(spark, path, inc, T1)
    inc.write.parquet(f"{path}/papers/stray")
    inc.write.parquet(f"{path}/elsewhere/x=1")
    upsert.upsert_table(spark, path, inc, T2)
    assert upsert.read_table(spark, path).count() == 5
    (tmp_path / "papers" / "log" / "broken.txt").write_text("{broken")
    with pytest.raises(Exception):  # noqa: B017 - an unreadable log is no empty table
        upsert.upsert_table(spark, path, inc, T2)


def test_only_the_batch_is_shuffled(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "papers")
    upsert.upsert_table(spark, path, _inc(spark, [work(B + f"W{i}") for i in range(1, 201)]), T1, buckets=6)
    assert len(_files(path)) == 6
    plans = []
    write = upsert._write_version
    monkeypatch.setattr(upsert, "_write_version", lambda df, *a: (
        plans.append(df._jdf.queryExecution().executedPlan().toString()), write(df, *a)))
    batch = spark.read.parquet(_stored(_inc(spark, [work(B + f"W{i}", title="new") for i in range(1, 61)]), tmp_path))
    upsert.upsert_table(spark, path, batch, T2)
    assert plans[0].count("Join") == 1 and plans[0].count("Exchange hashpartitioning") == 1
    assert "Bucketed: true" in plans[0] and "SelectedBucketsCount: 6 out of 6" in plans[0]
    t = _table(spark, path)
    assert len(t) == 200 and t["W7"]["title"] == "new" and t["W7"]["ingested_at"] == T1
    files = _files(f"{path}/papers/{tables.table_state(spark, path).version}")
    assert len(files) == 6  # each task wrote its own bucket
    upsert.upsert_table(spark, path, batch, T2, buckets=3)
    assert tables.table_state(spark, path).buckets == 3 and _table(spark, path) == t


def _stored(df, tmp_path):
    df.write.parquet(str(tmp_path / "batch"))
    return str(tmp_path / "batch")


def test_few_buckets_are_written_by_many_tasks(spark, tmp_path):
    """a bucket has several files, each of its own keys, and merges stay right."""
    path = str(tmp_path / "papers")
    works = [work(B + f"W{i}") for i in range(1, 201)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # four small tasks
    try:
        upsert.upsert_table(spark, path, _inc(spark, works), T1, buckets=2)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = list((tmp_path / "papers" / "papers" / tables.table_state(spark, path).version).glob("*.parquet"))
    assert len(files) == 4 and len({f.name.split("_")[-1].split(".")[0] for f in files}) == 2
    upsert.upsert_table(spark, path, _inc(spark, works[50:] + [work(B + "W999")]), T2)
    got = _table(spark, path)
    assert len(got) == 201 and tables.table_state(spark, path).buckets == 2


def test_export_is_packed_and_typed_leaves_need_no_search(spark, tmp_path):
    """JSON lines are packed; text leaves that are numbers still become numbers."""
    typed = spark.createDataFrame([(1, True)], "cited_by_count int, is_retracted boolean")
    text = spark.createDataFrame([("1", "true")], "cited_by_count string, is_retracted string")
    columns = ["cited_by_count", "is_retracted"]
    lines = [df.select(W.json_line(df, columns).alias("v")) for df in (typed, text)]
    assert lines[0].first() == lines[1].first()
    assert "regexp_replace" not in lines[0]._jdf.queryExecution().optimizedPlan().toString()
    lines[0].write.options(**W.PACKED).text(str(tmp_path / "t"))
    assert all(f.name.endswith(".gz") for f in (tmp_path / "t").glob("part-*"))


def test_country_set_and_bounds(spark):
    """NULL lists, codes and entries are skipped; values just below and at a column's bound."""
    from worklake.functions.scalar import sql_country_set

    got = spark.sql("SELECT from_json(a, 'array<struct<countries: array<string>>>') AS a FROM VALUES "
                    "('[{\"countries\":[\"b\",\"a\"]},{\"countries\":[\"b\"]}]'), ('[{\"countries\":null},{\"countries\":[\"c\",null]}]'), "
                    "('[null]'), ('[]'), (NULL) AS t(a)").selectExpr(f"{sql_country_set('a')} AS c").collect()
    assert [r.c for r in got] == [["a", "b"], ["c"], None, None, None]
