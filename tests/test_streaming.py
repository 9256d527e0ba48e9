"""Available-now incremental ingest, restart on the same checkpoint."""

import datetime as dt
import json

from rawworks import B, work
from worklake.operators import upsert
from worklake.streaming.incremental import incremental_ingest

T1 = dt.datetime(2026, 6, 15)
T2 = dt.datetime(2026, 6, 16)


def _land(folder, name, rows):
    folder.mkdir(exist_ok=True)
    with open(folder / name, "w") as fh:
        for i, r in enumerate(rows):
            fh.write(json.dumps(dict(r, _src=name, _pos=i)) + "\n")


def test_incremental_ingest_restart_and_update(spark, tmp_path):
    landing, table, ckpt = tmp_path / "landing", str(tmp_path / "table"), str(tmp_path / "ckpt")
    _land(landing, "a.json", [work(B + "W1", doi="d1"), work(B + "W2"), work(B + "W1", title="late copy")])
    _land(landing, "b.json", [work(B + "W3"), work(None)])
    incremental_ingest(spark, str(landing), table, ckpt, T1, max_files_per_trigger=1)
    rows = {r["openalex_id"]: r for r in upsert.read_table(spark, table).collect()}
    assert sorted(rows) == ["W1", "W2", "W3"] and rows["W1"]["title"] == "T"  # first copy wins in a file

    # restart with nothing new: the checkpoint marks both files done
    incremental_ingest(spark, str(landing), table, ckpt, T2, max_files_per_trigger=1)
    again = {r["openalex_id"]: r for r in upsert.read_table(spark, table).collect()}
    assert again == rows

    # a later file updates W1 (NULL doi overwrites) and adds W4
    _land(landing, "c.json", [work(B + "W1", doi=None, title="v2"), work(B + "W4")])
    incremental_ingest(spark, str(landing), table, ckpt, T2, max_files_per_trigger=1)
    final = {r["openalex_id"]: r for r in upsert.read_table(spark, table).collect()}
    assert sorted(final) == ["W1", "W2", "W3", "W4"]
    assert final["W1"]["title"] == "v2" and final["W1"]["doi"] is None
    assert final["W1"]["ingested_at"] == T1 and final["W4"]["ingested_at"] == T2


def _copies(land, run, files):
    """Files of one export, with an order that differs from the files' names."""
    folder = land / f"run={run}" / "papers"
    folder.mkdir(parents=True, exist_ok=True)
    for name, rows in files.items():
        with open(folder / name, "w") as fh:
            for pos, key, title in rows:
                fh.write(json.dumps(dict(work(key and B + key, title=title), _src="s", _pos=pos)) + "\n")


def test_first_wins_across_files_batches_and_restarts(spark, tmp_path):
    land, table, ckpt = tmp_path / "landing", str(tmp_path / "table"), str(tmp_path / "ckpt")
    titles = lambda: {r["openalex_id"]: r["title"] for r in upsert.read_table(spark, table).collect()}
    run = lambda: incremental_ingest(spark, str(land / "*" / "papers"), table, ckpt, T1, max_files_per_trigger=1)
    _copies(land, "20260615_100000", {"a": [(7, "W1", "seventh"), (8, "W2", "eighth")], "b": [(3, "W1", "third"), (9, "W2", "ninth")]})
    run()
    assert titles() == {"W1": "third", "W2": "eighth"}
    # Restart: an earlier place in a file that lands later wins, a later one does not.
    _copies(land, "20260615_100000", {"c": [(1, "W2", "first"), (5, "W1", "fifth"), (6, "W3", "sixth")]})
    run()
    assert titles() == {"W1": "third", "W2": "first", "W3": "sixth"}
    # A later export replaces rows, first of its own copies; a late file of the first export doesn't.
    _copies(land, "20260616_100000", {"a": [(4, "W1", "new fourth")], "b": [(2, "W1", "new second")]})
    run()
    _copies(land, "20260615_100000", {"d": [(0, "W1", "late"), (0, "W4", "late")]})
    run()
    assert titles() == {"W1": "new second", "W2": "first", "W3": "sixth", "W4": "late"}


def test_state_is_kept_in_jvm_and_rocksdb(spark, tmp_path):
    from worklake.streaming.incremental import start_incremental_ingest

    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    _copies(tmp_path / "landing", "20260615_100000", {"a": [(7, "W1", "x")]})
    q = start_incremental_ingest(spark, str(tmp_path / "landing" / "*" / "papers"), str(tmp_path / "table"), str(tmp_path / "ckpt"), T1)
    q.awaitTermination()
    state = q.lastProgress["stateOperators"][0]
    assert state["numRowsTotal"] == 1 and any(k.startswith("rocksdb") for k in state["customMetrics"])
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == provider


def test_lines_without_places_are_numbered(spark, tmp_path):
    land, table = tmp_path / "landing" / "run=20260615_100000" / "papers", str(tmp_path / "table")
    land.mkdir(parents=True)
    for name, keys in (("a", ["W1", "W2", "W1"]), ("b", ["W3", "W2", "W3"])):
        (land / name).write_text("".join(json.dumps(work(B + k, title=f"{name}{i}")) + "\n" for i, k in enumerate(keys)))
    incremental_ingest(spark, str(land), table, str(tmp_path / "ckpt"), T1, max_files_per_trigger=1, places=False)
    assert {r["openalex_id"]: r["title"] for r in upsert.read_table(spark, table).collect()} == {"W1": "a0", "W2": "a1", "W3": "b0"}


def test_landed_files_grow_with_the_partitions(spark, sf_small):
    """as many files as a shuffle has partitions, so no task reads a fixed share of all works."""
    import glob
    import os

    from worklake.plans.queries import QUERIES

    root = spark.conf.get("spark.checkpoint.dir").split(":", 1)[-1]
    before, was = set(glob.glob(f"{root}/stream-*")), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    try:
        QUERIES["incremental_ingest"](spark, sf_small)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    (new,) = set(glob.glob(f"{root}/stream-*")) - before
    assert len(glob.glob(os.path.join(new, "landing", "*", "papers", "part-*"))) == 6


def _left(spark, *kinds):
    """Files of these kinds in the session's local folders."""
    import os

    jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
    manager = jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    tops = [*manager.localDirsString(), jvm.org.apache.spark.util.Utils.getLocalDir(jsc.sc().conf())]
    return {f"{d}/{f}" for top in tops for d, _, files in os.walk(top) for f in files if f.endswith(kinds)}


def test_a_run_keeps_only_the_packed_state(spark, tmp_path):
    """F1: neither shuffle files nor a local copy of the state outlast their micro-batch, and the state is packed."""
    import hashlib
    import time

    title = lambda k: "".join(hashlib.sha256(f"{k}/{i}".encode()).hexdigest() for i in range(16))
    land, table, ckpt = tmp_path / "landing", str(tmp_path / "table"), tmp_path / "ckpt"
    _copies(land, "20260615_100000", {name: [(k, f"W{k}", title(k)) for k in range(i, 2000, 2)] for i, name in enumerate("ab")})
    settings = lambda: {k: v for k, v in spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
        spark._jsparkSession.conf().getAll()).items()}
    set_before, before = settings(), _left(spark, ".sst", ".data")
    incremental_ingest(spark, str(land / "*" / "papers"), table, str(ckpt), T1, max_files_per_trigger=1)
    until = time.time() + 10  # the cleaner doesn't wait
    while (left := _left(spark, ".sst", ".data") - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and settings() == set_before
    kept = sum(f.stat().st_size for f in (ckpt / "state").rglob("*.sst"))
    assert 0 < kept < 0.8 * 2000 * len(title(0))
    assert {r["openalex_id"]: r["title"] for r in upsert.read_table(spark, table).collect()} == {f"W{k}": title(k) for k in range(2000)}


def test_works_are_dealt_as_rows_of_the_tables(spark, tmp_path):
    """the landed works are dealt by place before they become works, and are the same works."""
    from pyspark.sql import functions as F
    from worklake.plans import derived as D

    sf, n = str(tmp_path), spark.range
    tables = {
        "region": n(2).selectExpr("CAST(id AS INT) r_regionkey", "concat('R', id) r_name"),
        "nation": n(6).selectExpr("CAST(id AS INT) n_nationkey", "concat('NATION_', id) n_name", "CAST(id % 2 AS INT) n_regionkey"),
        "customer": n(30).selectExpr("id c_custkey", "concat('C', id) c_name", "CAST(id % 6 AS INT) c_nationkey", "'BUILDING' c_mktsegment"),
        "supplier": n(10).selectExpr("id s_suppkey", "CAST(id % 6 AS INT) s_nationkey"),
        # Orders without a key or customer, and some that come twice.
        "orders": n(400).selectExpr(
            "CASE WHEN id < 390 THEN id WHEN id < 395 THEN (id - 390) * 19 END o_orderkey", "CASE WHEN id % 41 <> 0 THEN id % 30 END o_custkey",
            "'F' o_orderstatus", "CAST(id * 900 AS DOUBLE) o_totalprice", "timestamp'1996-01-02' o_orderdate", "'1-URGENT' o_orderpriority"),
        "lineitem": n(1500).selectExpr("CASE WHEN id % 97 <> 0 THEN id % 380 END l_orderkey", "CASE WHEN id % 31 <> 0 THEN id % 10 END l_suppkey",
                                       "CASE WHEN id % 29 <> 0 THEN CAST(id % 50 AS DOUBLE) END l_quantity"),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{sf}/{name}.parquet")
    lines = lambda works: sorted(r[0] for r in works.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).collect())
    dealt = D.raw_works(spark, sf, 5)
    assert lines(dealt) == lines(D.raw_works(spark, sf)) and len(lines(dealt)) > 400
    places = dealt.select("_src", "_pos", F.spark_partition_id().alias("at")).where("_pos IS NOT NULL").distinct().collect()
    at = {(r["_src"], r["_pos"]): r["at"] for r in places}
    assert len(at) == len(places) and set(at.values()) == set(range(5))
    assert any(at["part-1", k] != at["part-0", k] for s, k in at if s == "part-1")
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    above = plan.split("Join", 1)[0]  # of the outermost join; works are made above the one with line items
    assert "Exchange hashpartitioning" not in above and "Exchange hashpartitioning(_src" not in plan
