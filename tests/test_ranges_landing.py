"""J1 by day buckets, W1 by topic, the pruned landing and the counters of a load."""

import datetime as dt
import random
import re

from pyspark.sql import functions as F

from rawworks import B, frame, work
from test_plans import plan
from worklake.operators import dedup, dq, ranges, reports
from worklake.operators.flatten import flatten
from worklake.plans import derived as D
from worklake.plans import job
from worklake.plans.queries import FULL
from worklake.sources import works as W

EPOCH = dt.date(1970, 1, 1)


def _day(n):
    return EPOCH + dt.timedelta(days=n)


def test_cover_is_exact_and_short(spark):
    draw = random.Random(1)
    pairs = [(a, a + draw.choice([-1, 0, 1, 2, 5, 100, 4000, 900_000])) for a in (draw.randint(-20_000, 40_000) for _ in range(150))]
    rows = spark.createDataFrame(pairs, "a long, b long").select("a", "b", ranges.cover(F.col("a"), F.col("b")).alias("c")).collect()
    for r in rows:
        spans = sorted((x.bucket << x.level, (x.bucket + 1) << x.level) for x in r.c)
        assert len(spans) <= 2 * max(1, r.b - r.a + 1).bit_length()
        at = r.a
        for lo, hi in spans:
            assert lo == at
            at = hi
        assert at == max(r.a, r.b + 1)


def test_count_in_windows_equals_brute_force(spark):
    draw = random.Random(2)
    days = [draw.randint(-400, 400) for _ in range(500)] + [3] * 500
    windows = [(k, draw.randint(-500, 500), draw.choice([0, 1, 30, 365, 20_000])) for k in range(80)]
    facts = spark.createDataFrame([(_day(d),) for d in days] + [(None,)], "d date")
    rows = [(k, _day(a), _day(a + n)) for k, a, n in windows] + [(900, _day(5), _day(4)), (901, None, _day(9)), (902, _day(1), None)]
    got = {r.id: r.n for r in ranges.count_in_windows(facts, spark.createDataFrame(rows, "id long, a date, b date"), "d", "id", "a", "b").collect()}
    want = {k: sum(a <= d <= a + n for d in days) for k, a, n in windows} | {900: 0, 901: 0, 902: 0}
    assert got == want
    assert ranges.count_in_windows(facts.limit(0), spark.createDataFrame(rows, "id long, a date, b date"), "d", "id", "a", "b").where("n <> 0").isEmpty()


def test_runs_are_reconciled_without_nested_loop(spark, sf_small):
    df = dq.reconcile_runs(D.papers(spark, sf_small), D.runs(spark, sf_small))
    text = plan(df)
    assert "NestedLoop" not in text and "Cartesian" not in text
    last = max(df.collect(), key=lambda r: r.id)
    one = dq.reconcile(D.papers(spark, sf_small), D.runs(spark, sf_small)).collect()
    assert last.violated == bool(one) and (not one or one[0].rows_in_date_window == last.rows_in_date_window)


def test_topic_trend_has_all_days_and_adds_up(spark, sf_small):
    papers = D.papers(spark, sf_small).persist()
    try:
        rows = reports.topic_trend(papers, FULL)
        days = (FULL.to_date - FULL.from_date).days + 1
        per_topic = rows.groupBy("topic").agg(F.count(F.lit(1)).alias("days"), F.sum("daily_papers").alias("papers")).collect()
        assert per_topic and all(r.days == days for r in per_topic)
        want = {r.topic: r.papers for r in reports.top_topics(papers, FULL, 1000).collect()}
        assert {r.topic: r.papers for r in per_topic} == want
    finally:
        papers.unpersist()


def test_only_months_of_the_window_are_opened(spark, sf_small, tmp_path):
    raw, path = D.raw_works(spark, sf_small), str(tmp_path / "landing")
    W.write_landing(raw, path)
    sub = "https://openalex.org/subfields/BUILDING"
    window = (dt.date(1998, 3, 5), dt.date(1998, 4, 9))
    df = W.read_window(spark, path, sub, *window)
    text = plan(df)
    assert re.search(r"PartitionFilters: \[\(published#\d+ >= 1998-03\), \(published#\d+ <= 1998-04\)", text) and "StringContains(value,BUILDING)" in text
    opened = {r[0] for r in df.select(F.regexp_extract("_src", "published=([^/]+)", 1)).distinct().collect()}
    assert opened <= {"1998-03", "1998-04", ""}
    key = lambda x: sorted((r["id"] or "", r["title"] or "") for r in x.select("id", "title").collect())
    want = key(W.source_filter(raw, sub, *window))
    assert want and key(df) == want
    # All records are still there, with the same verdicts.
    counts = lambda x: dedup.ingest_counters(x).first()
    assert counts(W.read_works(spark, path)) == counts(raw)


def test_escaped_ids_are_found(spark, tmp_path):
    import json

    rows = [work(B + f"W{k}") for k in range(3)]
    for r in rows:
        r["primary_topic"] = {"id": "T", "display_name": "t", "subfield": {"id": "https://x/1702", "display_name": "s"}}
    lines = [json.dumps(r) for r in rows]
    lines[1] = lines[1].replace("1702", "17\\u00302")
    lines[2] = lines[2].replace("1702", "1703")
    (tmp_path / "a.json").write_text("\n".join(lines))
    found = W.read_window(spark, str(tmp_path), "https://x/1702", dt.date(1900, 1, 1), dt.date(2100, 1, 1))
    assert sorted(r["id"] for r in found.collect()) == [B + "W0", B + "W1"]


def test_a_load_is_counted_while_it_is_written(spark, tmp_path):
    rows = [work(B + "W1"), work(B + "W1", title="x"), work(B + "W2", year=1900), work(None), work(B + "X3")]
    raw = frame(spark, rows)
    header = {"fetched_at": dt.datetime(2026, 6, 15), "from_date": dt.date(2026, 6, 1), "to_date": dt.date(2026, 6, 2), "subfield_id": "s"}
    cfg = job.JobConfig(table=str(tmp_path / "t"))
    r = job.ingest(spark, raw, header, cfg)
    c = dedup.ingest_counters(raw).first()
    assert (r.papers, r.upserted, r.skipped_invalid, r.duplicates_in_file) == (c.papers, c.upserted, c.skipped_invalid, c.duplicates_in_file) == (5, 3, 1, 1)
    batch = dedup.batch_dedup(flatten(raw))
    want = {x["check"]: x["violations"] for x in dq.summary(batch, None, tuple(k for k in dq.default_checks(cfg.subfield_search) if k.predicate is not None)).collect()}
    assert r.row_checks == want and want["publication_year_matches_date"] == 1 and want["openalex_id_format"] == 1
    empty = job.ingest(spark, raw.where("1 = 0"), header, cfg)
    assert (empty.papers, empty.upserted, empty.ingest_run_id) == (0, 0, 2) and not any(empty.row_checks.values())


def test_subfields_of_a_landing_are_those_of_its_works(spark, tmp_path):
    """only the subfield is read from a line, whatever the rest of the line is like."""
    from worklake.sources import works as W

    lines = ['{"id": "W1", "primary_topic": {"id": "T", "subfield": {"id": "s/1", "display_name": "One"}}}',
             '{"primary_topic": {"subfield": {"id": "s/2", "display_name": null}}, "authorships": 3, "cited_by_count": {}}',
             '{"primary_topic": {"subfield": {"id": "s/3", "display_name": "Cut"}}, "title": "cu',
             '{"authorships": "x", "open_access": [], "primary_topic": {"score": {}, "subfield": {"id": 4, "display_name": "Four"}}}',
             '{"primary_topic": {"subfield": "s/5"}}', '{"primary_topic": null}', '"no work"', "[]", "", "  ",
             '[{"primary_topic": {"subfield": {"id": "s/6", "display_name": "Six"}}}]',
             '{"primary_topic": {"subfield": {"id": null, "display_name": "none"}}} ',
             '{"primary_topic": {"subfield": {"id": "s/7", "display_name": "Seven"}}} trailing']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(str(tmp_path / "landing"))
    path = str(tmp_path / "landing")
    slim = W.landed_subfields(spark, path)
    assert sorted(map(str, slim.collect())) == sorted(map(str, W.subfields(W.read_works(spark, path)).collect()))
    assert "authorships" not in slim._jdf.queryExecution().optimizedPlan().toString()
