"""Property tests: scalar rules vs a plain-Python model; hot-key skew."""

import random

from pyspark.sql import functions as F

from rawworks import B, frame, work
from worklake.operators import dedup
from worklake.operators.flatten import REJECT, flatten


def _model_segment(v):
    if not v:
        return None
    return v.rsplit("/", 1)[-1]


def _random_text(rng):
    alphabet = ["/", "W", "1", "a", " ", "é", "-"]
    if rng.random() < 0.15:
        return None
    return "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 6)))


def test_id_and_title_rules_match_model(spark):
    rng = random.Random(7)
    rows = []
    for i in range(400):
        rows.append(work(_random_text(rng), title=_random_text(rng), display_name=_random_text(rng),
                         primary_topic={"id": _random_text(rng), "display_name": None, "score": None,
                                        "subfield": None, "field": None, "domain": None}))
    got = {r["_pos"]: r for r in flatten(frame(spark, rows)).collect()}
    for i, w in enumerate(rows):
        short = _model_segment(w["id"]) or None
        title = w["title"] or w["display_name"] or None
        r = got[i]
        assert r["openalex_id"] == short
        assert r["primary_topic_id"] == _model_segment(w["primary_topic"]["id"])
        if short is None:
            assert r[REJECT] == "missing_id"
        elif title is None:
            assert r[REJECT] == "missing_title"
        else:
            assert r[REJECT] is None and r["title"] == title


def test_hot_key_first_wins(spark):
    # one key holds most rows (copies spread over several source files)
    hot = [work(B + "W1", title=f"copy {i}") for i in range(3000)]
    rest = [work(B + f"W{i}") for i in range(2, 500)]
    rows = hot[:1500] + rest + hot[1500:]
    raw = frame(spark, rows).repartition(16)
    kept = dedup.batch_dedup(flatten(raw))
    assert kept.count() == 499
    w1 = kept.filter(F.col("openalex_id") == "W1").first()
    assert w1["title"] == "copy 0" and w1["_pos"] == 0
    c = dedup.ingest_counters(raw).first()
    assert (c["upserted"], c["duplicates_in_file"], c["skipped_invalid"]) == (499, 2999, 0)


def _stored(spark, per_day: dict):
    import datetime as dt

    from worklake.schema import PAPERS_SCHEMA

    base = {f.name: None for f in PAPERS_SCHEMA.fields}
    rows, i = [], 0
    for day, (n, topic, cites) in per_day.items():
        for j in range(n):
            i += 1
            rows.append(dict(base, openalex_id=f"W{i}", title="t", publication_date=day,
                             publication_year=day.year, is_oa=(i % 3 == 0), is_retracted=False,
                             has_fulltext=False, cited_by_count=cites + j, referenced_works_count=0,
                             author_count=1 + i % 4, countries_count=0, institutions_count=0,
                             locations_count=0, primary_topic_name=topic,
                             ingested_at=dt.datetime(2026, 1, 1)))
    return spark.createDataFrame(rows, PAPERS_SCHEMA)


def test_trend_matches_pandas_model(spark):
    import datetime as dt

    import pandas as pd

    from worklake.operators import reports

    rng = random.Random(11)
    start = dt.date(2024, 2, 20)
    per_day = {}
    for d in range(40):
        if rng.random() < 0.6:
            per_day[start + dt.timedelta(days=d)] = (rng.randint(1, 5), f"T{rng.randint(1, 4)}", rng.randint(0, 9))
    papers = _stored(spark, per_day)
    state = reports.FilterState.make(start + dt.timedelta(days=3), start + dt.timedelta(days=36))
    got = [(r["publication_date"], r["daily_papers"], r["avg_7d"]) for r in reports.trend(papers, state).collect()]
    idx = pd.date_range(state.from_date, state.to_date, freq="D")
    daily = pd.Series({pd.Timestamp(d): n for d, (n, _, _) in per_day.items()}).reindex(idx, fill_value=0)
    model = daily.rolling(window=7, min_periods=1).mean().round(1)
    assert [g[1] for g in got] == list(daily.astype(int))
    assert [g[2] for g in got] == list(model)
    k = reports.trend_kpis(papers, state).first()
    assert k["total"] == daily.sum() and k["peak_count"] == daily.max()
    assert k["peak_day"] == daily.idxmax().date()  # idxmax picks the earliest maximum
    assert abs(k["avg_per_day"] - daily.mean()) < 1e-9


def test_kpis_and_topk_match_python_model(spark):
    import datetime as dt
    import statistics
    from collections import Counter

    from worklake.operators import reports

    rng = random.Random(5)
    start = dt.date(2024, 1, 1)
    per_day = {start + dt.timedelta(days=d): (rng.randint(1, 6), rng.choice(["A", "B", "C", None]), rng.randint(0, 20))
               for d in range(60)}
    papers = _stored(spark, per_day)
    state = reports.FilterState.make(start, start + dt.timedelta(days=59))
    rows = papers.collect()
    k = reports.kpis(papers, state).first()
    assert k["publications"] == len(rows)
    assert k["median_citations"] == statistics.median(r["cited_by_count"] for r in rows)
    assert abs(k["oa_pct"] - 100 * sum(r["is_oa"] for r in rows) / len(rows)) < 1e-9
    assert k["topics"] == len({r["primary_topic_name"] for r in rows} - {None})
    counts = Counter(r["primary_topic_name"] for r in rows if r["primary_topic_name"])
    expect = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:10]
    assert [(r["topic"], r["papers"]) for r in reports.top_topics(papers, state).collect()] == expect
