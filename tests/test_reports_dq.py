"""Reports (trend cases, KPIs on empty input), DQ checks firing, gate, reconciliation."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from worklake.operators import dq, reports
from worklake.plans import derived as D
from worklake.schema import PAPERS_SCHEMA


def _papers(spark, dates_counts):
    """Stored-table rows: ``count`` papers on each given date."""
    rows = []
    i = 0
    base = {f.name: None for f in PAPERS_SCHEMA.fields}
    for d, n in dates_counts:
        for _ in range(n):
            i += 1
            r = dict(base, openalex_id=f"W{i}", title="t", publication_date=d, publication_year=d.year,
                     is_oa=False, is_retracted=False, has_fulltext=False, cited_by_count=i,
                     referenced_works_count=0, author_count=1, countries_count=0,
                     institutions_count=0, locations_count=0, ingested_at=dt.datetime(2026, 1, 1))
            rows.append(r)
    return spark.createDataFrame(rows, PAPERS_SCHEMA)


def _day(n):
    return dt.date(2026, 1, 1) + dt.timedelta(days=n)


def _state(days):
    return reports.FilterState.make(_day(0), _day(days - 1))


def test_trend_half_even_and_gaps(spark):
    p = _papers(spark, [(_day(0), 1), (_day(3), 2)])
    t = reports.trend(p, _state(4)).collect()
    assert [r["daily_papers"] for r in t] == [1, 0, 0, 2]
    assert [r["avg_7d"] for r in t] == [1.0, 0.5, 0.3, 0.8]
    p = _papers(spark, [(_day(0), 1)])
    assert reports.trend(p, _state(4)).collect()[3]["avg_7d"] == 0.2


def test_trend_empty_and_ties(spark):
    p = _papers(spark, [(_day(0), 1)])
    state = reports.FilterState.make(_day(10), _day(19))
    t = reports.trend(p, state).collect()
    assert len(t) == 10 and all(r["daily_papers"] == 0 and r["avg_7d"] == 0.0 for r in t)
    assert reports.trend_kpis(p, state).count() == 0
    p = _papers(spark, [(_day(1), 2), (_day(4), 2), (_day(2), 1)])
    k = reports.trend_kpis(p, _state(6)).first()
    assert k["peak_day"] == _day(1) and k["peak_count"] == 2 and k["total"] == 5


def test_trend_sums_to_filtered_count(spark, sf_small):
    papers = D.papers(spark, sf_small)
    state = reports.FilterState.make("1998-01-01", "1998-03-31")
    t = reports.trend(papers, state)
    assert t.count() == 90
    assert t.agg(F.sum("daily_papers")).first()[0] == reports.filtered(papers, state).count() == 60
    assert t.filter("daily_papers > 0").count() == 45


def test_kpis_known_and_empty(spark, sf_small):
    papers = D.papers(spark, sf_small)
    full = reports.FilterState.make(D.FULL_FROM, D.FULL_TO)
    k = reports.kpis(papers, full).first()
    assert k["publications"] == 1481 and round(k["oa_pct"], 4) == 65.6313
    assert k["median_citations"] == 93.0 and k["topics"] == 25 and round(k["avg_authors"], 4) == 3.9932
    empty = reports.kpis(papers, reports.FilterState.make("1980-01-01", "1980-01-02")).first()
    assert tuple(empty) == (0, 0.0, 0.0, 0, 0.0)


def test_topk_is_subset_of_full_groupby(spark, sf_small):
    papers = D.papers(spark, sf_small)
    full = reports.FilterState.make(D.FULL_FROM, D.FULL_TO)
    top = {(r["topic"], r["papers"]) for r in reports.top_topics(papers, full).collect()}
    allg = {(r["primary_topic_name"], r["count"]) for r in
            papers.filter("primary_topic_name IS NOT NULL").groupBy("primary_topic_name").count().collect()}
    assert len(top) == 10 and top <= allg
    assert ("NATION_19", 121) in top
    venues = reports.top_venues(papers, full).first()
    assert (venues["venue"], venues["papers"]) == ("Unknown", 73)
    countries = reports.top_countries(papers, full).first()
    assert (countries["country"], countries["papers"]) == ("NATION_19", 522)


def test_filter_state_optional_parts():
    s = reports.FilterState.make("2020-01-01", "2020-12-31")
    assert "in(" not in str(s.predicate())
    s2 = reports.FilterState.make("2020-01-01", "2020-12-31", ["A"], True)
    text = str(s2.predicate())
    assert "in(primary_topic_name" in text and "is_oa" in text


def test_dq_checks_fire_with_known_counts(spark, sf_small):
    papers = D.papers(spark, sf_small)
    s = {r["check"]: r for r in dq.summary(papers, D.runs(spark, sf_small),
                                           dq.default_checks(D.EXPECTED_SUBFIELD, D.AS_OF)).collect()}
    expected = {"openalex_id_format": 6, "publication_year_matches_date": 15, "ai_subfield": 1144,
                "publication_date_sanity": 337, "oa_flag_status_consistency": 698,
                "citation_percentile_hierarchy": 10, "non_negative_metrics": 306,
                "countries_count_matches_array": 16, "missing_topic_hierarchy": 28,
                "duplicate_openalex_id": 0}
    for name, n in expected.items():
        assert s[name]["violations"] == n, name
    assert s["missing_topic_hierarchy"]["severity"] == "warning"
    dup = dq.duplicate_keys(D.valid_rows(spark, sf_small)).count()
    assert dup == 78


def test_run_checks_samples_and_gate(spark, sf_small):
    papers = D.papers(spark, sf_small)
    checks = dq.default_checks(D.EXPECTED_SUBFIELD, D.AS_OF)
    results = dq.run_checks(papers, D.runs(spark, sf_small), checks)
    by = {r.check.name: r for r in results}
    assert len(by["openalex_id_format"].sample_rows) == 5
    assert by["duplicate_openalex_id"].sample_rows == []
    with pytest.raises(dq.DataQualityError) as e:
        dq.gate(results)
    assert "openalex_id_format (error) found 6" in str(e.value)
    assert by["publication_date_sanity"].sample_rows[0][1] > D.AS_OF  # a date, as stored
    assert all(len(r) == 4 and r[3] == len(r[2]) for r in by["countries_count_matches_array"].sample_rows)
    assert dq.run_checks(papers, None, ()) == [] and dq.summary(papers, None, ()).count() == 0
    bare = dq.run_checks(papers, None, (dq.Check("bare", "no columns named", predicate=F.col("cited_by_count") < 0),))
    assert bare[0].sample_rows and all(len(r) == 1 and r[0].startswith("W") for r in bare[0].sample_rows)
    assert "missing_topic_hierarchy" not in str(e.value)
    with pytest.raises(dq.DataQualityError) as e:
        dq.gate(results, fail_on_warnings=True)
    assert "missing_topic_hierarchy" in str(e.value)
    lines = dq.report_lines(results)
    assert "FAIL [error] openalex_id_format: 6 violation(s)" in lines
    assert "PASS [error] duplicate_openalex_id: 0 violation(s)" in lines
    assert sum(1 for ln in lines if ln.startswith("    sample:")) >= 5
    warn_only = [r for r in results if r.check.severity == "warning"]
    dq.gate([r for r in results if r.violation_count == 0])
    assert dq.failing(warn_only) == []


def test_custom_check(spark, sf_small):
    papers = D.papers(spark, sf_small)
    mine = (dq.Check("no_zero_citations", "citations above zero", "warning",
                     predicate=F.col("cited_by_count") == 0, columns=("openalex_id",)),)
    s = dq.summary(papers, None, mine).first()
    assert s["check"] == "no_zero_citations" and s["violations"] > 0


@pytest.mark.parametrize("paper_count,rows,violation", [
    (100, 95, False), (100, 94, True), (100, 105, False), (10, 9, False), (10, 8, True),
    (0, 0, True), (0, 1, False)])
def test_reconciliation_cases(spark, paper_count, rows, violation):
    from worklake.schema import RUNS_SCHEMA

    papers = _papers(spark, [(_day(0), rows)]) if rows else _papers(spark, [(_day(40), 1)])
    runs = spark.createDataFrame(
        [(1, dt.datetime(2026, 1, 1), _day(-50), _day(-40), "s", 999, dt.datetime(2026, 1, 1)),
         (2, dt.datetime(2026, 1, 2), _day(0), _day(3), "s", paper_count, dt.datetime(2026, 1, 2))],
        RUNS_SCHEMA)
    assert (dq.reconcile(papers, runs).count() == 1) == violation


def test_reconciliation_no_runs(spark):
    papers = _papers(spark, [(_day(0), 3)])
    assert dq.reconcile(papers, None).count() == 0


def test_classification_check(spark, sf_small):
    raw = D.raw_works(spark, sf_small)
    with pytest.raises(dq.ClassificationError) as e:
        dq.assert_classification(raw, "Building")
    assert "1215 record(s)" in str(e.value) and str(e.value).count("openalex.org/W") == 3
    only = raw.filter(F.col("primary_topic.subfield.display_name") == "BUILDING")
    dq.assert_classification(only, "building")


def test_local_frames_and_labels(spark, sf_small):
    papers = D.papers(spark, sf_small)
    full = reports.FilterState.make(D.FULL_FROM, D.FULL_TO)
    pdf = reports.to_local(reports.top_topics(papers, full), max_rows=10)
    assert list(pdf.columns) == ["topic", "papers"] and len(pdf) == 10
    with pytest.raises(reports.ResultTooLarge):
        reports.to_local(reports.paper_list(papers, full), max_rows=100)
    labels = reports.kpi_labels(reports.kpis(papers, full).first())
    assert labels == {"Publications": "1,481", "Open access": "65.6%", "Median citations": "93",
                      "Topics": "25", "Avg authors": "4.0"}
    assert reports.kpi_labels({"publications": 3, "oa_pct": 0.25, "median_citations": 2.5,
                               "topics": 1, "avg_authors": 0.25})["Median citations"] == "2"
    t = reports.trend_kpi_labels(reports.trend_kpis(papers, full).first())
    assert t["Total in range"] == "1,481" and len(t["Peak day"]) == 10
