"""Edge rows E01–E21 / G1–G6: flatten, reject routing, first-wins, counters."""

import pytest
from pyspark.sql import functions as F

from rawworks import B, edge_rows, frame, work
from worklake.operators import dedup
from worklake.operators.flatten import (REJECT, ConstraintError, accepted,
                                        assert_no_constraint_violations, flatten)


def _by_pos(df):
    return {r["_pos"]: r for r in df.collect()}


def test_edge_rows_flatten_and_reasons(spark):
    flat = _by_pos(flatten(frame(spark, edge_rows())))
    e01 = flat[0]
    assert e01[REJECT] is None and e01["openalex_id"] == "W1"
    assert list(e01["country_codes"]) == ["DE", "US"]
    assert e01["author_count"] == 4 and e01["countries_count"] == 0
    assert flat[1][REJECT] == "missing_title"
    for i in (3, 4, 5):
        assert flat[i][REJECT] == "missing_id"
    assert flat[6][REJECT] is None and flat[6]["openalex_id"] == "W2" and flat[6]["title"] == "D"
    assert flat[7][REJECT] == "missing_title"
    assert flat[8][REJECT] is None and flat[8]["title"] == " "
    for i in (9, 10, 11):
        assert flat[i][REJECT] == "missing_date"
    assert flat[12][REJECT] is None and flat[12]["publication_year"] == 0
    assert flat[13][REJECT] == "missing_title"
    assert flat[14]["author_count"] == 0 and flat[14]["country_codes"] is None
    assert flat[15]["author_count"] == 1 and flat[15]["country_codes"] is None
    assert flat[16]["primary_topic_id"] == ""
    e18 = flat[17]
    assert e18["is_oa"] is False and e18["oa_status"] is None
    assert e18["is_core_source"] is None and e18["is_top_1_percent"] is None
    e19 = flat[18]
    assert (e19["cited_by_count"], e19["referenced_works_count"], e19["countries_count"],
            e19["institutions_count"], e19["locations_count"]) == (0, 0, 0, 0, 0)
    assert flat[20][REJECT] is None and flat[20]["openalex_id"] == "X99"


def test_export_path_counters(spark):
    c = dedup.ingest_counters(frame(spark, edge_rows())).first()
    assert (c["upserted"], c["skipped_invalid"], c["duplicates_in_file"]) == (10, 9, 2)
    assert c["papers"] == 21


def test_fetch_path_then_batch(spark):
    raw = frame(spark, edge_rows())
    skipped = dedup.fetch_duplicates_skipped(raw).first()["duplicates_skipped"]
    assert skipped == 2
    c = dedup.ingest_counters(dedup.fetch_dedup(raw)).first()
    assert (c["upserted"], c["skipped_invalid"], c["duplicates_in_file"]) == (10, 8, 1)


def test_swap_e01_e02(spark):
    rows = edge_rows()
    rows[0], rows[1] = rows[1], rows[0]
    raw = frame(spark, rows)
    export = dedup.batch_dedup(flatten(raw)).filter(F.col("openalex_id") == "W1").first()
    assert export["_pos"] == 1  # E01, now second, still wins on the export path
    fetch = dedup.batch_dedup(flatten(dedup.fetch_dedup(raw))).filter(F.col("openalex_id") == "W1").first()
    assert fetch["_pos"] == 19  # E02 shadowed E01 and E03 at fetch time; W1 comes from E20


def test_first_wins_independent_of_partitioning(spark, sf_small):
    from worklake.plans import derived as D

    raw = D.raw_works(spark, sf_small)
    expect = sorted(tuple(r) for r in dedup.batch_dedup(flatten(raw)).select("openalex_id", "_src", "_pos").collect())
    for n in (1, 7, 200):
        got = sorted(tuple(r) for r in dedup.batch_dedup(flatten(raw.repartition(n)))
                     .select("openalex_id", "_src", "_pos").collect())
        assert got == expect


def test_conservation(spark, sf_small):
    from worklake.plans import derived as D

    states = {r["state"]: r["count"] for r in
              dedup.prepare_rows(D.raw_works(spark, sf_small)).groupBy("state").count().collect()}
    c = dedup.ingest_counters(D.raw_works(spark, sf_small)).first()
    assert states["accepted"] == c["upserted"] == 1481
    assert states["invalid"] == c["skipped_invalid"] == 20
    assert states["duplicate"] == c["duplicates_in_file"] == 78
    assert sum(states.values()) == c["papers"]


def test_constraint_rows(spark):
    rows = [
        work(B + "W1", primary_topic={"id": None, "display_name": "x", "score": 12.0,
                                      "subfield": None, "field": None, "domain": None}),    # G1
        work(B + "W2", date="2024"),                                                        # G2
        work(B + "W3", authorships=[{"countries": ["US"]}] * 40000),                        # G3
        work(B + "W4", authorships=[None, {"countries": ["FR"]}]),                         # G4
        work(B + "W5", authorships=[{"countries": [None, "IT"]}]),                         # G5
    ]
    flat = _by_pos(flatten(frame(spark, rows)))
    assert flat[0][REJECT] == "out_of_range:primary_topic_score"
    assert flat[1][REJECT] == "bad_date"
    assert flat[2][REJECT] == "out_of_range:author_count"
    assert flat[3][REJECT] is None and list(flat[3]["country_codes"]) == ["FR"]
    assert flat[4][REJECT] is None and list(flat[4]["country_codes"]) == ["IT"]
    with pytest.raises(ConstraintError):
        assert_no_constraint_violations(flatten(frame(spark, rows)))
    assert_no_constraint_violations(flatten(frame(spark, rows[3:])))


def test_malformed_json_line(spark, tmp_path):
    from worklake.sources.works import read_works

    p = tmp_path / "landing"
    p.mkdir()
    (p / "a.json").write_text('{"id": "https://openalex.org/W1", "title": "T", '
                              '"publication_date": "2026-01-02", "publication_year": 2026}\n{broken\n')
    flat = flatten(read_works(spark, str(p)))
    reasons = sorted((r[REJECT] or "ok") for r in flat.collect())
    assert reasons == ["malformed", "ok"]
    assert accepted(flat).count() == 1
