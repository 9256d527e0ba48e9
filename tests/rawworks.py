"""Hand-written raw works for edge-row tests (FIXTURES §4)."""

from __future__ import annotations

import copy

from worklake.sources.works import LANDING_SCHEMA

B = "https://openalex.org/"


def work(id=B + "W1", title="T", date="2026-06-12", year=2026, **extra) -> dict:
    w = {f.name: None for f in LANDING_SCHEMA.fields}
    w.update({"id": id, "title": title, "publication_date": date, "publication_year": year})
    for k, v in extra.items():
        w[k] = v
    return w


def frame(spark, works: list[dict], src: str = "f0"):
    rows = []
    for i, w in enumerate(works):
        w = copy.deepcopy(w)
        w["_src"], w["_pos"] = w.get("_src") or src, i
        rows.append(w)
    return spark.createDataFrame(rows, LANDING_SCHEMA)


def authors(*country_lists):
    return [{"countries": c} if c is not ... else {} for c in country_lists]


def edge_rows() -> list[dict]:
    """E01–E21 in input order."""
    return [
        work(B + "W1", authorships=[{"countries": ["US", "DE"]}, {"countries": ["US"]},
                                    {"countries": None}, {"countries": None}],
             open_access={"is_oa": True, "oa_status": "gold", "oa_url": None}),          # E01
        work(B + "W1", title=None, display_name=None),                                     # E02
        work(B + "W1", title="B"),                                                         # E03
        work(None),                                                                        # E04
        work(""),                                                                          # E05
        work(B),                                                                           # E06
        work("W2", title="", display_name="D"),                                            # E07
        work(B + "W3", title="", display_name=""),                                         # E08
        work(B + "W4", title=" "),                                                         # E09
        work(B + "W5", date=""),                                                           # E10
        work(B + "W6", date=None),                                                         # E11
        work(B + "W7", year=None),                                                         # E12
        work(B + "W8", year=0),                                                            # E13
        work(B + "W9", title=None, display_name=None, date=None),                          # E14
        work(B + "W10"),                                                                   # E15
        work(B + "W11", authorships=[{"countries": []}]),                                  # E16
        work(B + "W12", primary_topic={"id": B, "display_name": None, "score": None,
                                       "subfield": None, "field": None, "domain": None}),  # E17
        work(B + "W13"),                                                                   # E18
        work(B + "W14"),                                                                   # E19
        work("http://other/W1"),                                                           # E20
        work(B + "X99"),                                                                   # E21
    ]
