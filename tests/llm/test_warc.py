import hashlib
import random

import pytest

import __spark_entry__ as E
from worklake.llm import warc as W


def brute(pages, least=100):
    first, out = {}, []
    for i, _, h in pages:
        raw = (h or "").encode()
        if len(raw) >= least and i is not None:
            first[raw] = min(first.get(raw, i), i)
    for i, _, h in pages:
        raw = (h or "").encode()
        copy = raw in first and (i is None or i > first[raw])
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if copy else "response", first[raw] if copy else None))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def test_round_trip_equals_brute_force(spark, tmp_path):
    draw = random.Random(2)
    bodies = [None, "", "x" * 99, "x" * 100, "é" * 50, "WARC/1.1\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n" * 5, "\r\n\r\n" * 60, "z" * 300_000, "\x00" * 120]
    pages = [(k, f"http://h/{k}\r\nX: y", draw.choice(bodies)) for k in range(200)]
    pages += [(5, "http://h/5", pages[5][2]), (None, None, "q" * 200), (None, None, "x" * 100)]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, payload_digest string")
    assert rows(W.archive_round_trip(spark, df)) == brute(pages)
    path = W.write_archive(spark, df, str(tmp_path / "a"))
    back = W.read_archive(spark, path, with_payload=True).where("record_type = 'response'").collect()
    payloads = {i: h or "" for i, _, h in pages}
    assert all(r.payload == payloads[r.page_id] for r in back if r.page_id is not None)
    assert W.archive_round_trip(spark, df.limit(0)).count() == 0


def test_one_large_page_shares_no_file(spark, tmp_path):
    import glob

    rows_ = [(k, f"u{k}", "small page " * 12 + str(k)) for k in range(400)] + [(900, "big", "x" * 30_000_000), (901, "copy", "small page " * 12 + "7")]
    df = spark.createDataFrame(rows_, "page_id long, url string, html string").coalesce(1)
    path = W.write_archive(spark, df, str(tmp_path / "a"))
    assert len(glob.glob(f"{path}/size=*/*.gz")) == 2
    assert rows(W.resolve(W.read_archive(spark, path))) == brute(rows_)
    import gzip
    text = b"".join(gzip.open(f).read(40_000_000) for f in glob.glob(f"{path}/size=0/*.gz"))
    copy = [h for h, _ in W.parse_records(text) if h["warc-type"] == "revisit"]
    assert [(h["warc-target-uri"], h["warc-refers-to-target-uri"]) for h in copy] == [("copy", "u7")]
    assert not copy[0]["warc-date"].startswith("2000")


def test_cut_or_changed_records_are_errors():
    record = b"WARC/1.1\r\nContent-Length: 10\r\n\r\nabc\r\n\r\n"
    with pytest.raises(ValueError):
        list(W.parse_records(record))
    with pytest.raises(ValueError):
        list(W.parse_records(b"no record\r\n\r\n"))


def test_query(spark, sf_small):
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf_small}/pages.parquet").collect()]
    assert rows(E.queries()["op9_warc"](spark, sf_small)) == brute(pages)
