"""S3: splitting envelope documents at any byte, against json.loads of the whole document."""

import json
import os
import random

import pytest

from rawworks import B, work
from worklake.sources import envelopes as V
from worklake.sources import works as W

TEXTS = ["x", 'a"b', "}{", "\\", '\\"', "papers", '[",]', ":{", "é😀", '{"papers": [', '\\\\"', ""]


def value(draw, depth=0):
    kind = draw.randint(0, 7)
    if kind < 3 or depth > 3:
        return draw.choice(TEXTS)
    if kind == 3:
        return draw.choice([None, True, 1.5, -3])
    if kind == 4:
        return [value(draw, depth + 1) for _ in range(draw.randint(0, 4))]
    return {draw.choice(["papers", "k", "a}b", 'q"', "x"]): value(draw, depth + 1) for _ in range(draw.randint(0, 4))}


@pytest.fixture
def split_at(spark):
    def at(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield at
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_short_documents_are_read_once(spark, tmp_path):
    """steps for documents of several blocks open none of one block."""
    for i in range(5):
        (tmp_path / f"d{i}.json").write_text(json.dumps({"papers": [{"k": i}]}))
    assert V.fragments(spark, str(tmp_path)).rdd.getNumPartitions() > 0
    assert V.fragments(spark, str(tmp_path), only_long=True).rdd.getNumPartitions() == 0


@pytest.mark.parametrize("size", ["128m", "160", "1000"])
def test_documents_of_any_shape(spark, tmp_path, split_at, size):
    draw, docs = random.Random(3), {}
    for i in range(10):
        top = {}
        for name in draw.sample(["fetched_at", "subfield", "papers", "count", "z"], 5):
            top[name] = [value(draw) for _ in range(draw.randint(0, 30))] if name == "papers" else value(draw)
        if i < 3:
            top["papers"] = [None, {"papers": [1, 2]}, []][i]
        text = json.dumps(top, indent=draw.choice([None, 2]), ensure_ascii=draw.random() < 0.5) + draw.choice(["", "\n"])
        (tmp_path / f"d{i}.json").write_text(text)
        docs[f"d{i}.json"] = top
    split_at(size)
    elements, around = V.pieces(spark, str(tmp_path))
    got = {}
    for r in elements.collect():
        got.setdefault(os.path.basename(r.file), []).append((r.place, json.loads(r.text)))
    rest = {os.path.basename(r.file): json.JSONDecoder().raw_decode(r.text)[0] for r in around.collect()}
    for name, top in docs.items():
        papers = top["papers"] if isinstance(top["papers"], list) else []
        assert sorted(got.get(name, []), key=lambda x: x[0]) == list(enumerate(papers))
        assert rest[name] == {**top, "papers": [] if isinstance(top["papers"], list) else top["papers"]}


def test_one_document_is_read_by_many_tasks(spark, tmp_path, split_at):
    papers = [work(B + f"W{i}", title='t"}' * (i % 7)) for i in range(600)]
    (tmp_path / "my export 1.json").write_text(json.dumps({"count": 600, "papers": papers, "fetched_at": "2026-06-15T10:00:00"}))
    split_at("20k")
    assert V.fragments(spark, str(tmp_path)).rdd.getNumPartitions() >= 10
    rows = W.read_export(spark, str(tmp_path)).select("_pos", "id", "title", "_corrupt_record").collect()
    assert sorted(tuple(r) for r in rows) == [(i, p["id"], p["title"], None) for i, p in enumerate(papers)]
    assert W.read_envelopes(spark, str(tmp_path)).select("count", "fetched_at").first() == (600, "2026-06-15T10:00:00")


def test_truncated_document_is_corrupt_and_gives_whole_papers_only(spark, tmp_path, split_at):
    text = json.dumps({"papers": [work(B + f"W{i}") for i in range(50)]})
    (tmp_path / "d.json").write_text(text[:len(text) // 2])
    split_at("4k")
    with pytest.raises(W.EnvelopeError):
        W.check_envelopes(W.read_envelopes(spark, str(tmp_path)))
    places = sorted(r["_pos"] for r in W.read_export(spark, str(tmp_path)).collect())
    assert places == list(range(len(places))) and 20 <= len(places) < 26


def test_no_documents(spark, tmp_path):
    (tmp_path / "empty.json").write_text("")
    assert W.read_export(spark, str(tmp_path)).count() == 0 and W.read_envelopes(spark, str(tmp_path)).count() == 0
