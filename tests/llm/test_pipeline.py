"""The pipeline's stages against plain versions on a small table with planted cases."""

import pytest

import __spark_entry__ as E
import corpus_pipeline
from test_packing import check


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents of the small set with planted copies, passages and leaks, and clashing columns' names."""
    sf = "/root/testdata/sf0.01"
    out = str(tmp_path_factory.mktemp("pipeline"))
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 300").collect()]
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    words = [f"w{k}x" for k in range(400)]
    passage = " ".join(words[:60])
    new = [
        (1001, "first of a pair. " + " ".join(words[60:160])),
        (1002, "first of a pair. " + " ".join(words[60:158]) + " other end"),
        (1003, "line before\n" + passage + "\n" + " ".join(words[170:230])),
        (1004, "another line before\n" + passage + "\n" + " ".join(words[240:300])),
        (1005, " ".join(words[300:340]) + " " + items[0].text + " " + " ".join(words[340:380])),
        (1006, None), (1007, ""), (1008, " ".join(words[200:330:2])),
    ]
    docs += [(i, t, None, "planted", None) for i, t in new]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{out}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").write.parquet(f"{out}/{name}.parquet")
    return out


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, apply in corpus_pipeline.STAGES:
        out = apply(spark, docs, folder)
        path = str(tmp_path / name)
        out.write.parquet(path)
        after = spark.read.parquet(path)
        if name != "packing":
            assert after.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = {r.doc_id: r.text if "text" in after.columns else None for r in after.collect()}
        last, docs = docs, after
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    first = kept["quality_classifier"]
    good = [i for i in range(300) if labels.get(i) == 1]
    bad = [i for i in range(300) if labels.get(i) == 0]
    assert sum(i in first for i in good) >= 0.97 * len(good) and sum(i in first for i in bad) <= 0.1 * len(bad)
    lines = kept["line_dedup"]
    if {1003, 1004} <= first.keys():
        assert "w10x" in lines[1003] and "w10x" not in lines[1004] and "another line before" in lines[1004]
    pairs = kept["ngram_join"]
    if {1001, 1002} <= lines.keys():
        assert 1001 in pairs and 1002 not in pairs
    clean = kept["decontamination"]
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert 1005 not in clean and {i for i, t in pairs.items() if not any(x in (t or "") for x in items)} == set(clean)
    check(docs.collect(), [(r.doc_id, r.text) for r in last.collect()])


def test_run_is_the_stages(spark, folder):
    rows = E.queries()["pipeline"](spark, folder).collect()
    assert rows and len({(r.sequence_id, r.offset) for r in rows}) == len(rows)


def test_empty_documents(spark, folder, tmp_path):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_names():
    ops = [k for k in E.queries() if k.startswith("op")]
    assert sorted(int(k[2:].split("_")[0]) for k in ops) == list(range(1, 14)) and "pipeline" in E.queries()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "ngram_join", "decontamination", "packing"]
