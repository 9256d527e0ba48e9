import zlib

import numpy as np

import __spark_entry__ as E
from worklake.llm import quality_model as Q


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = E.queries()["op2_quality_classifier"](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [(marks[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in marks]
    assert np.mean([a == b for a, b in held]) > 0.95
    good = [p for a, p in held if a == 1]
    assert np.mean(good) > 0.97  # clean documents stay


def test_edge_rows(spark):
    schema = "doc_id long, text string, score string, fold int"
    df = spark.createDataFrame([(1, None, "a", 1), (None, "some words here", None, None), (2, "", "b", 2), (2, "", "b", 2),
                                (3, "x" * 200_000, "c", 3)], schema)
    labels = spark.createDataFrame([(1, 1), (2, None), (99, 0), (None, 1)], "doc_id long, quality int")
    rows = Q.classify(df, labels).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    none = Q.classify(df, labels.limit(0)).collect()
    assert all(r.score == 1.0 and r.predicted == 1 for r in none)
    assert Q.classify(df.limit(0), labels).count() == 0
    kept = Q.keep_good(df, labels.limit(0))
    assert kept.schema.fieldNames() == df.columns and kept.count() == 5


def test_isotonic_fit():
    fit = Q.pool_adjacent_violators([0.1, 0.5, 0.3, 0.3, 0.9], [1, 1, 1, 2, 1])
    assert np.allclose(fit, [0.1, 0.35, 0.35, 0.35, 0.9])
    draw = np.random.default_rng(0)
    v, w = draw.random(50), draw.random(50) + 0.1
    fit = Q.pool_adjacent_violators(v, w)
    assert (np.diff(fit) >= 0).all() and np.isclose((fit * w).sum(), (v * w).sum())


def test_partition_sums_equal_one_sum(spark):
    from worklake.llm.common import tree_sum

    draw = np.random.default_rng(1)
    vectors = draw.random((40, 7))
    df = spark.createDataFrame([(bytearray(v.tobytes()),) for v in vectors], "v binary").repartition(13)
    assert np.allclose(tree_sum(df, "v", fan_in=3), vectors.sum(0))
    assert tree_sum(df.limit(0), "v") is None
