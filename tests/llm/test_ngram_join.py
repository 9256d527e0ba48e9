"""Components of the n-gram Jaccard join against brute force, and its edge rows."""

import random

import numpy as np
import pytest

import __spark_entry__ as E
from worklake.llm import ngram_join as N


def brute(rows, n, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * len(sets[a] | sets[b]) and find(a) != find(b):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def copies(seed, families=6, size=25):
    """Families of near copies with word edits, shared passages, short texts and exact copies."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 6)))
    passage = " ".join(word() for _ in range(30))
    out = []
    for _ in range(families):
        base = [word() for _ in range(draw.randint(20, 160))]
        for _ in range(size):
            w = list(base)
            for _ in range(draw.choice((0, 0, 1, 1, 2, 3, 5))):
                w[draw.randrange(len(w))] = word()
            out.append(" ".join(w) if draw.random() < 0.8 else passage + " " + " ".join(w).upper())
    return out + ["", "one", "One", "one two", None, " \n\t", passage, passage + " end"]


@pytest.mark.parametrize("n,percent,tile", [(4, 85, 8), (5, 80, 768)])
def test_components_equal_brute_force(spark, n, percent, tile):
    rows = list(enumerate(copies(n)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.link_components(df, n, percent, tile=tile).collect()}
    assert got == brute(rows, n, percent)


def test_edge_rows(spark):
    text = " ".join(f"w{k}" for k in range(40))
    df = spark.createDataFrame([(3, text, "x", 1), (3, text, "x", 1), (None, text, None, 2), (1, text, None, None), (7, None, "y", 0)],
                               "doc_id long, text string, digest string, size int")
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in N.link_components(df, 4, 85).collect())
    assert got == [("1", 37, 1), ("3", 37, 1), ("3", 37, 1), ("7", 0, 7), ("None", 37, None)]
    kept = N.keep_first(df)
    assert kept.columns == df.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "7"]
    assert N.link_components(df.limit(0), 4, 85).count() == 0


def test_ids_with_several_texts_and_repeated_rows(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(30)) for x in "abc")
    df = spark.createDataFrame([(1, a), (5, b), (7, a), (7, b), (9, c), (9, c), (9, None), (None, c), (None, "")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in N.link_components(df, 4, 85).collect()), key=str)
    assert got == [(1, 27, 1), (5, 27, 1), (7, 27, 1), (7, 27, 1), (9, 0, 9), (9, 27, 9), (9, 27, 9), (None, 0, None), (None, 27, None)]
    kept = sorted(((r.doc_id, r.text) for r in N.keep_first(df).collect()), key=str)
    assert kept == sorted([(1, a), (5, b), (9, c), (9, None), (None, "")], key=str)
    same = spark.createDataFrame([(4, a)] * 3 + [(None, b)] * 2, "doc_id long, text string")
    assert sorted(((r.doc_id, r.text) for r in N.keep_first(same).collect()), key=str) == [(4, a), (None, b)]


def test_bitmap_bound_is_never_too_low():
    draw = np.random.default_rng(3)
    for _ in range(200):
        x = np.unique(draw.integers(0, 1 << 62, 60).astype(np.uint64))
        y = np.unique(np.concatenate([x[draw.random(x.size) < draw.random()], draw.integers(0, 1 << 62, 20).astype(np.uint64)]))
        bx, by = N.bitmap(x, 256)[None], N.bitmap(y, 256)[None]
        pairs = N.possible(bx, np.array([x.size]), by, np.array([y.size]), 80)
        if N.linked(N.overlap_size(x, y), x.size, y.size, 80):
            assert len(pairs) == 1


def test_long_text_and_query(spark, sf_small):
    rows = [(1, "lorem " * 20_000), (2, "lorem " * 30_000), (3, "x" * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.link_components(df).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (1, 3)}
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in E.queries()["op1_ngram_join"](spark, sf_small).collect()}
    assert got == brute([(r.doc_id, r.text) for r in docs], 4, 85)
