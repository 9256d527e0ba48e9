import random

import __spark_entry__ as E
from worklake.llm import decontaminate as D


def edit_distance_inside(p, t):
    row = [0] * (len(t) + 1)
    for i, a in enumerate(p, 1):
        before, row[0] = row[0], i
        for j, b in enumerate(t, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (a != b))
    return min(row)


def test_myers_against_dynamic_programming():
    draw = random.Random(5)
    for _ in range(300):
        p = "".join(draw.choice("abc ") for _ in range(draw.randint(1, 90)))
        t = "".join(draw.choice("abc ") for _ in range(draw.randint(0, 120)))
        if draw.random() < 0.5 and len(t) > 10:
            t = t[:5] + p[: len(p) // 2] + p[len(p) // 2 + 1:] + t[5:]
        distance, end = D.myers(p, t)
        assert distance == edit_distance_inside(p, t)
        assert distance == len(p) or edit_distance_inside(p, t[:end]) == distance


def edited(text, edits, draw):
    s = list(text)
    for _ in range(edits):
        k = draw.randrange(len(s))
        s[k:k + draw.randint(0, 1)] = draw.choice(("", "q", "zz")[:2])
    return "".join(s)


def test_finds_all_within_the_budget(spark):
    draw = random.Random(9)
    word = lambda: "".join(draw.choice("etaoinsh") for _ in range(draw.randint(1, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(k, prose(draw.randint(8, 40))) for k in range(12)]
    docs = []
    for k in range(120):
        text = prose(draw.randint(0, 80))
        if k % 2:
            item = items[draw.randrange(12)][1]
            text += " " + edited(item, draw.randint(0, 12), draw).upper() + "! " + prose(20)
        docs.append((k, text))
    expected = set()
    for k, text in docs:
        for i, item in items:
            p, t = D.normal_form(item), D.normal_form(text)
            d = edit_distance_inside(p, t)
            if d <= int(D.ERROR_RATE * len(p)):
                expected.add((k, i, d))
    got = D.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                       spark.createDataFrame(items, "item_id long, text string"), block_chars=600)
    assert {(r.doc_id, r.item_id, r.distance) for r in got.collect()} == expected and len(expected) > 20


def test_edge_rows(spark):
    item = "a passage of the benchmark that leaked into the corpus"
    docs = spark.createDataFrame([(1, None, 1), (2, "", 2), (3, f"so {item.upper()}, again", 3), (3, f"so {item.upper()}, again", 3),
                                  (None, item, None), (5, "clean " * 50_000, 5)], "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(7, item), (7, item), (8, None), (9, ""), (10, "the"), (None, item)], "item_id long, text string")
    got = [(r.doc_id, r.item_id, r.distance) for r in D.find_leaks(docs, items).collect()]
    assert sorted(got, key=str) == sorted([(d, i, 0) for d in (3, 3, None) for i in (7, 10)], key=str)
    kept = D.drop_leaks(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 5]
    assert D.find_leaks(docs, items.limit(0)).count() == 0 and D.find_leaks(docs.limit(0), items).count() == 0


def test_short_items_match_whole_words_unchanged(spark):
    docs = spark.createDataFrame([(1, "So: WHAT is 2 + 2?"), (2, "what is 2 23"), (3, "what is 2 2"), (4, "xwhat is 2 2"),
                                  (5, "what is 22"), (6, "no no no")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "What is 2+2?"), (8, "no no"), (9, "+")], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id, r.distance, r.end) for r in D.find_leaks(docs, items).collect()) == [
        (1, 7, 0, 14), (3, 7, 0, 11), (6, 8, 0, 5)]
    assert sorted(r.doc_id for r in D.drop_leaks(docs, items).collect()) == [2, 4, 5]


def test_query_finds_planted_passages(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()
    plain = {(d.doc_id, i.item_id) for d in docs for i in items if i.text in d.text}
    got = {(r.doc_id, r.item_id) for r in E.queries()["op4_decontamination"](spark, sf_small).collect()}
    assert plain <= got and len(got) <= len(plain) + 2
