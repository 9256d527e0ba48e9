import random
import re
from collections import Counter

import __spark_entry__ as E
from worklake.llm import quality_rules as R

WORD = re.compile("[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    covered = {p for k in range(len(w) - 4) if windows[tuple(w[k:k + 5])] > 1 for p in range(k, k + 5)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    base = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), again, len(covered), base


def got(df):
    return [(r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)) for r in df.collect()]


def test_counts_equal_brute_force(spark):
    draw = random.Random(6)
    texts = ["".join(draw.choice(["a ", "b ", "c\n", "é ", "\x0b", "\x1c", " ", "#", "|x ", "\r\n", "a b c d e "])
                     for _ in range(draw.randint(0, 60))) for _ in range(400)]
    texts += [None, "", "one two three four five", "a b c d e a b c d e", "w " * 30_000, "x" * 100_000,
              " ".join(str(k) for k in range(20_000))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert dict(got(R.apply_rules(df))) == {k: counts(t) for k, t in enumerate(texts)}


def test_query_and_verdicts(spark, sf_small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    df = E.queries()["op6_quality_rules"](spark, sf_small)
    assert dict(got(df)) == {k: counts(t) for k, t in texts.items()}
    rows = df.collect()
    assert all(not r.kept for r in rows if r.base_failed)
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_small}/labels.parquet").collect()}
    good = [r for r in rows if marks.get(r.doc_id) == 1 and not r.base_failed]
    assert sum(not r.kept for r in good) <= 0.02 * len(good)


def test_order_changes_no_verdict(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rules = R.default_rules()
    kept = [{r.doc_id for r in R.apply_rules(docs, x, order=False).where("kept").collect()} for x in (rules, rules[::-1])]
    assert kept[0] == kept[1]


def test_no_python_in_the_plan(spark, sf_small):
    plan = E.queries()["op6_quality_rules"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_edge_rows(spark):
    df = spark.createDataFrame([(None, "x", 1, "t"), (1, None, 2, None), (1, None, 2, None)], "doc_id long, text string, n_words int, c string")
    rows = R.apply_rules(df).collect()
    assert len(rows) == 3 and not any(r.kept for r in rows)
    assert R.apply_rules(df.limit(0)).count() == 0
