import difflib
import random

import __spark_entry__ as E
from worklake.llm import line_dedup as L


def test_patience_matches_equal_lines_in_order():
    draw = random.Random(2)
    for _ in range(300):
        a = [draw.randint(0, 30) for _ in range(draw.randint(0, 40))]
        b = [draw.randint(0, 30) for _ in range(draw.randint(0, 20))] + a[5:20] + [draw.randint(0, 30) for _ in range(5)]
        pairs = L.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
    a, b = list("abcdefg"), list("xabcydefz")
    assert [a[i] for i, _ in L.patience(a, b)] == [a[m.a + k] for m in difflib.SequenceMatcher(None, a, b).get_matching_blocks() for k in range(m.size)]


LINE = "line {} with quite a few words in it for the test"


def test_later_copies_go_and_the_first_stays(spark):
    long = [LINE.format(k) for k in range(6)]
    docs = [(1, "\n".join(long[:3])), (2, "own start\n" + "\n".join(long[:2]) + "\n\nown end"), (3, "\n".join(long[3:])),
            (4, "\n".join(long[2:5]) + "\nhi"), (5, "hi\nshort line"), (6, "short line"), (7, "\n".join(long[:3]))]
    got = {r.doc_id: (r.text, r.removed_lines, list(r.sources)) for r in
           L.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[1] == (docs[0][1], 0, []) and got[3] == (docs[2][1], 0, [])
    assert got[2] == ("own start\n\nown end", 2, [1])
    assert got[4] == ("hi", 3, [1, 3])
    assert got[5][1] == got[6][1] == 0
    assert got[7] == ("", 3, [1])


def test_edge_rows(spark):
    text = "\n".join(LINE.format(k) for k in range(3))
    schema = "doc_id long, text string, copy_numbers string, copy_id int, extra array<int>"
    df = spark.createDataFrame([(1, text, "a", 1, [1]), (1, text, "a", 1, [1]), (None, text, None, None, None), (2, None, "b", 2, []),
                                (3, "", "c", 3, [3]), (4, text + "\n" + "y " * 50_000, "d", 4, None)], schema)
    out = L.keep_own_lines(df)
    assert out.columns == df.columns
    rows = sorted(((str(r.doc_id), r.text, r.copy_numbers) for r in out.collect()), key=str)
    assert [r[0] for r in rows] == ["1", "1", "2", "3", "4", "None"]
    assert rows[0][1] == text and rows[2][1] is None and rows[4][1] == "y " * 50_000 and rows[5][1] == text
    assert L.dedup_lines(df.limit(0)).count() == 0


def test_query_leaves_no_long_repeated_line(spark, sf_small):
    rows = E.queries()["op10_line_dedup"](spark, sf_small).collect()
    before = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    assert len(rows) == len(before)
    seen = {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        for line in {x.strip() for x in r.text.split("\n") if len(x.split()) >= 50}:
            assert line not in seen, (r.doc_id, seen[line])
            seen[line] = r.doc_id
    whole = {x.strip() for t in before.values() for x in t.split("\n")}
    left = {x.strip() for r in rows for x in r.text.split("\n")}
    assert whole | {""} == left | {""}  # every line is still there once


def lines_of(text):
    return [x.strip(L._SPACES) for x in text.split("\n") if x.strip(L._SPACES)]


def expected(docs, min_words=L.MIN_WORDS):
    """Lines in a block of at least min_words words that an earlier document holds, by brute force."""
    out, blocks = {}, set()
    for doc, text in sorted(docs):
        lines, gone, own = lines_of(text), set(), set()
        for i in range(len(lines)):
            for j in range(i + 1, len(lines) + 1):
                if len(" ".join(lines[i:j]).split()) >= min_words:
                    own.add(tuple(lines[i:j]))
                    if tuple(lines[i:j]) in blocks:
                        gone.update(range(i, j))
        blocks |= own
        out[doc] = sorted(gone)
    return out


def removed(spark, docs):
    rows = L.copied_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    return {doc: [] for doc, _ in docs} | {r.doc_id: list(r.numbers) for r in rows}


def test_block_of_short_lines_held_first_by_others(spark):
    block = ["one two three", "four five six", "seven eight nine"]
    docs = [(k, f"own {k}\n{line}\nend {k}") for k, line in enumerate(block)]
    docs += [(8, "\n".join(["eighth", *block])), (9, "\n".join([*block, "ninth"]))]
    assert removed(spark, docs) == expected(docs) == {0: [], 1: [], 2: [], 8: [], 9: [0, 1, 2]}


def test_runs_find_every_shared_block(spark):
    draw = random.Random(5)
    words = [" ".join(f"w{k}" for _ in range(draw.randint(1, 5))) for k in range(12)] + [LINE.format(k) for k in range(4)]
    docs = [(k, "\n".join(draw.choice(words) for _ in range(draw.randint(0, 25)))) for k in range(60)]
    want = expected(docs)
    assert any(want.values()) and removed(spark, docs) == want
    for k, later in docs:  # an alignment with any earlier document finds a part of it
        sides = [[(n, x, len(x.split())) for n, x in enumerate(lines_of(t))] for t in [later, *(t for i, t in docs if i < k)]]
        assert all(set(L.copied(first, sides[0])) <= set(want[k]) for first in sides[1:])


def test_aligned_lines_equal_brute_force():
    draw = random.Random(7)
    for _ in range(400):
        code = {x: (hash((x, 1)) & ~L._WORDS) | (x % 5 + 1) for x in range(9)}
        a, b = ([draw.randint(0, draw.choice([2, 8])) for _ in range(draw.randint(0, 30))] for _ in range(2))
        b += a[3:12] * draw.randint(0, 3)
        want = set()
        for n in range(len(b)):
            for p in range(len(a)):
                m = 0
                while n + m < len(b) and p + m < len(a) and b[n + m] == a[p + m]:
                    m += 1
                if sum(x % 5 + 1 for x in b[n:n + m]) >= L.MIN_WORDS:
                    want |= set(range(n, n + m))
        assert L.aligned_lines(dict(enumerate(code[x] for x in a)), dict(enumerate(code[x] for x in b))) == want


def test_patience_is_on_the_path(spark, monkeypatch):
    block = [LINE.format(k) for k in range(9)]
    first, later = ({n: (hash(x) & ~L._WORDS) | 10 for n, x in enumerate(t)} for t in (block, ["own", *block]))
    monkeypatch.setattr(L, "diagonals", lambda *a: set())
    assert L.aligned_lines(first, later) == set(range(1, 10))


def test_crossing_and_repeated_blocks(spark):
    x, y = ["one two three four five", "six seven eight"], ["a b c d", "e f g h", "i j k l"]
    docs = [(1, "\n".join([*x, "first", *y])), (2, "\n".join([*y, "second", *x])), (3, "\n".join([*x, "third", *x, *x])),
            (4, "\n".join(["a b c d", "fourth", *y, "e f g h", "a b c d", "e f g h"]))]
    assert removed(spark, docs) == expected(docs) == {1: [], 2: [0, 1, 2, 4, 5], 3: [0, 1, 3, 4, 5, 6], 4: [2, 3, 4, 6, 7]}


def test_words_of_a_line_are_parted_by_any_white_space(spark):
    tabs, blanks = "a\tb\tc\td\te\tf\tg\th", "few   words    with     many      blanks"
    docs = [(1, f"{tabs}\nfirst\n{blanks}"), (2, f"second\n{blanks}\nmore\n{tabs}")]
    assert removed(spark, docs) == expected(docs) == {1: [], 2: [3]}
