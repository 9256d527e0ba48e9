import random
import re

import __spark_entry__ as E
from worklake.llm import license_scan as L

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, labels = [], set()
    for phrase, label in L.BASE_PHRASES.items():
        p = phrase.split()
        found = [k for k in range(len(words) - len(p) + 1) if words[k:k + len(p)] == p]
        places += found
        labels |= {label} if found else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def base(r):
    return r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels


def test_base_equals_brute_force(spark):
    draw = random.Random(1)
    parts = ["under ", "the ", "MIT ", "mit-", "License ", "license, ", "apache ", "Version ", "2", "2.0 ", "cc", " BY-", "nc ", "é", "İ", "\x00", "_", "\n", "Under the MIT license ", "CC BY-nc "]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 40))) for _ in range(2000)]
    texts += ["under the mit license " * 3, "cc by nc cc by nc", "Under The MIT License", "apache license version 2.0", "apache license version 20", None, "",
              "cc by nc " * 40_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in L.scan_licenses(df).collect()}
    for k, t in enumerate(texts):
        assert base(rows[k]) == brute(t), t
        assert set(filter(None, rows[k].base_labels.split(","))) <= set(filter(None, rows[k].labels.split(",")))
        assert 0 <= rows[k].score <= 1
    assert sum(rows[k].n_base > 0 for k in rows) > 50


def test_expressions():
    cases = {
        "MIT": ("mit", True), "MIT OR GPL-2.0-only": ("mit or gpl-2.0-only", True), "MIT AND GPL-2.0-only": ("mit and gpl-2.0-only", False),
        "(MIT OR GPL-3.0) AND Apache-2.0": ("(mit or gpl-3.0) and apache-2.0", True),
        "GPL-2.0 WITH Classpath-exception-2.0 OR MIT": ("gpl-2.0 with classpath-exception-2.0 or mit", True),
        "MIT AND (GPL-2.0 OR LGPL-2.1)": ("mit and (gpl-2.0 or lgpl-2.1)", False), "MIT. And so on": ("mit", True),
    }
    cases.pop("MIT. And so on")
    for text, expected in cases.items():
        assert L.evaluate(L.to_postfix(text))[:2] == expected
    for text in ("", "AND MIT", "(MIT", "()", "(MIT GPL)", "foobar is nice", "(it works)", "with MIT"):
        assert L.to_postfix(text) is None
    for text in ("MIT OR", "MIT OR )", "MIT and it works", "MIT AND (GPL-2.0", "MIT WITH pleasure", "MIT, or so"):
        assert L.to_postfix(text) == ["mit"], text
    assert L.to_postfix("LicenseRef-Own OR BSD-3-Clause or else") == ["licenseref-own", "bsd-3-clause", "or"]
    for word in ("it", "mitt", "gpl-x", "apache-2.0.", "license", "w3"):
        assert not L.is_licence(word), word
    assert L.to_postfix("MIT ) rest") == ["mit"] and L.to_postfix("MIT rest of line") == ["mit"]


def test_tags_and_edge_rows(spark):
    text = "// SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND BSD-3-Clause\ncode"
    df = spark.createDataFrame([(1, text, "x"), (1, text, "x"), (None, "CC0 1.0", None), (2, None, "y")], "doc_id long, text string, labels string")
    rows = {r.doc_id: r for r in L.scan_licenses(df).collect()}
    assert len(L.scan_licenses(df).collect()) == 4
    assert rows[1].labels == "bsd-3-clause,gpl-2.0-only,mit" and rows[1].score == 1 and rows[1].permissive and rows[1].base_labels == ""
    assert rows[None].labels == "cc0" and rows[2].labels == "" and rows[2].score == 0
    assert L.scan_licenses(df.limit(0)).count() == 0


def descent(tokens):
    """Labels of the longest well-formed start, by recursive descent instead of shunting-yard."""
    def expression(at, level=1):
        at, names = operand(at) if level == 4 else expression(at, level + 1)
        while at is not None and at < len(tokens) and level < 4 and L._PRECEDENCE.get(tokens[at]) == level:
            if level == 3:
                to, more = (at + 2, []) if at + 1 < len(tokens) and L._EXCEPTION.fullmatch(tokens[at + 1]) else (None, [])
            else:
                to, more = expression(at + 1, level + 1)
            if to is None:
                break
            at, names = to, names + more
        return at, names

    def operand(at):
        if at < len(tokens) and tokens[at] == "(":
            to, names = expression(at + 1)
            return (to + 1, names) if to is not None and to < len(tokens) and tokens[to] == ")" else (None, [])
        return (at + 1, [tokens[at]]) if at < len(tokens) and L.is_licence(tokens[at]) else (None, [])

    return expression(0)[1]


def test_all_columns_equal_a_second_implementation(spark):
    draw = random.Random(3)
    parts = ["MIT", "mit", "Apache-2.0", "GPL-2.0-only", "(", ")", "OR", "and", "WITH", "Classpath-exception-2.0", "it", "works", "isc"]
    texts = []
    for _ in range(600):
        tag = " ".join(draw.choice(parts) for _ in range(draw.randint(0, 7)))
        texts.append(draw.choice(["", "public domain. ", "Under the MIT License, "]) + draw.choice(["SPDX-License-Identifier: ", "// spdx-license-identifier:\t"]) + tag + "\nend")
    rows = {r.doc_id: r for r in L.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for k, t in enumerate(texts):
        found = descent([x.lower() for x in L._TOKEN.findall(t.lower().split("identifier:")[1].split("\n")[0])])
        labels = {L.SAME.get(n, n) for n in found} | ({"mit"} if "MIT License" in t else set()) | ({"public-domain"} if "public domain" in t else set())
        places = ("MIT License" in t) + ("public domain" in t)
        assert rows[k].labels == ",".join(sorted(labels)), t
        assert rows[k].score == (1.0 if found else 1 - 0.5 ** places) and (rows[k].expression is None) == (not found)


def test_query(spark, sf_small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    rows = E.queries()["op7_license_scan"](spark, sf_small).collect()
    assert {r.doc_id: base(r) for r in rows} == {k: brute(t) for k, t in texts.items()}
