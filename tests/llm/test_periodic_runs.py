import hashlib
import random
import re
import zlib

import numpy as np

import __spark_entry__ as E
from worklake.llm import periodic_runs as P

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(words, least=12):
    """Every stretch that keeps a period, for all periods, smallest first."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > s and i + q - s >= max(least, 2 * q):
                found.setdefault((s, i + q), q)
            i += i == s
    return sorted((s, e - s, q) for (s, e), q in found.items())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def digests(words, least=12):
    runs = brute(words, least)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(w for k, w in enumerate(words) if k not in gone)))


def planted(doc_id, text):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def random_words(draw):
    n, letters = draw.choice([0, 1, 2, 5, 13, 30, 90]), "abcdefgh"[:draw.choice([1, 2, 3, 5, 8])]
    words = [draw.choice(letters) for _ in range(n)]
    if n and draw.random() < 0.5:
        a, p = draw.randrange(n), draw.randint(1, n)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_runs_equal_brute_force():
    draw = random.Random(12)
    for _ in range(150):
        docs = [random_words(draw) for _ in range(draw.randint(0, 9))]
        for least in (1, 12):
            assert P.find_runs(docs, least) == [brute(w, least) for w in docs]


def test_structures_equal_brute_force():
    draw = random.Random(13)
    for _ in range(60):
        words = random_words(draw)
        n = len(words)
        symbols = np.array([ord(w) for w in words] + [0])
        sa, ranks, parted = P.suffix_array(symbols)
        suffixes = [tuple(symbols[i:]) for i in range(n + 1)]
        assert sa.tolist() == sorted(range(n + 1), key=lambda i: suffixes[i])
        assert ranks[-1][sa].tolist() == list(range(n + 1))
        lcp = P.lcp_array(sa, ranks, parted)
        share = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert lcp[1:n + 1].tolist() == [share(suffixes[sa[k - 1]], suffixes[sa[k]]) for k in range(1, n + 1)]
        for k, left, right in zip(*P.intervals(lcp)):
            assert lcp[left] < lcp[k] > lcp[right] and (lcp[left + 1:right] >= lcp[k]).all()
        squares = set(zip(*map(np.ndarray.tolist, P.branching_squares(sa, ranks[-1], lcp))))
        assert squares == {(i, d) for d in range(1, n) for i in range(n + 1 - 2 * d)
                           if suffixes[i][:d] == suffixes[i + d][:d] and suffixes[i][d] != (suffixes[i + d] + (-1,))[d]}


def test_long_texts_and_deep_lcp():
    assert P.find_runs([["a"] * 200_000]) == [[(0, 200_000, 1)]]
    assert P.find_runs([[str(k % 1000) for k in range(150_000)]]) == [[(0, 150_000, 1000)]]
    assert P.find_runs([[str(k) for k in range(100_000)]] * 2) == [[], []]


def test_rows_of_every_kind(spark):
    texts = [None, "", " \t\r\n\x0b\x0c", "one", "a b " * 6, "a b " * 5 + "a", "é 😀\x1c x " * 9, "w " * 3_000, " z z  z " * 12]
    rows = [(k, t, "clash") for k, t in enumerate(texts)] + [(None, "q r " * 8, "x"), (4, "a b " * 6, "x"), (4, "other", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = [tuple(r) for r in P.run_digests(P.periodic_runs(df)).collect()]
    some = [(k, *digests(WORD.findall(t or ""))) for k, t, _ in rows]
    assert sorted(got, key=repr) == sorted(some, key=repr)
    assert P.run_digests(P.periodic_runs(df.limit(0))).count() == 0


def test_query(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()
    df = E.queries()["op12_periodic_runs"](spark, sf_small)
    assert {r.doc_id: tuple(r)[1:] for r in df.collect()} == {d: digests(planted(d, t)) for d, t in docs}
    assert dict(df.dtypes) == {"doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint",
                               "exponent_milli": "bigint", "runs_sha256": "string", "collapsed_sha256": "string"}
