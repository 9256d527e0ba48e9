import random

import numpy as np
import public_tokenizers
import sentencepiece

import __spark_entry__ as E
from worklake.llm import token_counts as T

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["the", "ing", " ", "  ", "   ", "\n", "<s>", "<0x0A>", "e", "é", "中", "😀", "▁", "\t", "Th", "1", "23", "ation", "\x00", "ﬁ", "xxxxx", "</s>"]


def test_every_prefix_equals_its_own_encoding():
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    vocabulary, draw = T.vocabulary_of(MODEL), random.Random(3)
    for _ in range(400):
        text = "".join(draw.choice(PARTS) for _ in range(draw.randint(0, 15)))
        counts = T.PrefixCounts(vocabulary, text)
        own = [len(sp.encode(text[:k])) for k in range(len(text) + 1)]
        assert [counts.upto(k) for k in range(len(text) + 1)] == own
        assert np.frombuffer(counts.array(), "<i4").tolist() == own[1:]
        for budget in (0, 1, 3, 8):
            assert counts.fit(budget) == max(k for k, n in enumerate(own) if n <= budget)


def test_query_equals_the_library(spark, sf_small):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    rows = E.queries()["op8_token_counts"](spark, sf_small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = len(sp.encode(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 4096)


def test_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(T, "CACHE_SEGMENTS", 50)
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = [None, "", " ", "\n", "word " * 20_000, "x" * 20_000, "é中" * 3000, "a b"]
    df = spark.createDataFrame([(k, t, 5) for k, t in enumerate(texts)] + [(None, "a b", 5)], "doc_id long, text string, n_tokens int")
    rows = {r.doc_id: r for r in T.token_counts(df, MODEL, limit=100, with_prefixes=True).collect()}
    for k, t in enumerate(texts):
        assert rows[k].n_tokens == len(sp.encode(t or "")) and len(rows[k].prefix_tokens) == 4 * len(t or "")
        assert rows[k].over_limit == (rows[k].n_tokens > 100) and rows[k].n_bytes == len((t or "").encode())
        if rows[k].over_limit:
            f = rows[k].fit_chars
            assert len(sp.encode(t[:f])) <= 100 < len(sp.encode(t[:f + 1]))
    assert rows[None].n_tokens == rows[7].n_tokens
    assert T.token_counts(df.limit(0), MODEL).count() == 0
