import random
import zlib
from array import array
from collections import defaultdict

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as E
from worklake.llm import packing as P
from worklake.llm.queries import byte_bpe


def check(rows, docs, window=1024):
    """Every id in one piece, sequences gapless and not over the window; returns padding and tokens."""
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == {d for d, _ in docs}
    for d, text in docs:
        ids = exact.encode(text or "", add_special_tokens=False).ids + [0]
        at = 0
        for r in sorted(by_doc[d], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.length >= 1
            assert r.ids_crc32 == zlib.crc32(array("I", ids[at:at + r.length]).tobytes())
            at += r.length
        assert at == len(ids)
    padding = tokens = 0
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
        tokens += at
        padding += P.padded_length(at, window) - at
    return padding, tokens


def test_query_packs_all_ids(spark, sf_small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    padding, tokens = check(E.queries()["op5_packing"](spark, sf_small).collect(), docs)
    assert padding < 0.02 * tokens


def test_edge_rows_and_shards(spark):
    docs = [(1, None), (2, ""), (3, "<|endoftext|> and ﬁ 中文 ☃ done"), (4, "word " * 5000), (5, "a\r\n\tb c  d")]
    docs += [(k, "many short texts " * (k % 30)) for k in range(10, 200)]
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, length string")
    check(P.pack(df, byte_bpe()).collect(), docs)
    check(P.pack(df, byte_bpe(), shard_rows=40).collect(), docs)
    assert P.pack(df.limit(0), byte_bpe()).count() == 0
    twice = P.pack(df.limit(2).unionAll(df.limit(2)), byte_bpe()).collect()
    assert len(twice) == 4


def naive(lengths, window):
    """Best fit by looking at every open sequence."""
    used: list[int] = []
    for n in lengths:
        fits = [u for u in used if u + n <= window]
        if fits:
            used[used.index(max(fits))] += n
        else:
            used.append(n)
    return sorted(used)


def test_segment_tree_is_best_fit():
    draw = random.Random(4)
    for window in (10, 64, 1024):
        for _ in range(40):
            lengths = sorted((draw.randint(1, window) for _ in range(120)), reverse=True)
            placed = P.best_fit_decreasing(lengths, window)
            used = defaultdict(int)
            for n, (s, offset) in zip(lengths, placed, strict=True):
                assert offset == used[s]
                used[s] += n
            assert sorted(used.values()) == naive(lengths, window)


def test_fast_encoder_equals_the_vocabulary_file():
    draw = random.Random(8)
    exact, fast = P.encoder(byte_bpe()[0]), P.encoder(*byte_bpe())
    pool = [chr(c) for c in range(0x250)] + list(" \n\t'  .,0aZ") * 12 + ["’", "—", "€", "中", "'ll", "'re", "  ", "　", "<|endoftext|>"]
    texts = ["".join(draw.choice(pool) for _ in range(draw.randint(0, 60))) for _ in range(3000)]
    assert exact(texts) == fast(texts)


def test_texts_are_encoded_in_slices_of_bounded_size():
    draw = random.Random(5)
    for lengths in ([], [0], [70], [0, 70, 0], [draw.choice((0, 3, 9, 50)) for _ in range(300)]):
        cuts = list(P.slices(lengths, 20))
        assert [k for a, b in cuts for k in range(a, b)] == list(range(len(lengths)))
        assert all(b > a and (sum(lengths[a:b]) <= 20 or sum(map(bool, lengths[a:b])) == 1) for a, b in cuts)
    assert len(list(P.slices([4_000_000] * 512))) == 512  # were one slice
