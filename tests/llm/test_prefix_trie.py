import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from worklake.llm import prefix_trie as T

OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
TURNS = "conv_id long, turn long, role string, text string, depth string"


def taken(c):
    return zlib.crc32(str(c).encode()) % 9


def base(c):
    return c - (c % 5 if c >= 0 else -(-c % 5))


def brute(rows):
    """The trie with every rebuilt conversation held as a tuple of its turns."""
    convs = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            convs[r[0]].append(((r[1] is not None, r[1] or 0), (r[2] or "", r[3] or "")))
    convs = {c: [t for _, t in sorted(v, key=lambda x: x[0])] for c, v in convs.items()}
    rebuilt = {c: tuple(convs.get(base(c), [])[:taken(c)] + v[taken(c):]) for c, v in convs.items()}
    members, children, ends = defaultdict(list), defaultdict(set), defaultdict(list)
    for c, s in rebuilt.items():
        ends[s].append(c)
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
            if d:
                children[s[:d - 1]].add(s[:d])
    leaves, saved = defaultdict(int), defaultdict(int)
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in children
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children[k]), leaves[k], saved[k], sha(ends[k]))
                  for k, m in members.items())


def trie(df):
    conv = F.col("conv_id")
    return T.conversation_trie(df, base=conv - conv % 5, taken=F.crc32(conv.cast("string").cast("binary")) % 9)


def got(df):
    return sorted(tuple(r) for r in df.select(*OUT).collect())


@pytest.fixture
def uncoalesced(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def random_rows(draw, convs):
    rows = []
    for c in convs:
        said = draw.sample([None, *range(40)], draw.randint(1, 14))
        rows += [(c, t, draw.choice(["user", "assistant"]), draw.choice(["a", "bé", "", None]), "clash") for t in said]
    return rows


def test_random_conversations(spark, uncoalesced):
    draw = random.Random(13)
    rows = random_rows(draw, [c for c in range(-12, 90) if draw.random() < 0.8])
    rows += [(900 + k, t, "user", f"same {t}", "x") for k in range(60) for t in range(12)]  # one group of copies
    rows += [(2000, 5, "user", "again", "x")] * 30 + [(None, 0, "user", "no id", "x")]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, TURNS)
    assert got(trie(df)) == brute(rows)


def test_one_conversation_holds_most_rows(spark, uncoalesced):
    draw = random.Random(14)
    rows = random_rows(draw, range(20)) + [(40, t, "user", f"turn {t % 7}", "x") for t in range(3000)]
    rows += [(41, t, "user", f"turn {t % 7}", "x") for t in range(1500)] + [(42, 1, "user", "alike", "x")] * 1500
    df = spark.createDataFrame(rows, TURNS).repartition(8)
    conv = F.col("conv_id")
    kept, _ = T.rebuild(df, base=conv, taken=F.lit(0))
    assert T.prefix_keys(kept).where("conv_id = 40").select("part").distinct().count() > 1
    out = T.conversation_trie(df, base=conv, taken=F.lit(0))
    rows_of = {(r.conv_id, r.depth): r for r in out.collect()}
    assert rows_of[40, 1500].n_convs == 2 and rows_of[40, 1501].n_convs == 1
    assert rows_of[40, 1500].ends_sha256 == hashlib.sha256(b"41").hexdigest()
    size = lambda a, b: sum(len(f"turn {t % 7}") for t in range(a, b))
    assert rows_of[40, 700].saved_tokens == size(699, 1500) and rows_of[42, 1500].n_children == 0
    assert rows_of[40, 3000].parent_conv_id == 40 and (40, 3001) not in rows_of


def test_many_children_and_empty_tables(spark, monkeypatch):
    rows = [(c, t, "user", "start" if t == 0 else f"{c} {t}", "x") for c in range(0, 1000, 5) for t in range(3)]
    df = spark.createDataFrame(rows, TURNS)
    want = brute(rows)
    assert got(trie(df)) == want
    monkeypatch.setattr(T, "HOT_PARENTS", 10)  # the shared first turn and the root are broadcast to their children
    assert got(trie(df)) == want
    assert got(trie(df.limit(0))) == []
    lone = [(6, 0, "user", "x", "x"), (6, 1, "user", None, "x")]  # nothing is left of it
    assert taken(6) >= 2 and got(trie(spark.createDataFrame(lone, TURNS))) == brute(lone)


def test_query(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    df = E.queries()["op13_prefix_trie"](spark, sf_small)
    assert df.columns == OUT and got(df) == brute(rows)
    assert all(t == ("string" if c == "ends_sha256" else "bigint") for c, t in df.dtypes)


def test_texts_are_not_sent(spark, sf_small):
    rebuilt, _ = T.rebuild(spark.read.parquet(f"{sf_small}/conversations.parquet"), F.col("conv_id"), F.lit(0))
    assert not re.search("text", " ".join(rebuilt.columns))
