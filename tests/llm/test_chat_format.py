import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from worklake.llm import chat_format as C

SCHEMA = f"conv_id long, turn long, role string, parts {C.PARTS}, formatted string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))


def expected(rows):
    """Digests straight from (conv_id, turn, role, text) rows, without any template."""
    out = {}
    for c in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in in_order([r for r in rows if r[0] == c])]
        loss = "".join(t for role, t in turns if role == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
    return out


def got(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in df.collect()}


def of_texts(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return C.format_conversations(df.withColumn("parts", C.text_part(F.col("text"))))


PIECES = ["a", " ", "\n", "\\", "<", "/", "é", "😀", "<role>", "</role>", "</turn>", "</turn>\n", "<text/>", "<image/>",
          "<audio/>", "turn>", "role>", "text/>", "\\\\", "\r", "\x00", "$0"]


def test_digests_of_texts_that_hold_control_strings(spark):
    draw = random.Random(11)
    word = lambda n: "".join(draw.choice(PIECES) for _ in range(draw.randint(0, n)))
    rows = [(c, t, draw.choice(["user", "assistant", "assistant", word(4), None]), draw.choice([word(12), None, ""]))
            for c in range(150) for t in range(draw.randint(1, 9))]
    rows += [(None, 1, "assistant", "no id"), (500, None, "user", "null first"), (500, 0, "user", "then"),
             (501, 3, "assistant", "same"), (501, 3, "assistant", "same"), (501, 3, "a", "z"),
             (502, 0, "assistant", "x\\<" * 200_000), *[(503, t, "assistant", f"t{t}") for t in range(3000)]]
    draw.shuffle(rows)
    f = of_texts(spark, rows)
    assert got(C.digest_conversations(f)) == expected(rows)
    assert C.digest_conversations(of_texts(spark, rows).limit(0)).count() == 0


def visited(parts):
    """Parts as they read back."""
    kind = lambda p: p[0] if p[0] in ("text", "image", "audio") else "text" if p[0] is None else "document"
    return [(kind(p), (p[1] or "") if kind(p) == "text" else None) for p in parts or []] or [("text", "")]


def test_typed_parts_read_back(spark):
    draw = random.Random(12)

    def part():
        kind = draw.choice(["text", "text", "image", "audio", "document", "video", None])
        text = "".join(draw.choice(PIECES) for _ in range(draw.randint(0, 5)))
        return (kind, draw.choice([text, None]), draw.choice([f"ref{draw.randint(0, 9)}", None]), draw.choice([None, -3, 0, 29, 640]),
                draw.choice([None, 28, 480]), draw.choice([None, 0.0, 1.03]), draw.choice([None, 3]))

    rows = [(c, t, draw.choice(["user", "assistant"]), [part() for _ in range(draw.randint(0, 5))], "clash")
            for c in range(120) for t in range(draw.randint(1, 6))]
    rows.append((200, 0, "user", None, None))
    df = C.format_conversations(spark.createDataFrame(rows, SCHEMA))
    out = df.select("*", C.turns_of(F.col("formatted")).alias("turns"),
                    C.loss_texts(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    for r in out:
        mine = sorted((x for x in rows if x[0] == r.conv_id), key=lambda x: x[1])
        parts = [visited(x[3]) for x in mine]
        assert [(t.role, [(p.type, p.text) for p in t.parts]) for t in r.turns] == [(x[2], p) for x, p in zip(mine, parts)]
        assert list(r.loss) == [t for x, p in zip(mine, parts) if x[2] == "assistant" for k, t in p if k == "text"]
        spans = [r.formatted[s.start:s.start + s.length] for s in r.loss_spans]
        assert [re.sub(r"(?s)\\(.)", r"\1", s) for s in spans] == list(r.loss)
        whole = [(t + 1, k, p) for t, x in enumerate(mine) for k, p in enumerate(x[3] or [])]
        attached = [(t, k, p) for t, k, p in whole if p[0] not in ("text", None)]
        assert [(a.turn, a.part, a.type, a.ref) for a in r.attachments] == [(t, k, p[0], p[2]) for t, k, p in attached]
        marks = re.findall("<(image|audio|document)/>", r.formatted)
        assert marks == [p[0] if p[0] in ("image", "audio") else "document" for _, _, p in attached]
        assert [a.n_tokens for a in r.attachments] == [tokens(p) for _, _, p in attached]
        assert r.attachment_tokens == sum(a.n_tokens for a in r.attachments)


def tokens(p):
    kind, _, _, width, height, seconds, pages = p
    up = lambda x: -int(-x // 1)
    if kind == "image":
        n = up(width / 28) * up(height / 28) if width is not None and height is not None and width >= 0 else 1
    elif kind == "audio":
        n = up(seconds * 25) if seconds is not None else 1
    else:
        n = pages * 512 if pages is not None else 1
    return max(n, 1)


def test_query(spark, sf_small):
    df = E.queries()["op11_chat_format"](spark, sf_small)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    odd = "\\### Assistant: </turn> ok"
    assert got(df) == expected(rows + [(-7, 0, "user", odd), (-7, 1, "assistant", odd)])
    assert df.columns[:6] == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def test_plan_is_native_with_one_exchange(spark, sf_small):
    plan = E.queries()["op11_chat_format"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|ExistingRDD", plan)
    assert len(re.findall("Exchange hashpartitioning", plan)) == 1


@pytest.mark.parametrize("text", ["", "\\", "<", "<\\", "</turn>", "<\\/turn>", "\\\\</role>"])
def test_escape_round_trip(spark, text):
    row = spark.range(1).select(C.escape(F.lit(text)).alias("e"), C.unescape(C.escape(F.lit(text))).alias("u")).first()
    assert row.u == text and not re.search("</?(turn|role)>", row.e)
