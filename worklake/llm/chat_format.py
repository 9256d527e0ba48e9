"""Chat formatting of conversations with typed content parts, with DataFrame functions only.

A turn's content is an array of parts (``PARTS``). A visitor, one CASE over the
part's type, flattens text, image, audio and document parts in their order: a
text is escaped, any other part becomes the placeholder of its type, and its
reference and the number of tokens that it expands to are recorded. The i-th
placeholder of a conversation belongs to its i-th attachment.

Layout of a turn::

    <role>assistant</role>text<image/><text/>more text</turn>\\n

Escaping appends a backslash to each backslash of a text or role and to the
``<`` of each string in it that reads like a control string. An escaped text
therefore holds no control string, whatever stands beside it, so that control
strings split the output unambiguously; unescaping drops each first backslash.
``turns_of`` reads turns back from the output, ``loss_text`` the text under the
loss mask (``loss_spans``: one span, in characters and in bytes, per text part
of a turn whose role is learnt).

Running sums over a conversation's parts are window sums, so that work is
linear in its length. The output of one conversation is one string: a
conversation is limited to the 2 GB of a Spark value and is built in one task.

Defined results: null texts, roles and part lists are empty; an empty part list
reads back as one empty text; a null part type is text, an unknown one is a
document; unknown or negative sizes expand to one token; turns are ordered by turn (null first), then role and
parts, and repeated rows are repeated turns; rows with a null id form a conversation of
their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PART = "struct<type: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"
PARTS = f"array<{PART}>"

END = "</turn>\n"
CONTROL = r"\\|<(?=/?role>|/turn>|(?:text|image|audio|document)/>)"
MARKERS = "<(text|image|audio|document)/>"


@dataclass(frozen=True)
class Expansion:
    """Tokens that attachments expand to: image patches, audio frames, document pages."""

    patch: int = 28
    tokens_per_second: float = 25.0
    tokens_per_page: int = 512


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$0\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_part(text: Column) -> Column:
    """A part list that holds one text."""
    empty = [F.lit(None).cast(t).alias(n) for n, t in (
        ("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]
    return F.array(F.struct(F.lit("text").alias("type"), text.cast("string").alias("text"), *empty))


def _kind(part: Column) -> Column:
    kind = F.coalesce(part["type"], F.lit("text"))
    return F.when(kind.isin("text", "image", "audio"), kind).otherwise(F.lit("document"))


def visit(part: Column, index: Column, count: Column) -> Column:
    """The part's piece of the output; a text that begins its turn needs no marker unless it is empty."""
    text = escape(F.coalesce(part["text"], F.lit("")))
    bare = (index == 0) & ((text != "") | (count == 1))
    return (F.when(_kind(part) != "text", F.concat(F.lit("<"), _kind(part), F.lit("/>")))
            .when(bare, text).otherwise(F.concat(F.lit("<text/>"), text)))


def expanded_tokens(part: Column, expansion: Expansion = Expansion()) -> Column:
    """Tokens that an attachment stands for, at least one; zero for texts."""
    def patches(side):
        return F.ceil(side / F.lit(float(expansion.patch)))

    size = (F.when(_kind(part) == "image", patches(part["width"]) * patches(part["height"]))
            .when(_kind(part) == "audio", F.ceil(part["seconds"] * F.lit(expansion.tokens_per_second)))
            .otherwise(part["pages"].cast("long") * expansion.tokens_per_page))
    whole = F.when((part["width"] >= 0) & (part["height"] >= 0) | (_kind(part) != "image"), size)
    return (F.when(_kind(part) == "text", F.lit(0).cast("long"))
            .otherwise(F.greatest(F.coalesce(whole.cast("long"), F.lit(1).cast("long")), F.lit(1).cast("long"))))


def format_conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         parts_col: str = "parts", learnt: tuple[str, ...] = ("assistant",),
                         expansion: Expansion = Expansion()) -> DataFrame:
    """One row per conversation: its string, loss spans, attachments and their expanded tokens."""
    given = turns.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                         F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                         F.coalesce(F.col(parts_col), F.array()).cast(PARTS).alias("parts"))
    given = given.withColumn("parts", F.when(F.size("parts") == 0, text_part(F.lit(""))).otherwise(F.col("parts")))
    in_order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "parts")
    numbered = given.select("conv_id", "role", "parts", F.row_number().over(in_order).alias("pos"))

    part, index, count = F.col("part"), F.col("index"), F.col("count")
    opening = F.when(index == 0, F.concat(F.lit("<role>"), escape(F.col("role")), F.lit("</role>"))).otherwise(F.lit(""))
    pieces = (numbered.select("conv_id", "pos", "role", F.size("parts").alias("count"), F.posexplode("parts").alias("index", "part"))
              .select("conv_id", "pos", "index", "role", _kind(part).alias("kind"),
                      F.struct(F.col("part.*"), expanded_tokens(part, expansion).alias("n_tokens")).alias("part"),
                      opening.alias("opening"), visit(part, index, count).alias("piece"),
                      F.when(index + 1 == count, F.lit(END)).otherwise(F.lit("")).alias("closing")))
    whole = F.concat("opening", "piece", "closing")
    so_far = W.partitionBy("conv_id").orderBy("pos", "index").rowsBetween(W.unboundedPreceding, -1)
    placed = pieces.select(
        "conv_id", "pos", "index", "role", "kind", "part", "opening", "piece", whole.alias("whole"),
        F.coalesce(F.sum(F.length(whole).cast("long")).over(so_far), F.lit(0)).alias("at"),
        F.coalesce(F.sum(F.octet_length(whole).cast("long")).over(so_far), F.lit(0)).alias("byte_at"))

    marker = F.when(F.col("piece").startswith("<text/>"), F.lit(len("<text/>"))).otherwise(F.lit(0))
    span = F.struct((F.col("at") + F.length("opening") + marker).alias("start"),
                    (F.length("piece") - marker).cast("long").alias("length"),
                    (F.col("byte_at") + F.octet_length("opening") + marker).alias("byte_start"),
                    (F.octet_length("piece") - marker).cast("long").alias("byte_length"))
    seen = F.array_sort(F.collect_list(F.struct(
        "pos", "index", "whole",
        F.when((F.col("kind") == "text") & F.col("role").isin(*learnt), span).alias("span"),
        F.when(F.col("kind") != "text", F.struct(
            F.col("pos").alias("turn"), F.col("index").alias("part"), F.col("part.type"), F.col("part.text"),
            F.col("part.ref"), F.col("part.n_tokens"))).alias("attachment"))),
        lambda a, b: F.when(a["pos"] != b["pos"], a["pos"] - b["pos"]).otherwise(a["index"] - b["index"]))
    grouped = placed.groupBy("conv_id").agg(seen.alias("seen"), F.max("pos").cast("long").alias("n_turns"),
                                            F.sum("part.n_tokens").alias("attachment_tokens"))
    return grouped.select(
        "conv_id", "n_turns", F.array_join("seen.whole", "").alias("formatted"),
        F.filter("seen.span", lambda s: s.isNotNull()).alias("loss_spans"),
        F.filter("seen.attachment", lambda a: a.isNotNull()).alias("attachments"), "attachment_tokens")


def turns_of(formatted: Column) -> Column:
    """array<struct<role, parts: array<struct<type, text>>>> read back from an output string."""
    def part_of(kind, text):
        return F.struct(kind.alias("type"), F.when(kind == "text", unescape(text)).alias("text"))

    def turn_of(chunk):
        halves = F.split(chunk, "</role>", 2)
        body = F.get(halves, F.lit(1))
        texts, kinds = F.split(body, MARKERS, -1), F.regexp_extract_all(body, F.lit(MARKERS), F.lit(1))
        head = F.get(texts, F.lit(0))
        first = F.when((head != "") | (F.size(kinds) == 0), F.array(part_of(F.lit("text"), head))).otherwise(F.array())
        rest = F.zip_with(kinds, F.slice(texts, F.lit(2), F.size(kinds)), part_of)
        return F.struct(unescape(F.substr(F.get(halves, F.lit(0)), F.lit(len("<role>") + 1))).alias("role"),
                        F.concat(first, rest).alias("parts"))

    chunks = F.split(formatted, END, -1)
    return F.transform(F.slice(chunks, F.lit(1), F.size(chunks) - 1), turn_of)


def loss_texts(formatted: Column, spans: Column) -> Column:
    """The unescaped texts that the spans cut from an output string, in order."""
    def cut(raw):
        return F.transform(spans, lambda s: unescape(
            F.substr(raw, (s["byte_start"] + 1).cast("int"), s["byte_length"].cast("int")).cast("string")))

    # Bytes are cut without counting characters from the start; bound once per row.
    return F.get(F.transform(F.array(formatted.cast("binary")), cut), F.lit(0))


def digest_conversations(formatted: DataFrame) -> DataFrame:
    """Counts and digests of each conversation, all read back from its output string and spans."""
    def line(turn):
        texts = F.filter(turn["parts"], lambda p: p["type"] == "text")
        return F.concat(turn["role"], F.lit("\n"), F.array_join(F.transform(texts, lambda p: p["text"]), ""), F.lit("\n"))

    read = formatted.select("conv_id", turns_of(F.col("formatted")).alias("turns"),
                            F.array_join(loss_texts(F.col("formatted"), F.col("loss_spans")), "").alias("loss"),
                            F.length("formatted").cast("long").alias("formatted_chars"), "attachment_tokens")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", line), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
