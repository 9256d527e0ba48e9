"""Sequence packing by best-fit decreasing.

Each document's token ids (with the end id) are cut into full windows and one
remainder. Full windows are sequences of their own. Remainders are dealt to
shards of bounded size and packed there, longest first, into the open sequence
with the least remaining room that still fits; a segment tree indexed by
remaining room finds it in log(window) steps. Only lengths reach the packing.

A sequence is padded to the window unless its length is a power of two.

Defined results: a null text is the empty text, whose document is its end id;
rows that repeat a document are packed once each; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worklake.llm.common import give_back, small_batches, stage, text_or_empty

WINDOW = 1024
#: Remainders in a shard: enough for full sequences, little memory.
SHARD_ROWS = 20_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, n_pieces long, salt long"
PACKED = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")

#: Characters encoded at a time: their ids, as lists, take about ten times as many bytes.
SLICE_CHARS = 500_000

#: Beyond this range two regex engines might split texts differently.
_RARE = re.compile("[^\x00-ɏ‐-‧€]")


@lru_cache(maxsize=2)
def encoder(json_file: str, ranks_file: str | None = None, pattern: str | None = None):
    """A function from texts to id lists as the vocabulary's JSON file gives them.

    With ``ranks_file`` (the same vocabulary as ranks) ordinary Latin texts go
    through the faster library, which merges alike; texts with other
    characters or a special token's string go through the JSON file.
    """
    import base64

    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(json_file)
    plain = lambda texts: [e.ids for e in exact.encode_batch(texts, add_special_tokens=False)]
    if ranks_file is None:
        return plain
    import tiktoken

    with open(ranks_file, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    special = [t.content for t in exact.get_added_tokens_decoder().values()]

    def encode(texts):
        return [plain([t])[0] if _RARE.search(t) or any(s in t for s in special) else fast.encode_ordinary(t)
                for t in texts]

    return encode


class RoomTree:
    """Open sequences by remaining room; ``tightest(n)`` is the smallest room of at least n."""

    def __init__(self, window: int):
        self.leaves = 1
        while self.leaves < window + 1:
            self.leaves *= 2
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def _add(self, room: int, by: int) -> None:
        at = self.leaves + room
        while at:
            self.count[at] += by
            at //= 2

    def put(self, room: int, sequence: int) -> None:
        if room:
            self.open[room].append(sequence)
            self._add(room, 1)

    def take(self, room: int) -> int:
        self._add(room, -1)
        return self.open[room].pop()

    def tightest(self, least: int) -> int | None:
        at = self.leaves + least
        if self.count[at]:
            return least
        while at > 1:
            if at % 2 == 0 and self.count[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.leaves
            at //= 2
        return None


def best_fit_decreasing(lengths, window: int = WINDOW) -> list[tuple[int, int]]:
    """(sequence, offset) per length; lengths must be in descending order, at most ``window``."""
    tree, placed, sequences = RoomTree(window), [], 0
    for n in lengths:
        room = tree.tightest(n)
        if room is None:
            sequence, room = sequences, window
            sequences += 1
        else:
            sequence = tree.take(room)
        placed.append((sequence, window - room))
        tree.put(room - n, sequence)
    return placed


def slices(lengths, most: int = SLICE_CHARS):
    """(start, end) of consecutive texts of at most ``most`` characters together, or of one longer text."""
    start = chars = 0
    for at, n in enumerate(lengths):
        if at > start and chars + n > most:
            yield start, at
            start, chars = at, 0
        chars += n
    if start < len(lengths):
        yield start, len(lengths)


def cut_documents(docs: DataFrame, encode_with: tuple, window: int = WINDOW, end_id: int = 0,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents' pieces: full windows, then what remains."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        give_back()
        encode = encoder(*encode_with)
        names = [f.split()[0] for f in PIECES.split(", ")]
        for batch in batches:
            texts, out = batch.column(1), []
            for start, end in slices(pc.utf8_length(texts).to_pylist()):
                docs, salts = (batch.column(k).slice(start, end - start).to_pylist() for k in (0, 2))
                for doc, salt, ids in zip(docs, salts, encode(texts.slice(start, end - start).to_pylist()), strict=True):
                    raw = np.asarray(ids + [end_id], dtype="<u4").tobytes()
                    n = len(raw) // 4
                    for at in range(0, n, window):
                        piece = raw[4 * at:4 * (at + window)]
                        out.append((doc, at, len(piece) // 4, zlib.crc32(piece), n, -(-n // window), salt))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], pa.int64()) for k in range(len(names))], names)
        give_back()

    return (small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
            .withColumn("salt", F.xxhash64("doc_id", "text")).mapInArrow(run, PIECES))


def pack(docs: DataFrame, encode_with: tuple, window: int = WINDOW, end_id: int = 0,
         shard_rows: int = SHARD_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece with its sequence and offset.

    The number of shards follows the number of remainders; ids of sequences are
    the shard and a running number in it.
    """
    spark = docs.sparkSession
    pieces = stage(cut_documents(docs, encode_with, window, end_id, id_col, text_col), "pieces")
    rest = pieces.where(F.col("length") < window)
    shards = max(1, -(-rest.count() // shard_rows))
    full = pieces.where(F.col("length") == window).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        # Odd ids for full windows: partition and running number, doubled.
        (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))

    def run(key, table):
        import pyarrow as pa

        order = table.sort_by([("length", "descending"), ("salt", "ascending"), ("doc_id", "ascending"),
                               ("start", "ascending")])
        placed = best_fit_decreasing(order.column("length").to_pylist(), window)
        shard = key[0].as_py()
        kept = order.select(["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        return (kept.append_column("sequence_id", pa.array([(shard << 33) + 2 * s for s, _ in placed], pa.int64()))
                .append_column("offset", pa.array([o for _, o in placed], pa.int64())))

    # A running number deals rows that are all alike evenly, too.
    dealt = rest.withColumn("shard", F.pmod(F.xxhash64("salt", F.monotonically_increasing_id()), F.lit(shards)))
    packed = dealt.groupBy("shard").applyInArrow(run, PACKED)
    return packed.unionByName(full)


def padded_length(used: int, window: int = WINDOW) -> int:
    """A sequence's length with padding."""
    return used if used and used & (used - 1) == 0 else window
