"""Line deduplication by pairwise alignment of overlapping documents.

A line is a document's line with a word, without white space at its ends. A
block is a sequence of consecutive lines. Of every document those lines are
deleted that lie in a block of at least ``min_words`` words which an earlier
document holds, too, wherever and however often either holds it.

1. Overlapping documents are found through hashed line sequences that are rare enough to
   be evidence: shortest runs of ``min_words`` words onwards and back from each line (a long
   line is a run of its own, short frequent lines count with their neighbours only). Each run meets
   its first holder, the earliest document with it. A line begins or ends two runs, of at
   most ``min_words`` lines each: work stays in proportion to the lines.
2. A document and each of its holders are a pair, to which both bring the hashes of their lines in shared runs.
3. ``aligned_lines`` aligns a pair by patience diff. Matched blocks of ``min_words`` words are taken
   out of the later document and the rest is aligned again, as long as that takes out a tenth of it;
   what patience leaves (blocks in crossing order, or held more often by the later document, ranges
   without a unique line) goes through a plain diff along the diagonals of equal lines.
4. The lines of aligned blocks are deleted from the later document.

The first holder of a run keeps it, unless another run of its own was copied.

Documents are ordered by id, then by a hash of the text. Defined results: null
and empty texts and texts without repeated lines stay as they are (null as
the empty text); a row with a null id is left alone; repeated rows (same id and text) are one
document and keep their lines alike; an empty table gives no rows. The
operator's table has the columns of ``OUT``; ``without_copied_lines`` keeps all columns of its input.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklake.llm.common import fresh, release, small_batches, stage, text_or_empty
from worklake.llm.ngram_join import _GOLD, mix

#: Words of a shared block at least, for it to be deleted.
MIN_WORDS = 8
#: Lines whose runs are made at a time; a longer document is taken alone.
RUN_LINES = 1 << 18

_SPACES = " \t\x0b\x0c\r"
#: The lowest bits of a line's code are its number of words, at most so many; the others are its hash's.
_WORDS = (1 << 16) - 1


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Matched positions (i, j) of equal members, ascending in both.

    Members that occur once on either side of a range anchor it by the longest
    increasing run; equal members next to the ends of a range match, too.
    """
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        alo, ahi, blo, bhi = todo.pop()
        while alo < ahi and blo < bhi and a[alo] == b[blo]:
            out.append((alo, blo))
            alo, blo = alo + 1, blo + 1
        while alo < ahi and blo < bhi and a[ahi - 1] == b[bhi - 1]:
            ahi, bhi = ahi - 1, bhi - 1
            out.append((ahi, bhi))
        if alo >= ahi or blo >= bhi:
            continue
        where: dict = {}
        for i in range(alo, ahi):
            where[a[i]] = -1 if a[i] in where else i
        there: dict = {}
        for j in range(blo, bhi):
            there[b[j]] = -1 if b[j] in there else j
        once = [(i, there[x]) for x, i in where.items() if i >= 0 and there.get(x, -1) >= 0]
        tails: list[int] = []
        last: list[int] = []
        back: list[int] = []
        for k, (_, j) in enumerate(once):
            n = bisect_left(tails, j)
            back.append(last[n - 1] if n else -1)
            tails[n:n + 1] = [j]
            last[n:n + 1] = [k]
        chain, k = [], last[-1] if last else -1
        while k >= 0:
            chain.append(once[k])
            k = back[k]
        at_a, at_b = alo, blo
        for i, j in reversed(chain):
            out.append((i, j))
            todo.append((at_a, i, at_b, j))
            at_a, at_b = i + 1, j + 1
        if chain:
            todo.append((at_a, ahi, at_b, bhi))
    return sorted(out)


def copied(first: list[tuple], later: list[tuple], min_words: int = MIN_WORDS) -> list[int]:
    """Line numbers of the later document in aligned blocks; lines are (number, hash, words)."""
    shared = {h for _, h, _ in first} & {h for _, h, _ in later}
    a = [x for x in first if x[1] in shared]
    b = [x for x in later if x[1] in shared]
    out, block, words, before = [], [], 0, None
    for i, j in patience([h for _, h, _ in a], [h for _, h, _ in b]):
        if before != (a[i][0] - 1, b[j][0] - 1):
            if words >= min_words:
                out += block
            block, words = [], 0
        before = (a[i][0], b[j][0])
        block.append(b[j][0])
        words += b[j][2]
    return out + block if words >= min_words else out


def diagonals(first: dict[int, int], later: dict[int, int], left: list[int], min_words: int = MIN_WORDS) -> set[int]:
    """Plain diff of the lines ``left``: those in blocks of equal lines on one diagonal; lines are number: code."""
    places: dict[int, list[int]] = {}
    for p, code in first.items():
        places.setdefault(code, []).append(p)
    out: set[int] = set()
    for n in left:
        for p in places.get(later[n], ()):
            if n in out:
                break
            lo, hi, words = 0, 1, words_in(later[n])
            while n - lo - 1 in later and later[n - lo - 1] == first.get(p - lo - 1):
                lo += 1
                words += words_in(later[n - lo])
            while n + hi in later and later[n + hi] == first.get(p + hi):
                words += words_in(later[n + hi])
                hi += 1
            if words >= min_words:
                out.update(range(n - lo, n + hi))
    return out


def words_in(code: int) -> int:
    return code & _WORDS


def aligned_lines(first: dict[int, int], later: dict[int, int], min_words: int = MIN_WORDS) -> set[int]:
    """Line numbers of the later document in blocks that both hold; lines are number: code (hash and words)."""
    held = [(p, code, words_in(code)) for p, code in sorted(first.items())]
    rest, gone = sorted(later), set()
    while rest:
        found = copied(held, [(n, later[n], words_in(later[n])) for n in rest], min_words)
        gone.update(found)
        if 10 * len(found) < len(rest):
            break
        rest = [n for n in rest if n not in gone]
    return gone | diagonals(first, later, [n for n in sorted(later) if n not in gone], min_words)


def worded_lines(text: Column) -> Column:
    trimmed = F.transform(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(_SPACES)))
    return F.filter(trimmed, lambda line: line != "")


def line_words(line: Column) -> Column:
    """Words of a line without white space at its ends."""
    return F.size(F.split(line, "[ \\t\\x0B\\f\\r]+"))


def document_key(id_col: str, text_col: str) -> Column:
    return F.struct(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_or_empty(text_col)).alias("v"))


def shortest_runs(hashes: np.ndarray, words: np.ndarray, ends: np.ndarray, min_words: int = MIN_WORDS):
    """(first line, number of lines, hash) of all runs of at least ``min_words`` words that lose
    them without their first or without their last line.

    The lines of several documents stand one after the other; ``ends`` has for each line the end of its document.
    """
    count = hashes.size
    before = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    stop = np.searchsorted(before, before + min_words)  # of the shortest run onwards from each line
    last = np.minimum(np.maximum(stop[:-1], stop[1:] - 1), ends)
    runs = np.maximum(last - stop[:-1] + 1, 0)
    start = np.repeat(np.arange(count), runs)
    size = np.arange(start.size) - np.repeat(np.cumsum(runs) - runs, runs) + stop[start] - start
    out = np.zeros(start.size, np.uint64)
    h = mix(hashes)
    for n in range(1, int(size.max(initial=0)) + 1):
        if n > 1:
            h = mix(h[:-1] * _GOLD + hashes[n - 1:])
        now = size == n
        out[now] = h[start[now]]
    return start, size, out


def hashed_runs(docs: DataFrame, min_words: int, id_col: str, text_col: str) -> DataFrame:
    """(key, number, run, lines): the shortest runs of every document, by number of their first line, with their lines' codes."""
    lines = worded_lines(text_or_empty(text_col))
    units = (small_batches(docs).where(F.col(id_col).isNotNull())
             .select(document_key(id_col, text_col).alias("key"), lines.alias("lines"))
             .select("key.doc_id", "key.v", F.transform("lines", lambda x: F.xxhash64(x, F.length(x))).alias("hashes"),
                     F.transform("lines", line_words).alias("words")))

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            ends = np.cumsum(pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False), dtype=np.int64)
            at = 0
            while at < batch.num_rows:
                done = int(ends[at - 1]) if at else 0
                to = max(at + 1, int(np.searchsorted(ends, done + RUN_LINES, "right")))
                part, sizes = batch.slice(at, to - at), np.diff(ends[at:to], prepend=done)
                hashes, words = (part.column(k).flatten().to_numpy(zero_copy_only=False) for k in (2, 3))
                row = np.repeat(np.arange(to - at), sizes)
                start, size, found = shortest_runs(hashes.view(np.uint64), words, (ends[at:to] - done)[row], min_words)
                number = start - (ends[at:to] - done - sizes)[row[start]]
                codes = (hashes & ~np.int64(_WORDS)) | np.minimum(words, _WORDS)
                offsets = np.concatenate([[0], np.cumsum(size)])
                within = np.arange(offsets[-1]) - np.repeat(offsets[:-1], size) + np.repeat(start, size)
                of = pa.array(row[start])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(of), part.column(1).take(of), pa.array(number.astype(np.int32)), pa.array(found.view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(codes[within]))],
                    ["doc_id", "v", "number", "run", "lines"])
                at = to

    return units.mapInArrow(run, "doc_id long, v long, number int, run long, lines array<long>").select(
        F.struct("doc_id", "v").alias("key"), "number", "run", "lines")


def copied_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, v, numbers, sources): the line numbers to delete per document, and the ids they were copied from."""
    runs = hashed_runs(docs, min_words, id_col, text_col)
    holders = (runs.groupBy("run").agg(F.min(F.struct("key", "number", "lines")).alias("held"), F.max("key").alias("latest"))
               .where("held.key < latest").drop("latest"))
    # Each later document with its holders' lines and its own, of the runs that they share.
    found = (runs.join(holders, "run").where("held.key < key")
             .groupBy("key").agg(F.collect_list(F.struct("held.key", F.col("held.number").alias("place"), "held.lines",
                                                         "number", F.col("lines").alias("own"))).alias("shared"))
             .select("key.doc_id", "key.v", "shared"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            numbers, sources = [], []
            for shared in batch.column(2):
                pairs: dict = {}
                for s in shared.as_py():
                    first, later = pairs.setdefault((s["key"]["doc_id"], s["key"]["v"]), ({}, {}))
                    first.update(enumerate(s["lines"], s["place"]))
                    later.update(enumerate(s["own"], s["number"]))
                gone = {holder: aligned_lines(first, later, min_words) for holder, (first, later) in pairs.items()}
                numbers.append(sorted(set().union(*gone.values())))
                sources.append(sorted({holder[0] for holder, lines in gone.items() if lines}))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(numbers, pa.list_(pa.int32())), pa.array(sources, pa.list_(pa.int64()))],
                ["doc_id", "v", "numbers", "sources"])

    return found.mapInArrow(run, "doc_id long, v long, numbers array<int>, sources array<long>")


def without_lines(text: str, numbers: set[int]) -> str:
    """The text without the lines of these numbers; only lines with a word are numbered."""
    kept, k = [], 0
    for line in text.split("\n"):
        if line.strip(_SPACES):
            if k not in numbers:
                kept.append(line)
            k += 1
        else:
            kept.append(line)
    return "\n".join(kept)


def without_copied_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id",
                         text_col: str = "text") -> tuple[DataFrame, str, str]:
    """All columns and rows of ``docs``, and two more: the numbers of the deleted lines and the ids
    they were copied from. Returns the frame and the two columns' names."""
    gone = stage(copied_lines(docs, min_words, id_col, text_col), "copied")
    release(docs.sparkSession)
    key, v, numbers, sources = (fresh(c, docs) for c in ("copy_id", "copy_v", "copy_numbers", "copy_sources"))
    gone = gone.select(F.col("doc_id").alias(key), F.col("v").alias(v), F.col("numbers").alias(numbers),
                       F.col("sources").alias(sources))
    keyed = docs.join(gone, (F.col(id_col).cast("long") == F.col(key))
                      & (F.xxhash64(text_or_empty(text_col)) == F.col(v)), "left").drop(key, v)
    at, numbers_at = keyed.columns.index(text_col), keyed.columns.index(numbers)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [t.as_py() if not n.is_valid else without_lines(t.as_py() or "", set(n.as_py()))
                     for t, n in zip(batch.column(at), batch.column(numbers_at), strict=True)]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return keyed.mapInArrow(run, keyed.schema), numbers, sources


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text without copied lines, removed_lines and the ids the lines were copied from."""
    out, numbers, sources = without_copied_lines(docs.select("doc_id", "text"), min_words)
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"),
                      F.when(F.col(numbers).isNull(), 0).otherwise(F.size(numbers)).cast("int").alias("removed_lines"),
                      F.coalesce(sources, F.array().cast("array<bigint>")).alias("sources"))


def keep_own_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Columns of ``docs``: texts without copied lines; documents of copied lines alone go."""
    out, numbers, _ = without_copied_lines(docs, min_words, id_col, text_col)
    empty = F.regexp_replace(text_or_empty(text_col), "\\s+", "") == ""
    return out.where(F.col(numbers).isNull() | ~empty).select(*docs.columns)
