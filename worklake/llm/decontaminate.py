"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are lower-cased and reduced to words joined by single
blanks. An item of m characters may differ by k = floor(error_rate * m) edits;
it is cut into k + 1 pieces, one of which must occur unchanged wherever the
item occurs with at most k edits. One Aho-Corasick automaton finds all pieces
in one pass over a text; hits on nearby diagonals are joined, and Myers'
bit-parallel algorithm gives the smallest edit distance of the item there.

The test items are bounded blocks of at most ``BLOCK_CHARS`` characters, sent
to the tasks; a larger benchmark is run block by block over all documents.

Items below ``min_words`` words must occur unchanged between word boundaries: an edit
or a part of a word would make them other items.

Defined results: null and empty texts, and items without a word, match nothing;
repeated items count once per item id; repeated rows give repeated rows; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worklake.llm.common import small_batches, text_or_empty

ERROR_RATE, MIN_WORDS = 0.08, 5
BLOCK_CHARS = 4_000_000

OUT = "doc_id long, item_id long, distance int, end long"

_KEEP = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def normal_form(text: str) -> str:
    """Lower-cased words (ASCII letters, digits, all non-ASCII characters) between single blanks."""
    raw = text.lower().encode("utf-8", "surrogatepass").translate(_KEEP)
    return b" ".join(raw.split()).decode("utf-8", "surrogatepass")


def cut(pattern: str, budget: int) -> list[tuple[str, int]]:
    """``budget + 1`` pieces of nearly equal length with their offsets."""
    n = budget + 1
    edges = [len(pattern) * i // n for i in range(n + 1)]
    return [(pattern[a:b], a) for a, b in zip(edges, edges[1:], strict=False)]


def myers(pattern: str, text: str, masks: dict[str, int] | None = None) -> tuple[int, int]:
    """(smallest edit distance of ``pattern`` to a part of ``text``, end of the first such part)."""
    m = len(pattern)
    if masks is None:
        masks = char_masks(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, at = m, 0
    for j, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph = minus | (full & ~(xh | plus))
        mh = plus & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
            if score < best:
                best, at = score, j
        ph = (ph << 1) & full  # a match may start anywhere: row 0 stays 0
        mh = (mh << 1) & full
        plus = mh | (full & ~(xv | ph))
        minus = ph & xv
    return best, at


def char_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


class Matcher:
    """Finds the items of one block in normalised texts."""

    def __init__(self, items, error_rate: float = ERROR_RATE, min_words: int = MIN_WORDS):
        import ahocorasick

        self.items: list[tuple[int, str, int]] = []  # (item id, pattern, budget)
        places: dict[str, list[tuple[int, int]]] = {}
        short: dict[str, list[int]] = {}
        for item_id, text in sorted({(i, normal_form(t or "")) for i, t in items if i is not None}):
            if text.count(" ") + 1 >= min_words:
                budget = int(error_rate * len(text))
                for piece, offset in cut(text, budget):
                    places.setdefault(piece, []).append((len(self.items), offset))
                self.items.append((item_id, text, budget))
            elif text:
                short.setdefault(f" {text} ", []).append(item_id)
        self.short = ahocorasick.Automaton() if short else None
        for text, ids in short.items():
            self.short.add_word(text, ids)
        if short:
            self.short.make_automaton()
        self.masks: dict[int, dict[str, int]] = {}
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int]]:
        """(item id, distance, end in the normal form) of each item that the text contains."""
        line = normal_form(text)
        diagonals: dict[int, set[int]] = {}
        for end, (length, where) in self.automaton.iter(line) if self.items else ():
            for item, offset in where:
                diagonals.setdefault(item, set()).add(end + 1 - length - offset)
        found: dict[int, tuple[int, int]] = {}
        for item, starts in diagonals.items():
            item_id, pattern, budget = self.items[item]
            m = len(pattern)
            exact = line.find(pattern)
            best = (0, exact + m) if exact >= 0 else None
            if best is None:
                if item not in self.masks:
                    self.masks[item] = char_masks(pattern)
                for low, high in joined(sorted(starts), budget):
                    start = max(0, low - budget)
                    part = line[start:high + m + budget]
                    distance, at = myers(pattern, part, self.masks[item])
                    if distance <= budget and (best is None or distance < best[0]):
                        best = (distance, start + at)
            if best and (item_id not in found or best < found[item_id]):
                found[item_id] = best
        for end, ids in self.short.iter(f" {line} ") if self.short else ():
            for item_id in ids:  # the padded line is one character ahead, and the item ends before its blank
                found[item_id] = min(found.get(item_id, (0, end - 1)), (0, end - 1))
        return [(i, *found[i]) for i in sorted(found)]


def joined(starts: list[int], budget: int) -> Iterator[tuple[int, int]]:
    """Ranges of diagonals that lie within twice the budget of each other."""
    low = high = starts[0]
    for s in starts[1:]:
        if s - high > 2 * budget:
            yield low, high
            low = s
        high = s
    yield low, high


def blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS, id_col: str = "item_id",
           text_col: str = "text") -> Iterator[list[tuple[int, str]]]:
    """The items in bounded lists, one at a time."""
    items = small_batches(benchmark).select(F.col(id_col).cast("long").alias("item_id"), text_or_empty(text_col).alias("text"))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-chars // (block_chars // 2)) if chars > block_chars else 1
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else items
        yield [(r[0], r[1]) for r in part.collect()]


def find_leaks(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, min_words: int = MIN_WORDS,
               block_chars: int = BLOCK_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and item that it contains; texts stay where they are."""
    out = None
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    for items in blocks(benchmark, block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches, shared=shared):
            import pyarrow as pa

            matcher = Matcher(shared.value, error_rate, min_words)
            names, kinds = ["doc_id", "item_id", "distance", "end"], [pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            for batch in batches:
                rows = [(i.as_py(), *hit) for i, t in zip(batch.column(0), batch.column(1), strict=True)
                        for hit in matcher.find(t.as_py())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

        part = texts.mapInArrow(run, OUT)
        out = part if out is None else out.unionByName(part)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, min_words: int = MIN_WORDS,
               block_chars: int = BLOCK_CHARS, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that contain no item."""
    at = docs.columns.index(text_col)
    for items in blocks(benchmark, block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches, shared=shared):
            import pyarrow as pa

            matcher = Matcher(shared.value, error_rate, min_words)
            for batch in batches:
                yield batch.filter(pa.array([not matcher.find(t.as_py() or "") for t in batch.column(at)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
