"""Token counts by prefix dynamic programming.

For a merge-based vocabulary the encoding of every prefix of a segment ends
with exactly one token t whose predecessor is the encoding of the prefix
without t, and (previous token, t) must be a pair that the encoder leaves as
it is. So ``count[i] = count[i - len(t)] + 1``, and one pass over a segment
gives the exact token count of every prefix. Pieces of the vocabulary never
have a blank after another character (checked on load), so a text is the
concatenation of its blank-led segments, whose prefix counts are kept in a
bounded cache; counts of the whole text are running sums.

From the stored counts follow, without encoding again: the tokens of any
prefix (``PrefixCounts.upto``), the longest prefix within a budget
(``PrefixCounts.fit``) and the total.

Defined results: null and empty texts have 0 tokens and bytes; repeated rows
give repeated rows; an empty table no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worklake.llm.common import text_or_empty

OUT = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long"

#: Segments kept in a worker's cache, which starts anew beyond them, and bytes of text looked at together.
CACHE_SEGMENTS, TOGETHER = 500_000, 5_000_000

BLANK = "▁"
_SEGMENT = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")


class PieceVocabulary:
    """Pieces and merge scores of a sentencepiece BPE model, with prefix counts of segments."""

    def __init__(self, model_file: str):
        import sentencepiece

        sp = self.sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.score = {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.get_piece_size())
                      if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}
        self.split = not any(re.search(f"[^{BLANK}]{BLANK}", p) for p in self.score)
        self.bytes = any(sp.is_byte(i) for i in range(sp.get_piece_size()))
        sample = " a  b\nc\tﬁ "
        if not self.bytes or sp.normalize(sample) != BLANK + sample.replace(" ", BLANK):
            raise ValueError("a byte-fallback model that leaves texts as they are is needed")
        #: By piece: what may stand before it ("": it stays whole), as far as known.
        self.after: dict[str, dict[str, bool]] = {p: {} for p in self.score}
        #: By the last three characters: the lengths of the pieces that end so, longest first.
        lengths: dict[str, set[int]] = {p: {2} for p in self.score if len(p) == 2}
        for p in self.score:
            if len(p) > 2:
                lengths.setdefault(p[-3:], {2} if p[-2:] in self.score else set()).add(len(p))
        self.lengths = {k: tuple(sorted(v, reverse=True)) for k, v in lengths.items()}
        self.cache: dict[str, bytes | tuple[int, ...]] = {}

    def merge(self, text: str) -> list[str]:
        """The pieces of a short text by best-score merges, leftmost first."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stays(self, left: str, right: str) -> bool:
        """Whether the encoder leaves the two pieces apart, and whole (left may be empty)."""
        found = self.after[right][left] = self.merge(left + right) == ([left, right] if left else [right])
        return found

    def learn(self, segments) -> None:
        """Prefix counts of segments that aren't cached yet. In sorted order, neighbours
        share the states of their common prefix."""
        wanted = set(segments)
        new = wanted - self.cache.keys()
        if len(self.cache) + len(new) > CACHE_SEGMENTS:
            self.cache.clear()
            new = wanted
        score, lengths, after, cache = self.score, self.lengths, self.after, self.cache
        before, last, count = "", [""], [0]
        for segment in sorted(new):
            same = 0
            for a, b in zip(before, segment, strict=False):
                if a != b:
                    break
                same += 1
            del last[same + 1:], count[same + 1:]
            for i in range(same + 1, len(segment) + 1):
                for n in lengths.get(segment[i - 3 if i > 3 else 0:i]) or lengths.get(segment[i - 2:i], ()) if i > 1 else ():
                    if n <= i and (known := after.get(piece := segment[i - n:i])) is not None:
                        stays = known.get(left := last[i - n])
                        if self.stays(left, piece) if stays is None else stays:
                            last.append(piece)
                            count.append(count[i - n] + 1)
                            break
                else:
                    char = segment[i - 1]
                    last.append(char)
                    count.append(count[i - 1] + (1 if char in score else len(char.encode("utf-8", "surrogatepass"))))
            cache[segment] = bytes(count[1:]) if count[-1] < 200 and max(count) < 256 else tuple(count[1:])
            before = segment

    def segments(self, text: str) -> list[str]:
        line = BLANK + text.replace(" ", BLANK)
        return _SEGMENT.findall(line) if self.split else [line]


@lru_cache(maxsize=2)
def vocabulary_of(model_file: str) -> PieceVocabulary:
    """One per Python worker: later tasks of a worker find its segments learned."""
    return PieceVocabulary(model_file)


class PrefixCounts:
    """Exact token counts at every prefix of one text."""

    def __init__(self, vocabulary: PieceVocabulary, text: str, segments: list[str] | None = None):
        if segments is None:
            segments = vocabulary.segments(text) if text else []
            vocabulary.learn(segments)
        self.counts = [vocabulary.cache[s] for s in segments]
        self.chars, self.total = len(text), sum([c[-1] for c in self.counts])
        self._parts = None

    @property
    def parts(self):
        """(characters before, tokens before, counts) of each segment."""
        if self._parts is None:
            # The blank that the encoder puts in front is no character of the text.
            chars = accumulate(map(len, self.counts), initial=-1)
            tokens = accumulate((c[-1] for c in self.counts), initial=0)
            self._parts = list(zip(chars, tokens, self.counts, strict=False))
        return self._parts

    def upto(self, n_chars: int) -> int:
        """Tokens of the text's first ``n_chars`` characters, encoded as a text of its own."""
        if n_chars <= 0:
            return 0
        for chars, tokens, counts in reversed(self.parts):
            if chars < n_chars:
                return tokens + counts[min(n_chars - chars, len(counts)) - 1]
        return 0

    def fit(self, budget: int) -> int:
        """Characters of the longest prefix with at most ``budget`` tokens."""
        if self.total <= budget:
            return self.chars
        for chars, tokens, counts in reversed(self.parts):
            for k in range(len(counts) - 1, -1, -1):
                if chars + k + 1 >= 0 and tokens + counts[k] <= budget:
                    return chars + k + 1
        return 0

    def array(self):
        """The counts of the prefixes of 1, 2, ... characters, as int32 bytes."""
        import numpy as np

        parts = [np.asarray(list(c), dtype="<i4") + t for _, t, c in self.parts]
        return (np.concatenate(parts)[1:] if parts else np.zeros(0, "<i4")).tobytes()


def slices(batch):
    """The batch in runs of rows whose texts (column 1) have about ``TOGETHER`` bytes."""
    import pyarrow.compute as pc

    start, held = 0, 0
    for k, n in enumerate(pc.binary_length(batch.column(1)).to_pylist()):
        held += n
        if held >= TOGETHER:
            yield batch.slice(start, k + 1 - start)
            start, held = k + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def token_counts(docs: DataFrame, model_file: str, limit: int = 4096, with_prefixes: bool = False,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its bytes, tokens, whether it is over ``limit`` and the characters that
    fit in it; ``with_prefixes`` adds the count at every prefix as int32 bytes."""
    def run(batches):
        import pyarrow as pa

        vocabulary = vocabulary_of(model_file)
        names = [f.split()[0] for f in OUT.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64()]
        for batch in (part for whole in batches for part in slices(whole)):
            ids, rows = batch.column(0), []
            texts = batch.column(1).to_pylist()
            parts = [vocabulary.segments(t) if t else [] for t in texts]
            vocabulary.learn(s for p in parts for s in p)
            for text, segments in zip(texts, parts, strict=True):
                counts = PrefixCounts(vocabulary, text, segments)
                rows.append((len(text.encode("utf-8", "surrogatepass")), counts.total, counts.total > limit,
                             counts.fit(limit), counts.array() if with_prefixes else None))
            out = [ids] + [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds[1:])]
            if with_prefixes:
                out.append(pa.array([r[4] for r in rows], pa.binary()))
            yield pa.RecordBatch.from_arrays(out, names + ["prefix_tokens"] * with_prefixes)

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
            .mapInArrow(run, OUT + ", prefix_tokens binary" * with_prefixes))
