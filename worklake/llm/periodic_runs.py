"""Periodic runs of words by the branching-tandem test on an enhanced suffix array.

A run is a stretch of words with smallest period q, at least two periods and
``MIN_LENGTH`` words long, that no neighbouring word extends. Documents of a batch
are searched together in numpy; every step is one pass over arrays:

1. ``suffix_array``: prefix doubling over (document, word) symbols, so that
   suffixes of different documents never share a prefix. Only groups that are not
   settled yet are sorted again. The ranks of each level are kept.
2. ``lcp_array``: neighbours that part at level k share 2^k words and less than
   2^(k+1); the levels below give the rest.
3. ``intervals``: the LCP interval of each entry by previous and next smaller
   entries, with the entries of an interval parting it into children; no tree nodes.
4. ``branching_squares``: for an interval of depth d, each suffix i of all children
   but the largest is tested: ISA[i + d] or ISA[i - d] in the interval but in another child
   means that a square of period d begins at i or i - d and that the word behind it
   doesn't continue it. Each run ends with exactly one such square per multiple of its period.
5. ``runs_of``: squares are rotated left as long as words agree, smallest
   period per end first; squares that are powers of a run found at their end are merged into it.

A batch has at most ``BLOCK_WORDS`` words or one document; memory is about
8 bytes x words x (20 + log2 of the longest repeat). A document is one row, and
rows are independent, so that nothing is shuffled and no key can be hot.

Defined results: null, empty and wordless texts have no runs and an empty
collapsed text; repeated rows give repeated rows, and rows with a null id are
searched like all others; of equal runs at one end the smallest period counts; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worklake.llm.common import small_batches

MIN_LENGTH = 12
BLOCK_WORDS = 250_000
#: Rounds of pointer jumping before a stack takes the open rest; single steps before blocks are compared.
JUMPS, STEPS = 12, 48
#: Suffixes tested at once.
VISITS = 1 << 21


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(SA, ranks by level, level at which each entry parted from the one before).

    ``symbols`` are such that equal ones are followed by a unique one sooner or
    later (a document's end). ranks[k] is equal for suffixes that share 2^k symbols;
    the last level has no ties and is the inverse suffix array.
    """
    n = len(symbols)
    sa = np.argsort(symbols, kind="stable")
    parted = np.full(n, -1, np.int8)
    active, key, old = np.arange(n), symbols[sa], None
    rank = np.zeros(n, np.int64)
    ranks: list[np.ndarray] = []
    step = 1
    while True:
        new = np.empty(len(active), bool)
        new[:1] = True
        np.not_equal(key[1:], key[:-1], out=new[1:])
        if old is not None:
            same = new.copy()
            same[1:] &= old[1:] == old[:-1]
            same[:1] = False
            parted[active[same]] = len(ranks) - 1
        heads = np.maximum.accumulate(np.where(new, np.arange(len(active)), 0))
        rank = rank.copy()
        rank[sa[active]] = active[heads]
        ranks.append(rank)
        alone = new.copy()
        alone[:-1] &= new[1:]
        active = active[~alone]
        if not len(active):
            return sa, ranks, parted
        at = sa[active]
        key = rank[at] * n + rank[at + step]
        order = np.argsort(key)
        key, at = key[order], at[order]
        sa[active], old = at, rank[at]
        step *= 2


def lcp_array(sa: np.ndarray, ranks: list[np.ndarray], parted: np.ndarray) -> np.ndarray:
    """lcp[k]: words that the suffixes at k - 1 and k share."""
    lcp = np.zeros(len(sa) + 1, np.int64)
    for level in range(len(ranks) - 1):
        k = np.flatnonzero(parted == level)
        if not len(k):
            continue
        a, b, shared = sa[k - 1], sa[k], np.full(len(k), 1 << level)
        for low in range(level - 1, -1, -1):
            shared += (ranks[low][a + shared] == ranks[low][b + shared]).astype(np.int64) << low
        lcp[k] = shared
    return lcp


def _smaller(lcp: np.ndarray, k: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Nearest smaller entry in direction ``step`` of each entry k by pointer jumping; with the entries left open."""
    to = np.arange(len(lcp)) + step
    to[0], to[-1] = 0, len(lcp) - 1  # both ends hold 0 and are smaller than any entry asked for
    for _ in range(JUMPS):
        k = k[lcp[to[k]] >= lcp[k]]
        if not len(k):
            break
        to[k] = to[to[k]]
    return to, k[lcp[to[k]] >= lcp[k]] if len(k) else k


def _by_stack(values: list[int]) -> tuple[list[int], list[int]]:
    """Previous and next smaller places of a list (-1 and its length where there is none)."""
    before, after, stack = [-1] * len(values), [len(values)] * len(values), []
    for k, v in enumerate(values):
        while stack and values[stack[-1]] > v:
            after[stack.pop()] = k
        before[k] = before[stack[-1]] if stack and values[stack[-1]] == v else stack[-1] if stack else -1
        stack.append(k)
    for k in range(len(values) - 2, -1, -1):  # equal entries end together
        if after[k] < len(values) and values[after[k]] == values[k]:
            after[k] = after[after[k]]
    return before, after


def intervals(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(k, left, right): entry k > 0 parts the interval SA[left:right] of depth lcp[k]."""
    k = np.flatnonzero(lcp > 0)
    left, open_left = _smaller(lcp, k, -1)
    right, open_right = _smaller(lcp, k, 1)
    # Long ascents are walked entry by entry: a stack settles their whole stretch of positive entries.
    rest = np.union1d(open_left, open_right)
    if len(rest):
        zero = np.flatnonzero(lcp == 0)
        for place in np.unique(np.searchsorted(zero, rest)):
            begin, end = zero[place - 1] + 1, zero[place]
            before, after = _by_stack(lcp[begin:end].tolist())
            left[begin:end], right[begin:end] = np.array(before) + begin, np.array(after) + begin
    return k, left[k], right[k]


def branching_squares(sa: np.ndarray, isa: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, period) of each square whose next word differs from the word a period before it."""
    k, left, right = intervals(lcp)
    if not len(k):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(left * len(lcp) + right, kind="stable")
    k, left, right = k[order], left[order], right[order]
    first = np.empty(len(k), bool)
    first[0] = True
    first[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    group = np.cumsum(first) - 1
    # Children: an interval with m entries has m + 1, each beginning at its left end or at an entry.
    place = np.arange(len(k)) + group + 1
    begin, end = np.empty(len(k) + group[-1] + 1, np.int64), np.empty(len(k) + group[-1] + 1, np.int64)
    heads = place[first] - 1
    tails = np.append(heads[1:], len(begin)) - 1
    begin[place], begin[heads] = k, left[first]
    end[place - 1], end[tails] = k, right[first]
    of = np.repeat(np.arange(len(heads)), tails - heads + 1)
    size = end - begin
    largest = np.flatnonzero(size == np.maximum.reduceat(size, heads)[of])
    small = np.ones(len(begin), bool)
    small[largest[np.unique(of[largest], return_index=True)[1]]] = False
    child, size = np.flatnonzero(small), size[small]
    interval = of[child]
    depth, low, high = lcp[k[first]][interval], left[first][interval], right[first][interval]

    found = []
    total = np.cumsum(size)
    at = 0
    while at < len(child):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + VISITS, side="right")))
        n = size[at:to]
        part = np.repeat(np.arange(at, to), n)
        ramp = np.arange(len(part)) - np.repeat(np.cumsum(n) - n, n)
        i, d = sa[begin[child[part]] + ramp], depth[part]
        for j, square in ((i + d, i), (i - d, i - d)):
            inside = np.flatnonzero((j >= 0) & (j < len(isa)))
            q, p = isa[j[inside]], part[inside]
            hit = (q >= low[p]) & (q < high[p]) & ((q < begin[child[p]]) | (q >= end[child[p]]))
            found.append(np.stack([square[inside[hit]], d[inside[hit]]]))
        at = to
    both = np.concatenate(found, axis=1)
    both = np.unique(both, axis=1) if both.shape[1] else both
    return both[0], both[1]


def rotate_left(symbols: np.ndarray, begin: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Where the stretch with the square's period begins."""
    begin = begin.copy()
    going = np.arange(len(begin))
    for _ in range(STEPS):
        b = begin[going]
        going = going[(b > 0) & (symbols[b - 1] == symbols[b - 1 + period[going]])]
        if not len(going):
            return begin
        begin[going] -= 1
    for s in going.tolist():  # long ones: blocks of doubling size
        b, d, size = int(begin[s]), int(period[s]), STEPS
        while b:
            size = min(2 * size, b)
            other = np.flatnonzero(symbols[b - size:b] != symbols[b - size + d:b + d])
            if len(other):
                b += int(other[-1]) + 1 - size
                break
            b -= size
        begin[s] = b
    return begin


def runs_of(symbols: np.ndarray, begin: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, period) of the runs that the branching squares belong to."""
    end = begin + 2 * period
    order = np.lexsort((period, end))
    begin, period, end = begin[order], period[order], end[order]
    out = [np.zeros((3, 0), np.int64)]
    while len(end):
        head = np.empty(len(end), bool)
        head[0] = True
        head[1:] = end[1:] != end[:-1]
        start = rotate_left(symbols, begin[head], period[head])
        out.append(np.stack([start, end[head], period[head]]))
        of = np.cumsum(head) - 1
        merged = (period % period[head][of] == 0) & (begin >= start[of])  # powers, and the square itself
        begin, period, end = begin[~merged], period[~merged], end[~merged]
    return tuple(np.concatenate(out, axis=1))


def find_runs(words: list[list], min_length: int = MIN_LENGTH) -> list[list[tuple[int, int, int]]]:
    """Per document its runs as (start, length, period), by start, then period."""
    sizes = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(sizes + 1)
    starts = ends - sizes - 1
    ids: dict = defaultdict(count(1).__next__)
    symbols = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
    for w, s, e in zip(words, starts.tolist(), ends.tolist(), strict=True):
        symbols[s:e - 1] = [ids[x] for x in w]
        symbols[e - 1] = 0  # the document's end
    symbols += np.repeat(np.arange(len(words)), sizes + 1) * (len(ids) + 1)
    out: list[list[tuple[int, int, int]]] = [[] for _ in words]
    if not len(symbols):
        return out
    sa, ranks, parted = suffix_array(symbols)
    begin, period = branching_squares(sa, ranks[-1], lcp_array(sa, ranks, parted))
    begin, end, period = runs_of(symbols, begin, period)
    long = np.flatnonzero(end - begin >= max(1, min_length))
    long = long[np.lexsort((period[long], begin[long]))]
    of = np.searchsorted(ends, begin[long], side="right")
    for d, b, e, q in zip(of.tolist(), (begin[long] - starts[of]).tolist(), (end[long] - starts[of]).tolist(),
                          period[long].tolist(), strict=True):
        out[d].append((b, e - b, q))
    return out


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words outside every run's repetitions; a run's first period stays."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    keep = np.cumsum(change[:-1]) == 0
    return [w for w, k in zip(words, keep.tolist(), strict=True) if k]


RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_words``, ``runs`` and ``collapsed`` (the kept words joined by one space)."""
    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

        def block(keys, words):
            runs = find_runs(words, min_length)
            kept = [b" ".join(collapse(w, r)) for w, r in zip(words, runs, strict=True)]
            return pa.RecordBatch.from_arrays([
                pa.array(keys, pa.int64()), pa.array([len(w) for w in words], pa.int64()),
                pa.array([[dict(zip(("start", "length", "period"), x)) for x in r] for r in runs], kind),
                pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

        for batch in batches:
            keys, words, held = [], [], 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                w = (text or b"").split()
                if words and held + len(w) > BLOCK_WORDS:
                    yield block(keys, words)
                    keys, words, held = [], [], 0
                keys.append(key)
                words.append(w)
                held += len(w)
            if words:
                yield block(keys, words)

    given = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(run, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def run_digests(found: DataFrame) -> DataFrame:
    """The longest run (ties: smallest start, then period) and digests of all runs and of the collapsed text."""
    longest = F.get(F.array_sort("runs", lambda a, b: F.when(a["length"] != b["length"], F.signum(b["length"] - a["length"]))
                                 .when(a["start"] != b["start"], F.signum(a["start"] - b["start"]))
                                 .otherwise(F.signum(a["period"] - b["period"])).cast("int")), F.lit(0))
    line = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    lines = F.when(F.size("runs") > 0, F.concat(F.array_join(line, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "longest.start", "longest.length", "longest.period",
        F.expr("1000 * longest.length div longest.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
