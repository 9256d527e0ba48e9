"""Quality rules as a short-circuit cascade, with DataFrame functions only.

``rule_counts`` derives the counts of a text natively; ``default_rules`` state when a
document fails, in terms of those counts and the text. ``order_rules`` runs
each rule many times over a bounded sample, takes its time less that of an empty
job and the share it rejects, and orders the rules by rejection per cost; ``apply_rules`` nests them as one CASE
expression, which stops at the first rule that fails. The order only changes
the work and the name of the first failing rule: a document is kept if no rule fails it.

Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text. ``n_repeat_words`` counts
the words inside 5-word windows that occur twice or more in the text: windows
are hashed (64 bit), sorted once, and runs of equal hashes mark their places,
so a text of n words costs n log n.

Defined results: null and empty texts have no words and fail the base rule;
repeated rows give repeated rows; an empty table no rows; other columns are
ignored.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklake.llm.common import text_or_empty

SPACES = "[ \\t\\n\\x0B\\f\\r]+"
#: Rows of the sample on which rules are timed.
SAMPLE_ROWS = 400
#: Times that a rule is applied to each of them, and the seconds by which costs must differ to count.
REPEATS, COST_STEP = 20, 0.1


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row (bound as a lambda variable)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def repeated_words(words: Column, window: int = 5) -> Column:
    """Words of the array inside windows that occur at least twice."""
    def covered(starts):
        gaps = F.transform(starts, lambda p, i: F.when(i == 0, F.lit(window)).otherwise(
            F.least(F.lit(window), p - F.get(starts, i - 1))))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    def marked(pairs):
        hash_at = lambda i: F.get(pairs, i)["h"]
        same = F.filter(pairs, lambda p, i: p["h"].eqNullSafe(hash_at(i - 1)) | p["h"].eqNullSafe(hash_at(i + 1)))
        return let(F.array_sort(F.transform(same, lambda p: p["i"])), covered)

    def of_hashes(hashes):
        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            let(F.sort_array(pairs), marked))

    def of_words(w):
        starts = F.sequence(F.lit(0), F.size(w) - window)
        hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(window)]))
        return F.when(F.size(w) <= window, F.lit(0)).otherwise(let(hashes, of_hashes))

    return let(words, of_words)


def rule_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = F.col("text")
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.length(F.translate(line, " \t\x0b\f\r", "")) > 0)
    one = (docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")))
    counts = let(words_of(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        repeated_words(w).cast("long").alias("n_repeat_words")))
    return (one.select(
        "doc_id", "text", counts.alias("c"),
        F.length(F.translate(text, " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))
        .select("doc_id", "text", "c.n_words", "word_chars", "n_symbols", "n_dup_lines", "c.n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


@dataclass(frozen=True)
class Rule:
    """``fails`` is a boolean column over the counts and ``text``."""

    name: str
    fails: Column


def default_rules() -> list[Rule]:
    """Rules beside the base one; thresholds are wide, so that ordinary prose passes."""
    text, n, chars = F.col("text"), F.col("n_words"), F.col("word_chars")
    removed = lambda chars_: F.length(text) - F.length(F.translate(text, chars_, ""))
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return [
        Rule("symbols", 4 * F.col("n_symbols") > n),
        Rule("word_length", (chars > 30 * n) | (chars < 2 * n)),
        Rule("duplicate_lines", 2 * F.col("n_dup_lines") > F.size(F.split(text, "\n", -1))),
        Rule("capitals", 2 * removed(capitals) > chars),
        Rule("exclamations", 2 * removed("!") > n),
        Rule("no_letters", 10 * F.length(F.regexp_replace(text, "[\\p{L}\\s]+", "")) > 7 * chars),
    ]


def sample_of(docs: DataFrame, rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each of the ``rows`` smallest hashes of ids: no texts but theirs are computed or sent."""
    h = F.xxhash64(F.col(id_col))
    bound = docs.select(h.alias("h")).distinct().orderBy("h").limit(rows).agg(F.max("h")).first()[0]
    return docs.where(h <= F.lit(bound)).groupBy(id_col).agg(F.min(text_col).alias(text_col))


def order_rules(sample: DataFrame, rules: list[Rule], repeats: int = REPEATS) -> list[Rule]:
    """The rules by rejection per cost on a sample of counted documents, highest first; ties by name.

    One job per rule applies it ``repeats`` times to each row, less a job that applies none. Costs are
    compared in steps of ``COST_STEP``, since a job's own time varies by more than a rule's.
    """
    sample = sample.persist()
    try:
        n = max(1, sample.count())
        many = F.sequence(F.lit(1), F.lit(repeats))

        def seconds(fails: Column) -> tuple[float, int]:
            work = F.aggregate(F.transform(many, lambda i: F.when((i > 0) & fails, 1).otherwise(0)), F.lit(0), lambda a, x: a + x)
            best, rejected = None, 0
            for _ in range(2):
                began = time.perf_counter()
                rejected = sample.agg(F.count_if(work > 0)).first()[0]
                took = time.perf_counter() - began
                best = took if best is None else min(best, took)
            return best, rejected

        empty, _ = seconds(F.lit(False))
        scored = []
        for rule in rules:
            took, rejected = seconds(F.coalesce(rule.fails, F.lit(False)))
            cost = 1 + max(0, round((took - empty) / COST_STEP))
            scored.append((-(rejected + 1) / (n + 1) / cost, rule.name, rule))
    finally:
        sample.unpersist()
    return [rule for _, _, rule in sorted(scored, key=lambda x: x[:2])]


def cascade(rules: list[Rule]) -> Column:
    """Name of the first rule that fails; CASE stops there. Null if none does."""
    out = F.when(base_failed(), F.lit("base"))
    for rule in rules:
        out = out.when(rule.fails, F.lit(rule.name))
    return out


def apply_rules(docs: DataFrame, rules: list[Rule] | None = None, order: bool = True,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, verdicts and the first failing rule of every document."""
    counts = rule_counts(docs, id_col, text_col)
    rules = default_rules() if rules is None else rules
    if order and rules:
        rules = order_rules(rule_counts(sample_of(docs, SAMPLE_ROWS, id_col, text_col), id_col, text_col), rules)
    return (counts.withColumn("first_failed", cascade(rules))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    base_failed().alias("base_failed"), F.col("first_failed").isNull().alias("kept"),
                    "first_failed"))
