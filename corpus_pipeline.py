"""Corpus pipeline: quality filter, line dedup, near-duplicate removal, decontamination, packing.

Each stage works on all rows its predecessor kept; all but the last return the
columns of ``documents``. Near-duplicates are five-word shingle sets of Jaccard
similarity 0.8 or more, of which the smallest doc_id stays.
"""

from __future__ import annotations

from worklake.llm import decontaminate, line_dedup, ngram_join, packing, quality_model
from worklake.llm.common import read_table, stage
from worklake.llm.queries import byte_bpe


def quality_classifier(spark, docs, sf_dir):
    """Documents whose quality score is below 0.3 go."""
    return quality_model.keep_good(docs, read_table(spark, sf_dir, "labels"))


def dedup_lines(spark, docs, sf_dir):
    """Copied blocks of lines leave later documents; documents of copied lines alone go."""
    return line_dedup.keep_own_lines(docs)


def dedup_near_copies(spark, docs, sf_dir):
    """One document of each group of near-duplicates stays."""
    return ngram_join.keep_first(docs, n=5, percent=80)


def decontamination(spark, docs, sf_dir):
    """Documents that contain a benchmark item go."""
    return decontaminate.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark, docs, sf_dir):
    """The pieces of the remaining documents in sequences of at most 1024 tokens."""
    return packing.pack(docs, byte_bpe())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", dedup_lines),
    ("ngram_join", dedup_near_copies),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: Model scores, alignments and merges aren't SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply the stages to ``documents``; each stage's result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{name}")
    return docs
