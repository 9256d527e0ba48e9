"""Licence scan: Aho-Corasick over word-normalised text, and SPDX expressions.

A text is lower-cased (A-Z) and reduced to its words ``[0-9a-z]`` and
non-ASCII characters, joined by single blanks; one Aho-Corasick automaton then
finds all phrases at word boundaries in one pass, overlaps included.
Identifier tags (``SPDX-License-Identifier: ...``) are read from the original
text and their and/or/with expressions are evaluated by a shunting-yard parser.

Columns: ``n_words``, ``n_base`` (places of base phrases), ``first_word`` and
``last_word`` (smallest and largest start of a base phrase, null without one),
``base_labels``, ``labels`` (base, phrase and expression labels; sorted, comma-joined),
``score`` (0 to 1: 1 for a well-formed identifier tag; else 1 - 0.5^places, where a
notice phrase counts as a place), ``expression`` (normal form of the first
well-formed tag) and ``permissive`` (whether the tag can be met by permissive licences alone).

Defined results: null and empty texts have no words, no labels and score 0;
repeated rows give repeated rows; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worklake.llm.common import text_or_empty

# Base phrases and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Notice phrases beside the base ones: words as they read after normalising.
MORE_PHRASES = {
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "isc license": "isc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc0 1 0": "cc0",
    "creative commons attribution": "cc-by",
    "public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}

# Families of licence identifiers. An identifier is a family with a version, a
# number of clauses and a suffix, each optional; own references have a prefix.
FAMILIES = ("0bsd aal afl agpl apache apsl artistic blueoak bsd bsl cc-by cc-by-nc cc-by-nc-nd cc-by-nc-sa cc-by-nd cc-by-sa cc0 "
            "cddl cecill cecill-b cecill-c cpal cpl ecl efl epl eupl gfdl gpl hpnd icu ijg ipl isc lgpl libpng lppl mit mit-0 mpl "
            "ms-pl ms-rl mulanpsl ncsa odbl odc-by ofl openssl osl pddl php postgresql psf python qpl ruby sissl sleepycat sspl "
            "unicode unlicense upl vim w3c wtfpl x11 zlib zpl").split()
# Labels of one licence under two names.
SAME = {"apache-2.0": "apache-2", "cc0-1.0": "cc0"}

PERMISSIVE = {"mit", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "isc", "cc0-1.0", "cc-by-4.0", "unlicense", "zlib"}

OUT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
       "labels string, score double, expression string, permissive boolean")

_TAG = re.compile(r"spdx-license-identifier:[ \t]*([^\r\n]*)", re.IGNORECASE)
_TOKEN = re.compile(r"[()]|[A-Za-z0-9.+:\-]+")
_IDENTIFIER = re.compile(rf"(?:{'|'.join(sorted(FAMILIES, key=len, reverse=True))})(?:-v?\d+(?:\.\d+)*)?(?:-clause)?(?:-only|-or-later|\+)?")
_REFERENCE = re.compile(r"(?:documentref-[a-z0-9.\-]+:)?licenseref-[a-z0-9.\-]+")
_EXCEPTION = re.compile(r"[a-z0-9.\-]*(?:exception|linking|additionref-)[a-z0-9.\-]*")
_WORD_BYTES = bytes(c if chr(c) in "0123456789abcdefghijklmnopqrstuvwxyz" or c >= 128
                    else ord(chr(c).lower()) if "A" <= chr(c) <= "Z" else 32 for c in range(256))
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def is_licence(token: str) -> bool:
    """Whether a lower-case token reads like a licence identifier."""
    return bool(_IDENTIFIER.fullmatch(token) or _REFERENCE.fullmatch(token))


def to_postfix(expression: str) -> list[str] | None:
    """Shunting-yard: tokens of the longest well-formed start in postfix order, None without one.

    Operands are licence identifiers, or exceptions behind ``with``. What follows
    the start is taken as prose, so that a tag inside a sentence still counts.
    """
    out: list[str] = []
    stack: list[str] = []
    whole, operand_next, depth = None, True, 0
    for token in _TOKEN.findall(expression):
        low = token.lower()
        if operand_next:
            low = low.rstrip(".")
            if token == "(":
                stack.append(token)
                depth += 1
                continue
            if not (_EXCEPTION.fullmatch(low) if stack and stack[-1] == "with" else is_licence(low)):
                break
            out.append(low)
            operand_next = False
        elif token == ")" and depth:
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
            depth -= 1
        elif low in _PRECEDENCE:
            while stack and stack[-1] != "(" and _PRECEDENCE[stack[-1]] >= _PRECEDENCE[low]:
                out.append(stack.pop())
            stack.append(low)
            operand_next = True
            continue
        else:
            break
        if not depth:
            whole = out + stack[::-1]
    return whole


def evaluate(postfix: list[str], allowed=PERMISSIVE) -> tuple[str, bool, list[str]]:
    """(normal form, can be met within ``allowed``, licence labels) of a postfix expression."""
    stack: list[tuple[str, bool, list[str], int]] = []
    for token in postfix:
        if token not in _PRECEDENCE:
            stack.append((token, token.rstrip("+") in allowed, [token], 9))
            continue
        right, left = stack.pop(), stack.pop()
        rank = _PRECEDENCE[token]
        form = " ".join((f"({left[0]})" if left[3] < rank else left[0], token,
                         f"({right[0]})" if right[3] < rank else right[0]))
        if token == "with":  # the exception widens the licence, it is no licence itself
            stack.append((form, left[1], left[2], rank))
        else:
            ok = left[1] and right[1] if token == "and" else left[1] or right[1]
            stack.append((form, ok, left[2] + right[2], rank))
    return stack[0][:3]


def automaton(phrases):
    import ahocorasick

    found = ahocorasick.Automaton()
    for phrase in phrases:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


class Scanner:
    """Scans one text; phrases must already be normalised words."""

    def __init__(self, base=None, more=None):
        self.base, self.more = dict(BASE_PHRASES if base is None else base), dict(MORE_PHRASES if more is None else more)
        self.automaton = automaton({**self.base, **self.more})

    def scan(self, text: str) -> tuple:
        words = words_of(text)
        line = f" {b' '.join(words).decode('utf-8', 'surrogatepass')} "
        n_base, first, last, base, labels, places = 0, None, None, set(), set(), 0
        at, blanks = 0, 0  # blanks before position at, counted on from one hit to the next
        for end, phrase in self.automaton.iter(line):
            start = end - len(phrase) - 1
            places += 1
            if phrase in self.base:
                if start >= at:
                    blanks += line.count(" ", at, start)
                else:
                    blanks -= line.count(" ", start, at)
                at = start
                n_base += 1
                first = blanks if first is None else min(first, blanks)
                last = blanks if last is None else max(last, blanks)
                base.add(self.base[phrase])
            else:
                labels.add(self.more[phrase])
        form, permissive = None, None
        if _TAG.search(text):
            for tag in _TAG.finditer(text):
                postfix = to_postfix(tag.group(1))
                if postfix:
                    normal, ok, names = evaluate(postfix)
                    labels.update(SAME.get(n, n) for n in names)
                    form, permissive = (normal, ok) if form is None else (form, permissive)
        score = 1.0 if form else 1.0 - 0.5 ** min(places, 50)
        return (len(words), n_base, first, last, ",".join(sorted(base)),
                ",".join(sorted(base | labels)), score, form, permissive)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  base=None, more=None) -> DataFrame:
    """One row per document; each task scans its own texts, nothing is shuffled."""
    def run(batches):
        import pyarrow as pa

        scanner = Scanner(base, more)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(),
                 pa.float64(), pa.string(), pa.bool_()]
        names = [f.split()[0] for f in OUT.split(", ")]
        for batch in batches:
            rows = [(i.as_py(), *scanner.scan(t.as_py())) for i, t in zip(batch.column(0), batch.column(1), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
            .mapInArrow(run, OUT))
