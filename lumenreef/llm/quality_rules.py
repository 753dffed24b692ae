"""Quality rules as a short-circuit cascade ordered by rejection per cost.

Every rule is a test on one text. The cascade measures each rule's cost and
its rejections on a bounded sample, orders the rules greedily by rejections per
second among the sample rows that earlier rules let through, and stops at
a row's first failing rule. A row is kept if no rule rejects it, so the order
changes the time and never the verdict.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenreef.llm._arrow import slices, texts_of

#: Rows of the sample on which costs and rejections are estimated, and the
#: longest text (characters) that the sample takes; neither changes a verdict.
SAMPLE_ROWS = 400
SAMPLE_CHARS = 100_000
SAMPLE_FRACTION = 0.05

SYMBOLS = "#*$%&|<>"
_WHITE = " \t\n\v\f\r"


class TextStats:
    """Statistics of one text, each computed when a rule first asks for it."""

    def __init__(self, text: str) -> None:
        self.text = text

    def __getattr__(self, name: str):
        value = getattr(self, f"_{name}")()
        self.__dict__[name] = value
        return value

    def _raw(self) -> bytes:
        return self.text.encode("utf-8", "replace")

    def _words(self) -> list[bytes]:
        return self.raw.split()  # of bytes: at ASCII white space only

    def _n_words(self) -> int:
        return len(self.words)

    def _word_chars(self) -> int:
        return len(self.text) - sum(self.text.count(c) for c in _WHITE)

    def _n_symbols(self) -> int:
        return sum(self.text.count(c) for c in SYMBOLS)

    def _lines(self) -> list[bytes]:
        return [x for x in self.raw.split(b"\n") if x and not x.isspace()]

    def _n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    def _n_repeat_words(self) -> int:
        w = self.words
        windows = list(zip(w, w[1:], w[2:]))
        if len(set(windows)) == len(windows):
            return 0
        seen = Counter(windows)
        covered = 0
        until = 0  # words before this one are counted
        for i, window in enumerate(windows):
            if seen[window] > 1:
                covered += i + 3 - max(i, until)
                until = i + 3
        return covered

    def _n_upper(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, _UPPER))

    def _n_lower(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, _LOWER))

    def _n_digits(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, _DIGITS))


_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = _UPPER.lower()
_DIGITS = b"0123456789"


@dataclass(frozen=True)
class Rule:
    """A named test; ``rejects`` is true for a text that fails it."""

    name: str
    rejects: Callable[[TextStats], bool]


#: The production rules. All are integer comparisons, so any engine agrees.
RULES: tuple[Rule, ...] = (
    Rule("few_words", lambda s: s.n_words < 50),
    Rule("repeated_windows", lambda s: 100 * s.n_repeat_words > 50 * s.n_words),
    Rule("symbols", lambda s: 10 * s.n_symbols > s.n_words),
    Rule("word_length", lambda s: s.word_chars > 15 * s.n_words or s.word_chars < 2 * s.n_words),
    Rule("duplicate_lines", lambda s: 2 * s.n_dup_lines > len(s.lines)),
    Rule("upper_case", lambda s: s.n_upper > s.n_lower),
    Rule("digits", lambda s: 10 * s.n_digits > 3 * s.word_chars),
)


@dataclass(frozen=True)
class Cascade:
    """Rules in the order in which they run."""

    rules: tuple[Rule, ...]

    def first_failing(self, stats: TextStats) -> str | None:
        for rule in self.rules:
            if rule.rejects(stats):
                return rule.name
        return None


def order_by_benefit(rows: Sequence[tuple[Sequence[bool], Sequence[float]]], n_rules: int) -> list[int]:
    """Greedy order: most rejections per second among the rows still alive."""
    alive, left, order = list(rows), list(range(n_rules)), []
    while left:

        def benefit(k: int) -> tuple[float, float]:
            cost = sum(r[1][k] for r in alive) / max(1, len(alive)) + 1e-9
            return sum(r[0][k] for r in alive) / cost, -cost

        best = max(left, key=benefit)
        left.remove(best)
        order.append(best)
        alive = [r for r in alive if not r[0][best]] or alive
    return order


def fit_cascade(docs: DataFrame, rules: Sequence[Rule] = RULES) -> Cascade:
    """Order ``rules`` by what they reject and cost on a sample of ``docs``.

    The sample is bounded by ``SAMPLE_ROWS`` rows of at most ``SAMPLE_CHARS``
    characters; an empty sample leaves the given order.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    sample = (
        docs.select(text.alias("text"))
        .where(F.length("text") <= SAMPLE_CHARS)
        .sample(False, SAMPLE_FRACTION, 7)
        .limit(SAMPLE_ROWS)
        .collect()
    )
    rows = []
    for (value,) in sample:
        rejects, costs = [], []
        for rule in rules:
            stats = TextStats(value)
            began = time.perf_counter()
            rejects.append(bool(rule.rejects(stats)))
            costs.append(time.perf_counter() - began)
        rows.append((rejects, costs))
    order = order_by_benefit(rows, len(rules)) if rows else range(len(rules))
    return Cascade(tuple(rules[k] for k in order))


def filter_quality(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with all their columns.

    Null and empty texts have no words and go. Repeated rows are judged alike.
    """
    cascade = fit_cascade(docs, rules)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            verdict = [cascade.first_failing(TextStats(t)) is None for t in texts_of(batch)]
            yield batch.filter(pa.array(verdict, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


REPORT_SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long,"
    " n_repeat_words long, base_failed boolean, kept boolean"
)


def quality_report(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row for each document: the base counts and the verdict.

    Null or empty text: all counts 0, ``base_failed`` true, ``kept`` false. A null
    doc_id stays null; repeated rows give repeated results; an empty table gives no rows. Other columns take no part.
    """
    cascade = fit_cascade(docs, rules)

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for text in texts_of(batch):
                s = TextStats(text)
                failed = s.n_words < 50 or 100 * s.n_repeat_words > 50 * s.n_words
                kept = not failed and cascade.first_failing(s) is None
                out.append((s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat_words, failed, kept))
            columns = list(zip(*out)) if out else [()] * 7
            types = [pa.int64()] * 5 + [pa.bool_()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), *(pa.array(c, t) for c, t in zip(columns, types))],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
            )

    return docs.select("doc_id", "text").mapInArrow(report, REPORT_SCHEMA)


#: DuckDB: the same counts and rules. A word's windows are compared within its text.
REPORT_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), t AS (
  SELECT rid, doc_id, text,
         list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(text, chr(10)), lambda x: NOT regexp_full_match(x, '[\x20\x09-\x0D]*')) AS l
  FROM d
), n AS (
  SELECT rid, doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l)::BIGINT AS n_lines,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
         length(regexp_replace(text, '[^a-z]', '', 'g')) AS n_lower,
         length(regexp_replace(text, '[^0-9]', '', 'g')) AS n_digits
  FROM t
), g AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM t)
), m AS (
  SELECT rid, i FROM g QUALIFY count(*) OVER (PARTITION BY rid, g) > 1
), r AS (
  SELECT rid, count(DISTINCT i + k)::BIGINT AS n_repeat_words
  FROM m, (VALUES (0), (1), (2)) AS s(k) GROUP BY rid
), b AS (
  SELECT n.*, coalesce(n_repeat_words, 0) AS n_repeat_words FROM n LEFT JOIN r USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words
            OR 10 * n_symbols > n_words OR word_chars > 15 * n_words OR word_chars < 2 * n_words
            OR 2 * n_dup_lines > n_lines OR n_upper > n_lower
            OR 10 * n_digits > 3 * word_chars) AS kept
FROM b
"""
