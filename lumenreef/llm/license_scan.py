"""License scans: fuzzy search for short notices.

A text is reduced to its lower-case words, joined by single spaces. A notice
that may be off by ``k`` edits is split into ``k + 1`` pieces; by the pigeonhole
principle one of them stands unchanged in any match, so an automaton over all
pieces finds every candidate place. A candidate is verified first exactly, then
by the ``regex`` library's bounded-error matching, which reports the span.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from lumenreef.llm._arrow import slices, texts_of

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_KEEP = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
_TABLE = bytes(c if c in _KEEP else c + 32 if c in _UPPER else 32 for c in range(256))
_WORD = regex.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


@dataclass(frozen=True)
class Notice:
    """A phrase of words, its label, and how many edits a match may have.

    ``base`` marks phrases whose exact places are counted on their own. ``names`` are words of a phrase that
    tell it from others and are short beside the edits allowed: in a match each stands unchanged, alone or joined with its
    neighbours, or, unless ``exact``, as a word with the same first letter that is off by one edit or one swap of neighbours.
    """

    label: str
    phrase: str
    edits: int
    base: bool = False
    names: tuple[str, ...] = ()
    exact: bool = False

    def named_in(self, text: str) -> bool:
        """True if all names stand in a matched text."""
        if self.exact:
            return all(f" {name} " in f" {text} " for name in self.names)
        return all(name in text or any(one_slip(name, word) for word in text.split()) for name in self.names)


def one_slip(a: str, b: str) -> bool:
    """True if two words with one first letter differ by at most one edit, or by a swap of two neighbours."""
    if abs(len(a) - len(b)) > 1 or a[:1] != b[:1]:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    x, y = a[i:], b[i:]
    return x[1:] == y[1:] or x[1:] == y or x == y[1:] or (x[:2] == y[:2][::-1] and x[2:] == y[2:])


# Notice phrases in common use, with their labels.
NOTICES: tuple[Notice, ...] = (
    Notice("mit", "mit license", 1, base=True, names=("mit",), exact=True),
    Notice("apache", "apache license", 1, base=True, names=("apache",)),
    Notice("gpl", "general public license", 2, base=True, names=("general", "public")),
    Notice("mit", "released under the mit license", 3, names=("mit",)),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 6),
    Notice("apache", "licensed under the apache license version 2 0", 4),
    Notice("gpl", "this work is licensed under the gnu general public license", 5),
    Notice("lgpl", "gnu lesser general public license", 3),
    Notice("bsd", "redistribution and use in source and binary forms", 4),
    Notice("mpl", "mozilla public license", 2, names=("mozilla",)),
    Notice("cc-by-nc", "licensed under cc by nc", 2, names=("cc by nc",), exact=True),
    Notice("cc", "creative commons attribution", 2, names=("creative", "commons")),
    Notice("isc", "permission to use copy modify and or distribute this software for any purpose", 6),
    Notice("all-rights-reserved", "all rights reserved", 2, names=("rights", "reserved")),
)


@dataclass(frozen=True)
class Hit:
    """A match: its notice, first and last word (from 0), and number of edits."""

    notice: Notice
    first: int
    last: int
    edits: int

    @property
    def similarity(self) -> float:
        return 1.0 - self.edits / len(self.notice.phrase)


def normalised(text: str) -> tuple[int, str]:
    """The number of words, and the words between single spaces (also at both ends)."""
    words = text.encode("utf-8", "replace").translate(_TABLE).split()
    return len(words), f" {b' '.join(words).decode('utf-8')} " if words else ""


class Scanner:
    """Finds all places of all notices in normalised texts."""

    def __init__(self, notices: Sequence[Notice] = NOTICES) -> None:
        self.notices = tuple(notices)
        self.patterns = []
        pieces: dict[str, list[tuple[int, int]]] = {}
        for k, notice in enumerate(self.notices):
            padded = f" {notice.phrase} "
            parts = notice.edits + 1
            for j in range(parts):
                a, b = len(padded) * j // parts, len(padded) * (j + 1) // parts
                pieces.setdefault(padded[a:b], []).append((k, a))
            self.patterns.append(regex.compile(f"(?e)(?<= )(?=[^ ])(?:{regex.escape(notice.phrase)}){{e<={notice.edits}}}(?<=[^ ])(?= )"))
        self.seeds = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.seeds.add_word(piece, (len(piece), places))
        self.seeds.make_automaton()

    def hits(self, norm: str) -> list[Hit]:
        """Matches in the order of notices and places; exact ones have no edits.

        Exact places are all reported. Fuzzy matches of one notice do not overlap,
        begin and end at word ends, and leave out what an exact place covers.
        """
        starts: dict[int, set[int]] = {}
        for end, (size, places) in self.seeds.iter(norm):
            for k, offset in places:
                starts.setdefault(k, set()).add(end + 1 - size - offset)
        found: list[Hit] = []
        spaces = np.flatnonzero(np.frombuffer(norm.encode("utf-32-le"), "<u4") == 32) if starts else None
        for k in sorted(starts):
            notice = self.notices[k]
            padded = f" {notice.phrase} "
            exact = sorted(s for s in starts[k] if s >= 0 and norm.startswith(padded, s))
            found += [self._hit(spaces, notice, s + 1, s + len(padded) - 1, 0) for s in exact]
            for a, b in _windows(starts[k].difference(exact), len(padded), notice.edits, len(norm)):
                for m in self.patterns[k].finditer(norm, a, b):
                    s, e = m.span()
                    if not notice.named_in(m.group()):
                        continue
                    before = bisect_left(exact, e) - 1  # the last exact place that starts before the end
                    if before < 0 or s >= exact[before] + len(padded) - 1:
                        found.append(self._hit(spaces, notice, s, e, sum(m.fuzzy_counts)))
        return found

    @staticmethod
    def _hit(spaces: np.ndarray, notice: Notice, start: int, end: int, edits: int) -> Hit:
        first, last = np.searchsorted(spaces, [start, end]).tolist()
        return Hit(notice, first - 1, last - 1, edits)


def _windows(starts: Iterable[int], size: int, edits: int, length: int) -> Iterator[tuple[int, int]]:
    """Merged stretches that hold every possible match near the given starts."""
    low = high = None
    for s in sorted(starts):
        a, b = max(0, s - edits), min(length, s + size + edits)
        if high is not None and a <= high:
            high = max(high, b)
            continue
        if high is not None:
            yield low, high
        low, high = a, b
    if high is not None:
        yield low, high


def _joined(labels: Iterable[str]) -> str:
    return ",".join(sorted(set(labels)))


SPAN_SCHEMA = "doc_id long, label string, notice string, start_char long, end_char long, first_word long, last_word long, edits int"


def license_spans(docs: DataFrame, notices: Sequence[Notice] = NOTICES) -> DataFrame:
    """One row for each match, with its span in characters of the original text.

    Null and empty texts have no rows; repeated documents give repeated rows.
    """

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(notices)
        for batch in slices(batches):
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                hits = scanner.hits(normalised(text)[1])
                at = [m.span() for m in _WORD.finditer(text)] if hits else []
                out += [
                    (doc_id, h.notice.label, h.notice.phrase, at[h.first][0], at[h.last][1], h.first, h.last, h.edits)
                    for h in hits
                ]
            if out:
                types = [pa.int64(), pa.string(), pa.string(), *[pa.int64()] * 4, pa.int32()]
                names = [x.split()[0] for x in SPAN_SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return docs.select("doc_id", "text").mapInArrow(spans, SPAN_SCHEMA)


REPORT_SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long,"
    " base_labels string, labels string, score double"
)


def license_report(docs: DataFrame, notices: Sequence[Notice] = NOTICES) -> DataFrame:
    """One row for each document with its base places, labels and score.

    ``n_base`` counts exact places of base phrases, ``first_word`` and ``last_word``
    are their smallest and largest start (null without any). ``score`` is the
    best similarity of a match, 0 without any. Null and empty texts have no words. A null
    doc_id keeps its row, repeated rows repeat, an empty table gives no rows.
    """

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(notices)
        for batch in slices(batches):
            out = []
            for text in texts_of(batch):
                n_words, norm = normalised(text)
                hits = scanner.hits(norm) if norm else []
                base = [h for h in hits if h.notice.base and not h.edits]
                places = [h.first for h in base]
                out.append((
                    n_words, len(places), min(places, default=None), max(places, default=None),
                    _joined(h.notice.label for h in base), _joined(h.notice.label for h in hits),
                    max((h.similarity for h in hits), default=0.0),
                ))
            types = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64()]
            names = [x.split()[0] for x in REPORT_SCHEMA.split(", ")]
            columns = [pa.array(c, t) for c, t in zip(zip(*out), types)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *columns], names=names)

    return docs.select("doc_id", "text").mapInArrow(report, REPORT_SCHEMA)
