"""Periodic runs of words: seeds on the diagonals of a document, verified and extended.

A run is a stretch of consecutive words with smallest period ``q`` that is at least
``max(12, 2 q)`` words long and cannot be extended. It matches itself ``q`` words on (on the
diagonal of lag ``q``) over at least ``max(12 - q, q)`` words. Lags are taken by octaves: a lag
of ``[k, 2 k)`` guarantees an overlap of ``k`` words, so ``k``-grams are indexed, exactly (each gram
is named by its halves), and pairs of occurrences of one gram with such a lag are the seeds.

Occurrences that follow each other within ``k / 2`` words lie in one run of a smaller period,
which a lower octave has found; they form a cluster, and its first is its head. Were neither
gram of a run's first seed a head, both would continue a word to the left with equal periods,
and the run could be extended there. So pairs with a head, from different clusters, hold the first
seed of every run. A gram has at most four heads within ``2 k`` words, and the clusters of small
period ``d`` have ``d`` heads each, so an octave has as many seeds as words, up to a constant, and
the work grows with ``n log n`` in a document's words, also where one word fills it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lumenreef.llm._arrow import slices, texts_of

#: Least number of words in a run.
LEAST_WORDS = 12
#: Words compared in the first step of an extension; each step takes twice as many as the one before.
FIRST_BLOCK = 32


def _paired(names: np.ndarray, shift: int) -> np.ndarray:
    """Names of the stretches that two named stretches ``shift`` words apart make up."""
    if len(names) <= shift:
        return names[:0]
    pairs = names[:-shift].astype(np.int64) * (int(names.max()) + 1) + names[shift:]
    return np.unique(pairs, return_inverse=True)[1]


def _octaves(words: np.ndarray, least: int) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """First and last lag, gram length and the name of the gram at each word, while some gram repeats."""
    grams, k = words, 1
    small = least // 2  # lags up to here guarantee an overlap of as many words
    while k < small:
        step = min(k, small - k)
        grams, k = _paired(grams, step), k + step
    low, high = 1, small
    while len(grams) and int(grams.max()) + 1 < len(grams):
        yield low, high, k, grams
        step = 1 if low == 1 else k
        grams, k = _paired(grams, step), k + step
        low, high = high + 1, 2 * k - 1


def _seeds(grams: np.ndarray, k: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and lag of the pairs of equal grams that have a head, by lag and start."""
    order = np.argsort(grams, kind="stable")
    name = grams[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = name[1:] != name[:-1]
    head = fresh.copy()
    head[1:] |= np.diff(order) > k // 2
    cluster = np.cumsum(head)
    group = np.cumsum(fresh) - 1
    alone = np.bincount(group) == 1
    key = group * (len(grams) + 2 * high + 2) + order + high + 1  # sorted; a window does not reach the next group
    heads = np.flatnonzero(head & ~alone[group])
    starts, lags = [], []
    for side in (1, -1):
        near, far = (key[heads] + side * x for x in ((low, high) if side > 0 else (high, low)))
        first, last = np.searchsorted(key, near, "left"), np.searchsorted(key, far, "right")
        count = last - first
        mine = np.repeat(heads, count)
        other = np.repeat(first - np.cumsum(count) + count, count) + np.arange(len(mine))
        if low > 1:
            apart = cluster[mine] != cluster[other]
            mine, other = mine[apart], other[apart]
        a, b = order[mine], order[other]
        starts.append(np.minimum(a, b))
        lags.append(np.abs(a - b))
    start, lag = np.concatenate(starts), np.concatenate(lags)
    by = np.lexsort((start, lag))
    return start[by], lag[by]


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """How many first elements of two arrays agree, by blocks of doubling size."""
    n, at, block = min(len(a), len(b)), 0, FIRST_BLOCK
    while at < n:
        same = a[at : at + block][: n - at] == b[at : at + block][: n - at]
        if not same.all():
            return at + int(same.argmin())
        at, block = at + len(same), 2 * block
    return n


def find_runs(words: np.ndarray, least: int = LEAST_WORDS) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of a sequence of word numbers, by start, then period."""
    found: dict[tuple[int, int], int] = {}
    for low, high, k, grams in _octaves(words, least):
        start, lag = _seeds(grams, k, low, high)
        need = np.maximum(least - lag, lag)
        # Two grams cover the overlap that the lag needs: without both there is no run at this seed.
        last = start + need - k
        fits = last + lag < len(grams)
        start, lag, last = start[fits], lag[fits], last[fits]
        sure = grams[last] == grams[last + lag]
        covered: dict[int, int] = {}  # by lag: the end of the furthest stretch that matches itself
        for i, q in zip(start[sure].tolist(), lag[sure].tolist()):
            if i < covered.get(q, 0):
                continue
            end = i + _agree(words[i:], words[i + q :])
            begin = i - _agree(words[:i][::-1], words[: i + q][::-1][: i or 1]) if i else 0
            covered[q] = end
            # Lags come in rising order, so a stretch keeps its smallest period.
            found.setdefault((begin, end + q), q)
    return sorted(((a, b - a, q) for (a, b), q in found.items()), key=lambda run: (run[0], run[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """True for each of ``n`` words that no run repeats: a run keeps its first period only."""
    depth = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return np.cumsum(depth[:-1]) == 0


def _numbered(words: list[bytes]) -> np.ndarray:
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def _words(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").split()  # of bytes: at ASCII white space only


def mark_runs(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with ``runs``, an array of start, length and period (words), and ``collapsed``, the text without repeats.

    Of each run the words of its first period stay, joined by single spaces; white space is
    collapsed with them. A null or empty text has no runs and an empty ``collapsed``. Rows are
    handled one by one, so null ids, ties and repeated rows make no difference. Columns named ``runs`` or
    ``collapsed`` are replaced; others pass through.
    """
    docs = docs.drop("runs", "collapsed")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
        for batch in slices(batches):
            runs, texts = [], []
            for text in texts_of(batch):
                words = _words(text)
                mine = find_runs(_numbered(words), least)
                runs.append([dict(zip(("start", "length", "period"), r)) for r in mine])
                texts.append(b" ".join(w for w, keep in zip(words, kept_words(len(words), mine).tolist()) if keep).decode("utf-8"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(runs, kind), pa.array(texts, pa.string())], names=[*batch.schema.names, "runs", "collapsed"])

    run = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    added = [T.StructField("runs", T.ArrayType(run)), T.StructField("collapsed", T.StringType())]
    return docs.mapInArrow(mark, T.StructType([*docs.schema.fields, *added]))


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """The places from which the words of a document come where the report plants a run in it, else None."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % p)


REPORT_SCHEMA = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def runs_report(docs: DataFrame) -> DataFrame:
    """One row for each document: number of runs, the longest, and digests of all runs and of the collapsed text.

    In about a tenth of the documents (``planted``) words are replaced by a periodic stretch
    first. Null and empty texts have no runs, null for the longest, and the digests of
    nothing. A null doc_id stays null and gets no planted run; repeated rows give repeated results. Of
    equally long runs the first counts, then the one of smaller period. An empty table gives no rows.
    """

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                words = _words(text)
                numbers = _numbered(words)
                places = planted(doc_id, len(words))
                if places is not None:
                    numbers, words = numbers[places], [words[i] for i in places.tolist()]
                runs = find_runs(numbers)
                keep = kept_words(len(words), runs)
                if runs:
                    start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2]))
                    longest = start, length, period, 1000 * length // period
                else:
                    longest = (None,) * 4
                listed = "".join(f"{a},{b},{q}\n" for a, b, q in runs)
                text = b" ".join(words) if not runs else b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])
                out.append((doc_id, len(runs), *longest, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text).hexdigest()))
            kinds = [pa.int64()] * 6 + [pa.string()] * 2
            names = [field.split()[0] for field in REPORT_SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 8, kinds)], names=names)

    return docs.select("doc_id", "text").mapInArrow(report, REPORT_SCHEMA)
