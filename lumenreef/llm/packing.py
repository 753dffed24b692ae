"""Packing documents into windows of tokens by non-negative least squares.

A document is cut at multiples of the window; what matters then is the histogram
of piece lengths, at most ``window`` numbers whatever the corpus. Combinations of
up to three lengths that fill a window exactly are enumerated, repeat counts are
solved against the histogram by non-negative least squares and rounded, and what
is left is packed greedily: first by largest fits that fill a window, then end to
end with cuts. The last, partly filled window becomes sequences whose lengths are
powers of two, which need no padding. Pieces find their place from their rank
among the pieces of the same length.
"""

from __future__ import annotations

import base64
import json
import os
import re
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lumenreef.llm._arrow import slices, texts_of
from lumenreef.llm._scratch import materialise

WINDOW = 2048
END_ID = 1
#: Numbers of earlier pieces are broadcast up to this size; beyond, pieces and numbers meet in a merge join.
BROADCAST_BYTES = 64 << 20
#: Steps of the least-squares solver.
SOLVER_STEPS = 150

#: Texts of these characters are split alike by both tokenizer libraries.
_PLAIN = re.compile("[\t\n\r -~¡-ɏ]*")


class Tokenizer:
    """Token ids of a byte-level BPE vocabulary, as the ``tokenizers`` library gives them.

    ``tiktoken`` runs the same vocabulary several times faster; it takes the texts
    whose characters both libraries classify alike, and ``tokenizers`` the rest. A text that
    holds the content of one of the vocabulary's added tokens (``<|endoftext|>``) also goes
    to ``tokenizers``, which gives it that token's id.
    """

    def __init__(self, json_path: str | None = None, ranks_path: str | None = None) -> None:
        import public_tokenizers
        import tiktoken

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._json = json_path or public_tokenizers.path("byte_bpe_50k.json")
        with open(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._fast = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._slow = None
        with open(self._json, encoding="utf-8") as f:
            contents = [t["content"] for t in json.load(f).get("added_tokens") or []]
        self._added = re.compile("|".join(map(re.escape, contents)) or "(?!)")

    def ids(self, text: str) -> list[int]:
        if _PLAIN.fullmatch(text) and not self._added.search(text):
            return self._fast.encode_ordinary(text)
        if self._slow is None:
            from tokenizers import Tokenizer as Library

            self._slow = Library.from_file(self._json)
        return self._slow.encode(text, add_special_tokens=False).ids


def token_pieces(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Pieces of at most ``window`` tokens of each document, end id included.

    ``block`` and ``rank``: the task that made the piece, and the piece's place among
    that task's pieces of the same length. ``ids`` holds little-endian 32-bit numbers.
    """
    schema = "block long, doc_id long, start long, length int, rank long, doc_tokens long, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer()
        block = TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)
        for batch in slices(batches):
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                ids = np.array([*tokenizer.ids(text), END_ID], "<u4")
                for start in range(0, len(ids), window):
                    piece = ids[start : start + window]
                    out.append((block, doc_id, start, len(piece), int(seen[len(piece)]), len(ids), piece.tobytes()))
                    seen[len(piece)] += 1
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            names = ["block", "doc_id", "start", "length", "rank", "doc_tokens", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """Rows of two or three of ``lengths`` that add up to ``window``, largest first, 0 for none."""
    have = np.zeros(window + 1, bool)
    have[lengths] = True
    have[0] = True  # the third may be absent
    rows = []
    for a in lengths[lengths < window][::-1].tolist():
        b = np.arange((window - a + 1) // 2, min(a, window - a) + 1)
        c = window - a - b
        ok = (b > 0) & have[b] & have[c]
        rows.append(np.stack([np.full(int(ok.sum()), a), b[ok], c[ok]], axis=1))
    return np.concatenate(rows) if rows else np.empty((0, 3), np.int64)


def solve(combos: np.ndarray, histogram: np.ndarray, steps: int = SOLVER_STEPS) -> np.ndarray:
    """Non-negative repeat counts x that minimise |A x - histogram|, by accelerated projected gradient."""
    if not len(combos):
        return np.zeros(0)
    n, goal = len(histogram), histogram.astype(float)
    goal[0] = 0

    def times(x: np.ndarray) -> np.ndarray:
        y = sum(np.bincount(combos[:, k], x, n) for k in range(3))
        y[0] = 0
        return y

    def back(y: np.ndarray) -> np.ndarray:
        return y[combos[:, 0]] + y[combos[:, 1]] + y[combos[:, 2]]

    v = np.ones(len(combos))
    for _ in range(12):
        v = back(times(v))
        norm = np.linalg.norm(v)
        v /= norm
    step = 1 / (1.05 * norm)
    x = z = np.zeros(len(combos))
    t = 1.0
    for _ in range(steps):
        ahead = np.maximum(0, z - step * back(times(z) - goal))
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = ahead + (t - 1) / t_next * (ahead - x)
        x, t = ahead, t_next
    return x


@dataclass(frozen=True)
class Plan:
    """Where the r-th piece of a length goes; all arrays are bounded by the window alone."""

    window: int
    pointer: np.ndarray  # of each length, into the next three
    first_rank: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    covered: np.ndarray  # pieces of each length that the combinations take
    rest_base: np.ndarray  # tokens of the rest before each length
    rest_sequence: int
    rest_ends: tuple[int, ...]  # of the power-of-two sequences, from the last full window
    rest_full: int  # tokens of the rest in full windows

    def places(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start in the piece, length, sequence, offset) of each part of a piece."""
        if rank < self.covered[length]:
            a, b = self.pointer[length], self.pointer[length + 1]
            k = a + int(np.searchsorted(self.first_rank[a:b], rank, "right")) - 1
            return [(0, length, int(self.sequence[k] + rank - self.first_rank[k]), int(self.offset[k]))]
        at = int(self.rest_base[length] + (rank - self.covered[length]) * length)
        out, done = [], 0
        while done < length:
            if at < self.rest_full:
                sequence, offset = divmod(at, self.window)
                room = self.window - offset
            else:
                k = next(i for i, end in enumerate(self.rest_ends) if at - self.rest_full < end)
                begin = self.rest_ends[k - 1] if k else 0
                sequence, offset = self.rest_full // self.window + k, at - self.rest_full - begin
                room = self.rest_ends[k] - begin - offset
            size = min(room, length - done)
            out.append((done, size, self.rest_sequence + sequence, offset))
            done, at = done + size, at + size
        return out


def _round(combos: np.ndarray, x: np.ndarray, left: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Whole repeat counts, fractions carried on to the next combination; takes from ``left``."""
    chosen, carry = [], 0.0
    for k in np.argsort(-x, kind="stable")[: int((x > 1e-9).sum())].tolist():
        carry += float(x[k])
        if carry < 1:
            continue
        combo = tuple(v for v in combos[k].tolist() if v)
        n = min(int(carry), *(int(left[v]) // combo.count(v) for v in combo))
        carry -= int(carry)
        if n:
            chosen.append((combo, n))
            for v in combo:
                left[v] -= n
    return chosen


def _greedy(left: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """Largest fits over the remaining histogram that fill a window; takes from ``left``."""
    chosen = []
    for a in range(window - 1, 0, -1):
        while left[a]:
            combo, room, mine = [a], window - a, left.copy()
            mine[a] -= 1
            while room:
                fits = np.flatnonzero(mine[1 : room + 1])
                if not len(fits):
                    break
                b = int(fits[-1]) + 1
                combo.append(b)
                mine[b] -= 1
                room -= b
            if room:
                break
            n = min(int(left[v]) // combo.count(v) for v in combo)
            chosen.append((tuple(combo), n))
            for v in combo:
                left[v] -= n
    return chosen


def plan_packing(histogram: Mapping[int, int], window: int = WINDOW) -> Plan:
    """The plan for ``histogram`` (pieces of each length from 1 to ``window``)."""
    left = np.zeros(window + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    chosen: list[tuple[tuple[int, ...], int]] = []
    if left[window]:
        chosen.append(((window,), int(left[window])))
        left[window] = 0
    combos = combinations(np.flatnonzero(left), window)
    chosen += _round(combos, solve(combos, left), left)
    chosen += _greedy(left, window)
    slots: list[list[tuple[int, int, int]]] = [[] for _ in range(window + 1)]
    used = np.zeros(window + 1, np.int64)
    sequence = 0
    for combo, n in chosen:
        offset = 0
        for v in combo:
            slots[v].append((int(used[v]), sequence, offset))
            used[v] += n
            offset += v
        sequence += n
    flat = np.array([s for row in slots for s in row], np.int64).reshape(-1, 3)
    tokens = left * np.arange(window + 1)
    rest_base = tokens[::-1].cumsum()[::-1] - tokens  # longest first
    total = int(tokens.sum())
    tail = total % window
    powers = [1 << k for k in range(tail.bit_length() - 1, -1, -1) if tail >> k & 1]
    return Plan(
        window, np.concatenate([[0], np.cumsum([len(s) for s in slots])]), flat[:, 0], flat[:, 1], flat[:, 2],
        used, rest_base, sequence, tuple(np.cumsum(powers).tolist()), total - tail,
    )


def _bases(counts: DataFrame, window: int) -> DataFrame:
    """``block, bases``: for each length the number of its pieces in the blocks before."""
    earlier = W.partitionBy("length").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    found = counts.select("block", "length", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("base"))

    def dense(key: tuple, table: pa.Table) -> pa.Table:
        bases = np.zeros(window + 1, np.int64)
        bases[table.column("length").to_numpy()] = table.column("base").to_numpy()
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "bases": pa.array([bases], pa.list_(pa.int64()))})

    return materialise(found.groupBy("block").applyInArrow(dense, "block long, bases array<long>"), "bases")


PACKED_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>"


def pack(docs: DataFrame, window: int = WINDOW, with_ids: bool = True) -> DataFrame:
    """One row for each piece: its ids and its place in a sequence.

    Sequences hold ``window`` tokens, but for at most log2(window) last ones, whose
    lengths are powers of two; none needs padding. Null and empty texts are one
    end id. Repeated rows are packed each; an empty table gives no rows. Without
    ``with_ids`` the column ``ids`` is left out, and only its checksum stays. A null doc_id
    stays null; other columns take no part.
    """
    pieces = materialise(token_pieces(docs, window), "pieces")
    counts = materialise(pieces.groupBy("block", "length").count(), "lengths")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    shared = docs.sparkSession.sparkContext.broadcast(plan_packing(histogram, window))
    bases = _bases(counts, window)
    small = bases.count() * 8 * (window + 1) <= BROADCAST_BYTES
    placed = pieces.join(F.broadcast(bases) if small else bases.hint("merge"), "block")
    placed = placed.withColumn("rank", F.col("rank") + F.get("bases", F.col("length")))
    names = [x.split()[0] for x in PACKED_SCHEMA.split(", ")]
    schema = PACKED_SCHEMA if with_ids else PACKED_SCHEMA.rpartition(", ")[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        for batch in slices(batches):
            out = []
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "start", "length", "rank", "doc_tokens", "ids"))
            for doc_id, start, length, rank, doc_tokens, ids in zip(*columns):
                for at, size, sequence, offset in plan.places(length, rank):
                    part = ids[4 * at : 4 * (at + size)]
                    row = (doc_id, start + at, size, zlib.crc32(part), doc_tokens, sequence, offset)
                    out.append((*row, np.frombuffer(part, "<u4")) if with_ids else row)
            if out:
                types = [*[pa.int64()] * 7, pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names[: len(out[0])])

    return placed.select("doc_id", "start", "length", "rank", "doc_tokens", "ids").mapInArrow(run, schema)


def packing_report(docs: DataFrame) -> DataFrame:
    """``pack`` of ``docs`` with the checksums of the ids only."""
    return pack(docs, with_ids=False)
