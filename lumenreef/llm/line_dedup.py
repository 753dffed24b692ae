"""Line dedup by a deletion-neighbourhood join.

Two lines are alike if one word inserted, deleted or replaced turns one into the
other (A-Z lower-cased, words between ASCII white space). A line emits hashed keys of itself
and of its one-word deletions; alike lines meet in a key, where the deletions are at the
same place or one of the lines is the key itself. The earliest line of a key takes the
others with it, after the edit distance is verified on the words. So a key is a minimum,
however many lines share it, and never a list of pairs.

Of two alike lines one half (of the shorter one's length) is untouched. So only lines that
share the hash of a half with another line emit anything, and a line that shares one half
emits the deletions in the other only. This filter loses no partner.

A line of several sentences is also cut into units: sentences, short ones joined with the
next, long ones cut after words chosen by their hash. So the number of edits grows with the
line, and a passage that stands in longer lines meets itself. Every word of such a line is in
one unit; whole lines and units meet each other.

A line or unit is removed if an earlier one, by doc_id, line number and then unit (the
whole line first), equals it or is alike. Of a line that loses units the rest stays.
Units need ``MIN_WORDS`` words. Whole lines of fewer, where one word would be too loose
a bound, take part as exact copies from ``exact_words`` words on.

Hashes are sums of word hashes times powers of an odd number, modulo 2 ** 64, so the hash of
any stretch of words, also of one without a word in it, is a difference of prefix sums, and a
line's neighbourhood takes a few numpy steps. Texts are read twice and only small rows
are shuffled: first hashes of units and of their halves, to know which repeat; then
the units that have one of these. Two bitmaps tell a task which units may have one; their size
is bounded, a unit let through in error costs a row and is dropped by a join, and nothing is lost.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lumenreef.llm._arrow import slices, texts_of
from lumenreef.llm._scratch import Scratch

MIN_WORDS = 8
#: Words from which a line takes part as an exact copy in the registered query and the pipeline.
EXACT_WORDS = 1
#: Words after which a unit without a sentence end is cut at the next chosen word; at ``MIN_WORDS`` less than twice as many it ends anywhere.
UNIT_WORDS = 40
#: One in so many words is chosen for a cut.
CUT_EVERY = 8
#: A place in a document is (line number << UNIT_BITS) + unit; unit 0 is the whole line.
UNIT_BITS = 24
#: Least and largest number of bits of a bitmap (32 MB), and bits of its size for each value in it.
SKETCH_LOW, SKETCH_HIGH, SKETCH_EACH = 1 << 20, 1 << 28, 16
#: Each value sets the bits that its number names from these places on.
SKETCH_SHIFTS = (0, 18, 36)
#: Units (or keys) that a task reduces together before it emits rows.
CHUNK = 1 << 18
#: Bytes of a word beyond which it is hashed by itself.
LONG_WORD = 256
#: Words for which tables of powers are kept.
KEPT = 1 << 21
_LAST = (1 << 63) - 1


def line_words(line: bytes) -> list[bytes]:
    return line.lower().split()


_STOPS, _QUOTES = (b".", b"!", b"?", "…".encode(), "。".encode()), (b'"', b"'", b")", "”".encode(), "»".encode())
_ENDS = tuple(e + q for e in _STOPS for q in (b"", *_QUOTES))
_END_BYTES = frozenset(e[-1] for e in _ENDS)


def cuts(start: int, stops: Iterable[int], chosen: Callable[[int], bool], min_words: int = MIN_WORDS) -> list[int]:
    """Where the units of a line end whose first word is word ``start``; none if the line is one unit.

    ``stops`` are the ends of its sentences and, last, its own; ``chosen(k)`` tells whether word ``k``
    is chosen for a cut. A unit ends with the first sentence that gives it ``min_words`` words, so two
    lines that hold one passage are cut alike after its first sentence of that length.
    A shorter rest belongs to the last unit.
    """
    found: list[int] = []
    end = start
    for end in stops:
        while end - start > UNIT_WORDS:
            stop = min(end, start + 2 * UNIT_WORDS - min_words)
            start = next((k for k in range(start + UNIT_WORDS, stop) if chosen(k - 1)), stop)
            found.append(start)
        if end - start >= min_words:
            found.append(end)
            start = end
    if len(found) > 1:
        found[-1] = end
        return found
    return []


def units(words: Sequence[bytes], min_words: int = MIN_WORDS) -> list[tuple[int, int]]:
    """First and end word of each unit of a line; none if the line is one unit."""
    ends = [k for k, w in enumerate(words, 1) if w[-1] in _END_BYTES and w.endswith(_ENDS)]
    found = cuts(0, [*ends, len(words)], lambda k: zlib.crc32(words[k]) % CUT_EVERY == 0, min_words)
    return list(zip([0, *found], found))


def parts(line: bytes, min_words: int = MIN_WORDS) -> list[tuple[int, list[bytes]]]:
    """Number and words of the line (0) and of its units (1 and on)."""
    words = line_words(line)
    return [(0, words), *((k, words[a:b]) for k, (a, b) in enumerate(units(words, min_words), 1))]


def cut_out(text: str, gone: Iterable[int], min_words: int = MIN_WORDS) -> tuple[str, int]:
    """``text`` without the lines and units at the places ``gone``, and the number of lines that went whole."""
    lost: dict[int, set[int]] = {}
    for place in gone:
        lost.setdefault(place >> UNIT_BITS, set()).add(place & ((1 << UNIT_BITS) - 1))
    lines = text.split("\n")
    kept = []
    for k, line in enumerate(lines):
        mine = lost.get(k, ())
        if 0 in mine:
            continue
        if mine:
            raw = line.encode("utf-8", "replace")
            starts = [m.start() for m in re.finditer(rb"\S+", raw)] + [len(raw)]
            found = [(starts[a], starts[b]) for i, (a, b) in enumerate(units(line_words(raw), min_words), 1) if i in mine]
            for a, b in reversed(found):
                raw = raw[:a] + raw[b:] if b < len(raw) else raw[:a].rstrip()
            if not raw.strip():
                continue
            line = raw.decode()
        kept.append(line)
    return "\n".join(kept), len(lines) - len(kept)


def without(text: str, gone: Iterable[int], min_words: int = MIN_WORDS) -> str:
    """``text`` without the lines and units at the places ``gone``."""
    return cut_out(text, gone, min_words)[0]


def within_one(a: list[bytes], b: list[bytes]) -> bool:
    """True if the edit distance of two word lists is at most 1."""
    if abs(len(a) - len(b)) > 1:
        return False
    p = 0
    while p < min(len(a), len(b)) and a[p] == b[p]:
        p += 1
    if len(a) == len(b):
        return a[p + 1 :] == b[p + 1 :]
    if len(a) > len(b):
        a, b = b, a
    return a[p:] == b[p + 1 :]


# Hashes of stretches of words.

_U = np.uint64
_WORD_BASES = (0xD1342543DE82EF93, 0xAF251AF3B0F025B7)


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that changes about half of the bits for any change of one."""
    x = x + _U(salt * 0x9E3779B97F4A7C15 + 0x2545F4914F6CDD1D & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Powers:
    """Powers of an odd base and of its inverse modulo 2 ** 64; long tables are not kept."""

    def __init__(self, base: int) -> None:
        self.bases = base, pow(base, -1, 1 << 64)
        self.kept = [np.ones(1, np.uint64)] * 2

    def __call__(self, n: int, inverse: bool = False) -> np.ndarray:
        table = self.kept[inverse]
        if len(table) < n:
            steps = np.full(max(n, min(2 * n, KEPT)), self.bases[inverse], np.uint64)
            steps[0] = 1
            table = np.multiply.accumulate(steps)
            if n <= KEPT:
                self.kept[inverse] = table
        return table[:n]


_WORDS = tuple(map(_Powers, _WORD_BASES))
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LAST_BYTES = np.zeros(256, bool)
_LAST_BYTES[list(_END_BYTES)] = True


class Words:
    """The words of several texts, with the hashes of all stretches of them.

    ``line`` numbers the lines of all texts through; a stretch is a first and an end word.
    """

    def __init__(self, texts: Sequence[str]) -> None:
        raw = [t.encode("utf-8", "replace").lower() for t in texts]
        self.lines_before = np.cumsum([0, *(t.count(b"\n") + 1 for t in raw)])
        self.raw = b"\n".join(raw)
        self.bytes = np.frombuffer(self.raw, np.uint8)
        space = np.ones(len(self.raw) + 2, bool)
        space[1:-1] = _SPACE[self.bytes]
        edges = np.flatnonzero(space[1:] != space[:-1])  # words begin and end by turns
        self.start, self.end = edges[::2].copy(), edges[1::2].copy()
        self.line = np.searchsorted(np.flatnonzero(self.bytes == 10), self.start)
        self._sums = None

    @property
    def sums(self) -> list[np.ndarray]:
        """Prefix sums of the words' hashes, for each of the two bases."""
        if self._sums is None:
            words = self._word_hashes()
            values = (words, mixed(words, 1))
            self._sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(v * power(len(v)), dtype=np.uint64)]) for v, power in zip(values, _WORDS)]
        return self._sums

    def _word_hashes(self) -> np.ndarray:
        size = self.end - self.start
        padded = np.frombuffer(self.raw + bytes(8), np.uint8)
        eight = np.ndarray(len(self.raw) + 1, "<u8", padded.data, strides=(1,))  # the eight bytes from each place on
        out = mixed(size.astype(np.uint64))
        left = np.flatnonzero(size <= LONG_WORD)
        at = self.start[left]
        while len(left):
            rest = self.end[left] - at
            out[left] = mixed(out[left] ^ (eight[at] & _FIRST_BYTES[np.minimum(rest, 8)]))
            more = rest > 8
            left, at = left[more], at[more] + 8
        for k in np.flatnonzero(size > LONG_WORD).tolist():
            out[k] = xxhash.xxh64_intdigest(self.raw[self.start[k] : self.end[k]])
        return out

    def hashes(self, first: np.ndarray, end: np.ndarray, k: int = 0) -> np.ndarray:
        """The ``k``-th hash of each stretch."""
        sums = self.sums[k]
        return (sums[end] - sums[first]) * _WORDS[k](len(sums), True)[first]

    def hashes_without(self, first: np.ndarray, end: np.ndarray, gone: np.ndarray, k: int = 0) -> np.ndarray:
        """The ``k``-th hash of each stretch without its word ``gone``, equal to that of the same words in a row."""
        sums, back = self.sums[k], _WORDS[k](len(self.sums[k]) + 1, True)
        return (sums[gone] - sums[first]) * back[first] + (sums[end] - sums[gone + 1]) * back[first + 1]

    def sentence_ends(self) -> np.ndarray:
        """The words with which a sentence ends."""
        words = np.flatnonzero(_LAST_BYTES[self.bytes[self.end - 1]]) if len(self.end) else np.zeros(0, np.int64)
        length = (self.end - self.start)[words]

        def tail(back: np.ndarray, ending: bytes) -> np.ndarray:
            """Whether ``ending`` stands before the last ``back`` bytes of each word."""
            hit = length >= back + len(ending)
            at = self.end[words] - back
            for k, byte in enumerate(reversed(ending), 1):
                hit &= self.bytes[np.where(hit, at - k, 0)] == byte
            return hit

        none = np.zeros(len(words), np.int64)
        quoted = none.copy()
        for q in _QUOTES:
            quoted[tail(none, q)] = len(q)
        found = np.zeros(len(words), bool)
        for e in _STOPS:
            found |= tail(quoted, e) | tail(none, e)
        return words[found]

    def units(self, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, end word and unit number of all lines with a word (0) and their units (1 and on)."""
        heads = np.flatnonzero(np.diff(self.line, prepend=-1))
        tails = np.append(heads[1:], len(self.line))[: len(heads)]
        sizes = tails - heads
        stops = self.sentence_ends() + 1
        lows, highs = np.searchsorted(stops, heads, "right"), np.searchsorted(stops, tails)
        first, end, number = [heads], [tails], [np.zeros(len(heads), np.int64)]
        f, e, u = [], [], []
        some = np.flatnonzero((sizes >= 2 * min_words) & ((highs > lows) | (sizes > UNIT_WORDS)))
        listed = stops.tolist()

        def chosen(k: int) -> bool:
            return zlib.crc32(self.raw[self.start[k] : self.end[k]]) % CUT_EVERY == 0

        for head, tail, low, high in zip(*(x[some].tolist() for x in (heads, tails, lows, highs))):
            found = cuts(head, [*listed[low:high], tail], chosen, min_words)
            if found:
                f.append(head)
                f += found[:-1]
                e += found
                u += range(1, len(found) + 1)
        first.append(np.array(f, np.int64))
        end.append(np.array(e, np.int64))
        number.append(np.array(u, np.int64))
        return np.concatenate(first), np.concatenate(end), np.concatenate(number)


class _Halves:
    """Keys of the halves of lines, by classes of length.

    Class ``c`` holds lines of ``bounds[c]`` to ``bounds[c + 1]`` words, the last included, so two
    lines that differ by a word share a class. Its halves are those of ``bounds[c]`` words.
    """

    def __init__(self, min_words: int) -> None:
        bounds = [max(2, min_words)]
        while bounds[-1] < 1 << 40:
            bounds.append(bounds[-1] * 3 // 2)
        self.bounds = np.array(bounds)

    def split(self, sizes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(class, words of its first half, words of its last) of each line; then the same for the class below, -1 if none."""
        own = np.searchsorted(self.bounds, sizes, "right") - 1
        below = np.where((own > 0) & (self.bounds[own] == sizes), own - 1, -1)
        least = [(c, self.bounds[np.maximum(c, 0)]) for c in (own, below)]
        return [(c, n // 2, n - n // 2) for c, n in least]

    def keys(self, words: Words, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Four keys of each line as a row (first and last half, of either class), and which there are."""
        keys, there = np.zeros((len(first), 4), np.uint64), np.ones((len(first), 4), bool)
        for j, (c, p, q) in enumerate(self.split(end - first)):
            salt = mixed(c.astype(np.uint64))
            keys[:, 2 * j] = mixed(words.hashes(first, first + p) + salt, 2)
            keys[:, 2 * j + 1] = mixed(words.hashes(end - q, end) + salt, 3)
            there[:, 2 * j] = there[:, 2 * j + 1] = c >= 0
        return keys, there

    def places(self, sizes: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end place of the deletions of lines for whose keys the bits of ``mask`` are set."""
        low, high = sizes.copy(), np.zeros_like(sizes)
        for j, (_, p, q) in enumerate(self.split(sizes)):
            whole, last = mask >> 2 * j & 1 == 1, mask >> 2 * j + 1 & 1 == 1
            low, high = np.where(whole, np.minimum(low, p), low), np.where(whole, sizes, high)
            low, high = np.where(last, 0, low), np.where(last, np.maximum(high, sizes - q), high)
        return low, high


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _chunks(batches: Iterable[pa.RecordBatch], of: Callable[[pa.RecordBatch], tuple[np.ndarray, ...] | None], least: int = CHUNK) -> Iterator[tuple[np.ndarray, ...]]:
    """The arrays that ``of`` makes of slices of ``batches``, joined until they have ``least`` rows."""
    held: list[tuple[np.ndarray, ...]] = []
    rows = 0
    for batch in slices(batches):
        if batch.num_rows and (found := of(batch)) is not None and len(found[0]):
            held.append(found)
            rows += len(found[0])
        if rows >= least:
            yield tuple(map(np.concatenate, zip(*held)))
            held, rows = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def _order(doc_id: Column) -> Column:
    """The place of a document in the order; rows without id come last."""
    return F.coalesce(doc_id, F.lit(_LAST)).cast("long")


class Sketch:
    """A Bloom filter of some numbers, on the driver and in a broadcast; 32 MB at most."""

    def __init__(self, numbers: DataFrame) -> None:
        """``numbers`` has one long column without nulls and is cheap to read twice."""
        (column,) = numbers.columns
        self.bits = SKETCH_LOW
        wanted = min(SKETCH_HIGH, SKETCH_EACH * numbers.count())
        while self.bits < wanted:
            self.bits *= 2
        slots = [F.shiftrightunsigned(column, k).bitwiseAND(F.lit(self.bits - 1)) + 1 for k in SKETCH_SHIFTS]
        number = F.explode(F.array(*slots)).alias("n")  # bucket k holds 32768 (k - 1) + 1 and on
        found = (
            numbers.select(number)
            .groupBy(F.bitmap_bucket_number("n").alias("k"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("set"))
            .collect()  # at most SKETCH_HIGH / 32768 rows of 4 KB
        )
        out = bytearray(self.bits // 8)
        for k, part in found:
            out[4096 * (k - 1) : 4096 * k] = part
        self.shared = numbers.sparkSession.sparkContext.broadcast(bytes(out))

    def __getstate__(self):
        return self.bits, self.shared

    def __setstate__(self, state):
        self.bits, self.shared = state

    def may_have(self, values: np.ndarray) -> np.ndarray:
        """For each of ``values`` (64 bits), False if it is not among the numbers."""
        values = values.astype(np.uint64, copy=False)
        table, found = np.frombuffer(self.shared.value, np.uint8), np.ones(values.shape, bool)
        for k in SKETCH_SHIFTS:
            slot = values >> _U(k) & _U(self.bits - 1)
            found &= table[(slot >> _U(3)).astype(np.int64)] >> (slot & _U(7)).astype(np.uint8) & 1 == 1
        return found


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_at`` (its place in the order) and ``_t`` (hash of its text), which name a document."""
    return docs.withColumns({"_at": _order(F.col("doc_id")), "_t": F.xxhash64("doc_id", "text")})


def _some(keyed: DataFrame, sketch: Sketch, inside: bool = True) -> DataFrame:
    """The rows of ``keyed`` whose document may be (``inside``) or is not in the sketch of names.

    Only a hash of the document's name goes to Python, not its text.
    """

    @F.pandas_udf("boolean")
    def listed(values: pd.Series) -> pd.Series:
        return pd.Series(sketch.may_have(values.to_numpy().view(np.uint64)) == inside)

    return keyed.where(listed(F.xxhash64("_at", "_t")))


def _shared(docs: DataFrame, min_words: int, exact_words: int) -> DataFrame:
    """``key, repeats, open``: hashes of lines and units that occur more than once, and halves that different ones share.

    A half goes with the hash of its line as ``name``, so it is open if it has two names; a line's own hash has none.
    """
    halves = _Halves(min_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of(batch: pa.RecordBatch):
            words = Words(texts_of(batch))
            first, end, number = words.units(min_words)
            some = end - first >= np.where(number == 0, min(exact_words, min_words), min_words)
            first, end = first[some], end[some]
            loose = end - first >= min_words
            keys, there = np.zeros((len(first), 4), np.uint64), np.zeros((len(first), 4), bool)
            keys[loose], there[loose] = halves.keys(words, first[loose], end[loose])
            return words.hashes(first, end), keys, there

        for h, keys, there in _chunks(batches, of):
            h, one, times = np.unique(h, return_index=True, return_counts=True)
            keys, there = keys[one], there[one]
            own = np.concatenate([h, h[times > 1]])
            key = np.concatenate([own, keys[there]])
            name = np.concatenate([own, np.repeat(h, 4)[there.ravel()]]).view(np.int64)
            yield pa.RecordBatch.from_arrays([_signed(key), pa.array(name, mask=np.arange(len(key)) < len(own))], names=["key", "name"])

    rows = docs.select("text").mapInArrow(run, "key long, name long")
    found = rows.groupBy("key").agg((F.count_if(F.col("name").isNull()) > 1).alias("repeats"), (F.min("name") < F.max("name")).alias("open"))
    return found.select("key", "repeats", F.coalesce("open", F.lit(False)).alias("open")).where("repeats OR open")


_UNITS = "h long, g long, at long, t long, line long, again boolean, keys array<long>, words binary"


def _units(docs: DataFrame, repeated: Sketch, open_: Sketch, min_words: int, exact_words: int) -> DataFrame:
    """Rows without ``words`` for units that may repeat, and rows with them for units that may have an open half.

    ``again``: the same text stands at an earlier place of the chunk, so the unit is a copy for
    certain. Of the others a chunk gives one row for each text.
    """
    halves = _Halves(min_words)
    schema = pa.schema([*((c, pa.int64()) for c in ("h", "g", "at", "t", "line")), ("again", pa.bool_()), ("keys", pa.list_(pa.int64())), ("words", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of(batch: pa.RecordBatch):
            words = Words(texts_of(batch))
            first, end, number = words.units(min_words)
            line = words.line[first]
            doc = np.searchsorted(words.lines_before, line, "right") - 1
            place = (line - words.lines_before[doc] << UNIT_BITS) + number
            at, t = (batch.column(c).to_numpy()[doc] for c in ("_at", "_t"))
            sizes = end - first
            h = words.hashes(first, end)
            cut = np.zeros(int(words.lines_before[-1]), bool)  # lines of more than one unit
            cut[line[number > 0]] = True
            copies = np.flatnonzero(np.where(number == 0, (sizes >= exact_words) & ~cut[line], True) & repeated.may_have(h))
            loose = np.flatnonzero(sizes >= min_words)
            keys, there = halves.keys(words, first[loose], end[loose])
            there &= open_.may_have(keys)
            near = there.any(axis=1)
            loose, keys, there = loose[near], keys[near], there[near]
            bare = words.raw
            texts = np.empty(len(loose), object)
            texts[:] = [b" ".join(bare[a:b].split()) for a, b in zip(words.start[first[loose]].tolist(), words.end[end[loose] - 1].tolist())]
            rows = np.concatenate([copies, loose])
            none = np.zeros((len(copies), 4), np.uint64)
            blank = np.empty(len(copies), object)
            return (
                h[rows], words.hashes(first[rows], end[rows], 1), at[rows], t[rows], place[rows],
                np.concatenate([none, np.where(there, keys, _U(0))]), np.concatenate([blank, texts]),
            )

        for h, g, at, t, line, keys, texts in _chunks(batches, of):
            near = np.array([x is not None for x in texts], bool)
            order = np.lexsort((line, t, at, g, h, near))
            h, g, at, t, line, keys, texts, near = (x[order] for x in (h, g, at, t, line, keys, texts, near))
            head = np.ones(len(h), bool)
            head[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1]) | (near[1:] != near[:-1])
            top = np.flatnonzero(head)[np.cumsum(head) - 1]  # the earliest row of the same text
            later = (at != at[top]) | (t != t[top]) | (line != line[top])
            keep = head | (later & ~near)
            listed = pa.FixedSizeListArray.from_arrays(_signed(keys[keep].ravel()), 4).cast(pa.list_(pa.int64()))
            columns = [_signed(h[keep]), _signed(g[keep]), *(pa.array(x[keep]) for x in (at, t, line)), pa.array(later[keep]), listed, pa.array(texts[keep], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return _keyed(docs).select("_at", "_t", "text").mapInArrow(run, _UNITS)


_OWN = ("at", "t", "line")


def _place(prefix: str = "") -> Column:
    return F.struct(*[F.col(prefix + c).alias(c) for c in _OWN])


def _candidates(units: DataFrame, open_: DataFrame) -> DataFrame:
    """``at, t, line, words, mask``: the earliest place of each text with an open half; bits of ``mask`` tell which."""
    near = units.where("words IS NOT NULL")
    keys = near.select("h", "g", F.posexplode("keys").alias("k", "key")).where("key <> 0").distinct()
    masks = keys.join(open_, "key", "left_semi").groupBy("h", "g").agg(F.bit_or(F.expr("shiftleft(1, k)")).alias("mask"))
    # A chunk has one row for each text, so the long rows need no sort before they are shuffled.
    texts = near.select("h", "g", *_OWN, "words").repartition("h", "g").groupBy("h", "g").agg(F.min(_place()).alias("own"), F.min("words").alias("words"))
    return texts.join(masks, ["h", "g"]).select("own.*", "words", "mask")


_VARIANTS = "v long, w long, i int, at long, t long, line long, f_at long, f_t long, f_line long"


def _variants(texts: DataFrame, min_words: int) -> DataFrame:
    """The keys of each text: of itself (``i`` -1), and without word ``i`` of the half that is not shared.

    Of rows of one key and ``i`` a chunk gives the earliest; the others are alike to it, which is
    their partner ``f_at, f_t, f_line``.
    """
    halves = _Halves(min_words)
    names = [x.split()[0] for x in _VARIANTS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of(batch: pa.RecordBatch):
            words = Words([x.decode("utf-8", "replace") for x in batch.column("words").to_pylist()])
            first = np.flatnonzero(np.diff(words.line, prepend=-1))
            end = np.append(first[1:], len(words.line))
            low, high = halves.places(end - first, batch.column("mask").to_numpy())
            many = high - low
            row = np.repeat(np.arange(len(first)), many)
            i = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + low[row]
            v, w = (np.concatenate([words.hashes(first, end, k), words.hashes_without(first[row], end[row], first[row] + i, k)]) for k in (0, 1))
            row, i = np.concatenate([np.arange(len(first)), row]), np.concatenate([np.full(len(first), -1), i])
            return v, w, i.astype(np.int32), *(batch.column(c).to_numpy()[row] for c in _OWN)

        for v, w, i, at, t, line in _chunks(batches, of, 2 * CHUNK):
            order = np.lexsort((line, t, at, i, w, v))
            v, w, i, at, t, line = (x[order] for x in (v, w, i, at, t, line))
            head = np.ones(len(v), bool)
            head[1:] = (v[1:] != v[:-1]) | (w[1:] != w[:-1]) | (i[1:] != i[:-1])
            top = np.flatnonzero(head)[np.cumsum(head) - 1]
            known = ~head & (i >= 0)
            # These have their partner and need not meet others of the key: any number spreads them.
            v = np.where(known, mixed(np.arange(len(v), dtype=np.uint64) + v, 5), v)
            partners = [pa.array(x[top], mask=~known) for x in (at, t, line)]
            yield pa.RecordBatch.from_arrays([_signed(mixed(v)), _signed(w), *map(pa.array, (i, at, t, line)), *partners], names=names)

    return texts.select(*_OWN, "words", "mask").mapInArrow(run, _VARIANTS)


def _alike(texts: DataFrame, min_words: int) -> DataFrame:
    """``at, t, line`` of the ``texts`` that have an earlier one within one edit."""
    # One sort serves both windows.
    rows = _variants(texts, min_words).repartition("v", "w").sortWithinPartitions("v", "w", "i").withColumn("own", _place())
    key, same = W.partitionBy("v", "w"), W.partitionBy("v", "w", "i")
    itself = F.min(F.when(F.col("i") < 0, F.col("own"))).over(key)
    met = F.when(F.col("i") < 0, F.min("own").over(key)).otherwise(F.least(F.min("own").over(same), itself))
    known = F.when(F.col("f_at").isNotNull(), _place("f_"))
    pairs = rows.select("own", F.coalesce(known, met).alias("first")).where(F.col("first") < F.col("own"))
    pairs = pairs.groupBy("own").agg(F.min("first").alias("first"))
    named = texts.select(_place().alias("own"), "words")
    paired = pairs.join(named, "own").join(named.select(F.col("own").alias("first"), F.col("words").alias("by_words")), "first")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            two = zip(batch.column("words").to_pylist(), batch.column("by_words").to_pylist())
            flags = [within_one(a.split(b" "), b.split(b" ")) for a, b in two]
            yield batch.select([*_OWN]).filter(pa.array(flags, pa.bool_()))

    return paired.select("own.*", "words", "by_words").mapInArrow(verify, "at long, t long, line long")


def removals(docs: DataFrame, scratch: Scratch, min_words: int = MIN_WORDS, exact_words: int = MIN_WORDS) -> DataFrame:
    """``_at, _t, gone``: the places of the lines and units to remove, for documents that lose any."""
    shared = scratch.keep(_shared(docs, min_words, exact_words), "shared")
    repeats, open_ = Sketch(shared.where("repeats").select("key")), shared.where("open").select("key")
    rows = scratch.keep(_units(docs, repeats, Sketch(open_), min_words, exact_words), "units")
    texts = scratch.keep(_candidates(rows, open_), "candidates")
    alike = _alike(texts, min_words)
    copies = rows.where("words IS NULL").select("h", "g", "again", *_OWN)
    low = F.min(_place()).over(W.partitionBy("h", "g"))
    later = copies.where("NOT again").select(*_OWN, low.alias("low")).where(F.col("low") < _place())
    every = alike.unionByName(copies.where("again").select(*_OWN)).unionByName(later.select(*_OWN))
    gone = every.groupBy(F.col("at").alias("_at"), F.col("t").alias("_t")).agg(F.collect_set("line").alias("gone"))
    gone = scratch.keep(gone, "gone")
    scratch.drop(shared, rows, texts)
    return gone


def _cut(docs: DataFrame, min_words: int, exact_words: int) -> DataFrame:
    """``dedup_lines`` with one more column, the last: the number of lines that went."""
    # Other columns get plain names on the way, so none can clash with those made here.
    own = docs.columns
    names = [n if n in ("doc_id", "text") else f"extra_{k}" for k, n in enumerate(own)]
    plain = docs.toDF(*names)
    keyed = _keyed(plain)
    gone = removals(plain, Scratch(docs.sparkSession), min_words, exact_words)
    sketch = Sketch(gone.select(F.xxhash64("_at", "_t").alias("name")))
    hit = _some(keyed, sketch).join(gone, ["_at", "_t"], "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            went = [0] * len(texts)
            for k, lost in enumerate(batch.column("gone").to_pylist()):
                if lost:
                    texts[k], went[k] = cut_out(texts[k], lost, min_words)
            at = batch.schema.get_field_index("text")
            batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type)).select(names)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(went, pa.int64())], names=[*names, "went"])

    nothing = F.lit(0).cast("long")
    changed = hit.mapInArrow(cut, plain.withColumn("went", nothing).schema)
    if "n_chars" in own:
        length = names[own.index("n_chars")]
        changed = changed.withColumn(length, F.length("text").cast(plain.schema[length].dataType))
    whole = _some(keyed, sketch, inside=False).select(*names, nothing.alias("went"))
    return changed.unionByName(whole)


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, exact_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the repeated and alike lines and units cut out of ``text``.

    Lines of ``exact_words`` to ``min_words`` - 1 words go if they equal an earlier line.
    All rows and columns stay, also where no line is left (an empty text); a column
    ``n_chars`` is set to the new length. Null texts stay null. Rows with one doc_id and
    text are one document, so repeated rows lose the same lines; rows without doc_id
    come last in the order, and those of them with one text count as one document.
    Of several rows with one doc_id and other texts, the smaller text hash comes first.
    An empty table stays empty.
    """
    return _cut(docs, min_words, exact_words).drop("went").toDF(*docs.columns)


def dedup_report(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, n_lines, n_kept (n_lines less the lines that went whole), text (what is left).

    A null text has no lines, an empty text one, which stays. A null doc_id keeps its row,
    repeated rows repeat, an empty table gives no rows.
    """
    breaks = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    lines = F.coalesce(breaks + 1, F.lit(0)).cast("long")
    cut = _cut(docs.select("doc_id", "text", lines.alias("n_lines")), MIN_WORDS, EXACT_WORDS).toDF("doc_id", "text", "n_lines", "went")
    return cut.select("doc_id", "n_lines", (F.col("n_lines") - F.col("went")).alias("n_kept"), "text")
