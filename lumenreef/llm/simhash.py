"""SimHash near-duplicates by multi-index hashing.

Fingerprints are cut into segments. Two fingerprints that differ in at most ``radius``
bits differ in at most ``radius // m`` bits of some of ``m`` segments. A ``Layout`` is a
number of segments and how their small Hamming balls are looked up:

* ``reach`` 1: a table holds the values, and each fingerprint looks up its value with one
  bit cleared. Of a pair that differs in one bit one side has the bit set, so set bits do.
* ``reach`` 2: a table holds the whole ball of radius 1 about each value. Two values that
  differ in two bits have a value of both balls between them.

Wider segments are rarer to share by chance, so ``layout_for`` takes more rows a
fingerprint for larger tables; every layout finds every link. All work is
on distinct fingerprints; exact copies join their class by equality.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenreef.llm._arrow import slices, texts_of
from lumenreef.llm._graph import Forest, components
from lumenreef.llm._scratch import Scratch, materialise

SHINGLE = 4
RADIUS = 4
#: Rows of a look-up key beyond which the key's rows are dealt into chunk pairs.
HOT_ROWS = 20_000
#: Fingerprint pairs compared in one numpy step.
PAIRS = 1 << 21
#: Comparisons taken to cost as much as a row of the look-up table that is written, shuffled and sorted.
COMPARISONS_A_ROW = 200


class Layout(NamedTuple):
    """``parts`` segments in each of which up to ``reach`` bits may differ."""

    parts: int
    reach: int

    @property
    def segments(self) -> list[tuple[int, int]]:
        """(first bit, bits) of each segment."""
        cuts = [64 * k // self.parts for k in range(self.parts + 1)]
        return [(a, b - a) for a, b in zip(cuts, cuts[1:])]

    def cost(self, n: int) -> float:
        """Expected work for each of ``n`` even fingerprints, in rows."""
        work = 0.0
        for _, width in self.segments:
            table, looked_up = ((1, 0), (1, width / 2), (width + 1, 0))[self.reach]
            met = table * (table / 2 + looked_up) * n / 2.0**width
            work += table + looked_up + met / COMPARISONS_A_ROW
        return work


def layout_for(n: int, radius: int) -> Layout:
    """The cheapest layout that finds every link of ``n`` fingerprints."""
    fit = [Layout(m, radius // m) for m in range(1, max(1, radius) + 1) if radius // m <= 2]
    return min(fit, key=lambda x: x.cost(n))


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a text; 0 for a text without words."""
    words = text.encode("utf-8", "replace").lower().split()  # of bytes: ASCII case and white space only
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), last.tolist())), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp`` (fp: the fingerprint's 64 bits as a signed long), a row for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = np.array([fingerprint(t) for t in texts_of(batch)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(fps)], names=["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def _keys(layout: Layout):
    """The rows of each fingerprint and segment: its table entries, then its look-ups (``probe``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1 << 14):
            fp = batch.column("fp").to_numpy()
            bits = fp.view(np.uint64)
            for k, (first, width) in enumerate(layout.segments):
                value = (bits >> np.uint64(first)) & np.uint64((1 << width) - 1)
                keys, owners, probes = [value], [fp], [np.zeros(len(fp), bool)]
                for j in range(width if layout.reach else 0):
                    bit = np.uint64(1 << j)
                    some = np.full(len(fp), True) if layout.reach == 2 else value & bit != 0
                    keys.append(value[some] ^ bit)
                    owners.append(fp[some])
                    probes.append(np.full(len(keys[-1]), layout.reach == 1))
                key = np.concatenate(keys) | np.uint64(k << 32)  # of two segments or more none is longer
                columns = [key.view(np.int64), np.concatenate(owners), np.concatenate(probes)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "fp", "probe"])

    return run


def _links(key: np.ndarray, fp: np.ndarray, probe: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Links within groups of equal key (sorted, table rows first), without closing cycles."""
    n = len(key)
    bits = fp.view(np.uint64)
    bounds = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    ends = np.repeat(np.append(bounds[1:], n), np.diff(np.append(bounds, n)))
    left = np.flatnonzero(~probe & (ends - np.arange(n) > 1))
    todo = np.cumsum(ends[left] - left - 1)
    forest = Forest()
    at = 0
    while at < len(left):
        done = todo[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(todo, done + PAIRS, "right")))
        rows = left[at:to]
        many = ends[rows] - rows - 1
        a = np.repeat(rows, many)
        b = np.arange(len(a)) - np.repeat(np.cumsum(many) - many, many) + a + 1
        near = np.bitwise_count(bits[a] ^ bits[b]) <= radius
        for x, y in zip(fp[a[near]].tolist(), fp[b[near]].tolist()):
            if x != y and forest.joins(x, y):
                yield x, y
        at = to


def _verify(radius: int):
    names = ["a", "b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def flush(parts):
            found = list(_links(*(np.concatenate(c) for c in zip(*parts)), radius)) if parts else []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "fp", "probe"))
            held.append(cols)
            size += len(cols[0])
            if size < 1 << 18:
                continue
            whole = [np.concatenate(c) for c in zip(*held)]
            cut = int(np.searchsorted(whole[0], whole[0][-1]))  # the last key may go on
            yield from flush([tuple(c[:cut] for c in whole)] if cut else [])
            held = [tuple(c[cut:] for c in whole)]
            size = len(held[0][0])
        yield from flush(held)

    return run


def _spread(keys: DataFrame) -> DataFrame:
    """Give the rows of very large keys to pairs of chunks, each with a key of its own.

    A key with ``c`` chunks has c (c + 1) / 2 chunk pairs, and a row goes to the c of
    them that hold its chunk, so any two rows of the key still meet in one task.
    """
    hot = keys.groupBy("key").count().where(F.col("count") > HOT_ROWS)
    hot = hot.select("key", F.ceil(F.col("count") / (HOT_ROWS // 2)).cast("int").alias("chunks"))
    mine = F.pmod(F.xxhash64("fp"), F.col("chunks"))
    pair = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    dealt = keys.join(hot, "key", "left")
    plain = dealt.where("chunks IS NULL").select("key", "fp", "probe")
    split = (
        dealt.where("chunks IS NOT NULL")
        .select("key", "fp", "probe", mine.alias("i"), pair.alias("j"))
        .select(F.xxhash64("key", F.least("i", "j"), F.greatest("i", "j")).alias("key"), "fp", "probe")
    )
    return plain.unionByName(split)


def links(fps: DataFrame, radius: int = RADIUS, layout: Layout | None = None, scratch: Scratch | None = None) -> DataFrame:
    """``a, b``: links between distinct fingerprints that keep every connection.

    ``fps`` has one row for each distinct ``fp``. Every pair of table matches is
    compared in full; a link that closes a cycle within a task is not returned. The layout is
    the cheapest one for the number of rows, unless it is given. The table of keys is kept in ``scratch``.
    """
    scratch = scratch or Scratch(fps.sparkSession)
    layout = layout or layout_for(fps.count(), radius)
    keys = _spread(scratch.keep(fps.select("fp").mapInArrow(_keys(layout), "key long, fp long, probe boolean"), "keys"))
    parts = keys.repartition("key").sortWithinPartitions("key", "probe")
    return parts.mapInArrow(_verify(radius), "a long, b long")


def groups(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``fp, root`` for each fingerprint that has a link; root is the smallest fingerprint reachable.

    ``fps`` has one row for each distinct ``fp`` and is read more than once.
    """
    scratch = Scratch(fps.sparkSession)
    roots = components(scratch.keep(links(fps, radius, scratch=scratch), "links"))
    scratch.clear()
    return roots.withColumnRenamed("node", "fp")


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``doc_id, fp, component_id`` for each document; component_id is the smallest doc_id reachable.

    Null and empty texts have fingerprint 0 and are linked like any other. A
    null doc_id keeps its row and never names a component unless all ids of it are
    null. Repeated rows repeat. An empty table gives no rows.
    """
    prints = materialise(fingerprints(docs), "fingerprints")
    classes = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "classes")
    rooted = classes.join(groups(classes, radius), "fp", "left")
    rooted = rooted.select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(lowest, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def simhash_report(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, fingerprint (16 hex digits), component_id."""
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_representatives(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The row with the smallest doc_id of each component, with all columns.

    Of rows that share a kept doc_id, all stay; rows without doc_id have no
    identity to compare and all stay.
    """
    kept = near_duplicates(docs, radius).where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    return docs.where("doc_id IS NULL").unionByName(docs.join(kept, "doc_id", "left_semi"))
