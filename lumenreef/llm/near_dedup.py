"""Near-duplicates by SimHash and MinHash, checked on the exact sets of word shingles.

Two texts are alike if the Jaccard similarity of their sets of five-word shingles is
0.8 or more. Candidates share a band. A group of SimHash fingerprints that links of few
differing bits connect (``simhash.groups``, by multi-index hashing) is a band. As two alike
texts can differ in more bits than it looks up (some 10 of 64 at 0.8), MinHash adds bands:
at least one of ``BANDS`` bands of ``ROWS`` minima agrees with probability
1 - (1 - 0.8 ** 5) ** 20 = 0.9996, and more above 0.8. Every candidate is then compared on
the exact sets, so no pair below the bound is linked. All work is on distinct sets; texts
with equal sets join their class by equality.

Each set is first compared with the smallest of each of its bands only. Where that leaves
a band with several components, its sets meet in one task, or, if they are many, in a task
for each two chunks of them. Alike sets share one of their rarest hashes there (``linked``),
only such sets are compared, and only links that join two components leave the task: pairs
of a band are never listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenreef.llm import simhash
from lumenreef.llm._arrow import slices, texts_of
from lumenreef.llm._graph import Forest, components
from lumenreef.llm._scratch import Scratch

SHINGLE = 5
#: The least similarity of a link, as numerator and denominator.
SIMILARITY = (4, 5)
BANDS, ROWS = 20, 5
#: Shingles whose minima are taken in one numpy step.
CHUNK = 2048
#: Hashes of a chunk of a band, on average (16 MB); two chunks meet in a task.
BAND_HASHES = 1 << 21

_RNG = np.random.default_rng(5)
_FACTOR = _RNG.integers(0, 1 << 32, BANDS * ROWS, np.uint32) | np.uint32(1)
_TERM = _RNG.integers(0, 1 << 32, BANDS * ROWS, np.uint32)


def shingles(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; a shorter text is one shingle."""
    words = text.encode("utf-8", "replace").lower().split()  # of bytes: ASCII case and white space only
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = (ends - sizes)[:n].tolist()
    last = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, last)), np.uint64, n))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of the set's minima; none for an empty set."""
    if not len(hashes):
        return np.zeros(0, np.uint64)
    low = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    x = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    for at in range(0, len(x), CHUNK):
        np.minimum(low, (x[at : at + CHUNK, None] * _FACTOR + _TERM).min(axis=0), out=low)
    return np.array([xxhash.xxh64_intdigest(low[ROWS * k : ROWS * (k + 1)].tobytes(), k) for k in range(BANDS)], np.uint64)


def class_of(hashes: np.ndarray) -> int:
    """The name of a set, as a signed long; equal sets have equal names."""
    return xxhash.xxh64_intdigest(hashes.tobytes(), 3) - (1 << 63)


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """True if the similarity of two sets of hashes is at least ``SIMILARITY``."""
    up, down = SIMILARITY
    if down * min(len(a), len(b)) < up * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return down * both >= up * (len(a) + len(b) - both)


def _sketches(docs: DataFrame) -> DataFrame:
    """``doc_id, cls, fp, keys``: the set's name, the SimHash fingerprint and the set's band keys, a row for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = texts_of(batch)
            sets = [shingles(t) for t in texts]
            names = pa.array([class_of(s) for s in sets], pa.int64())
            prints = pa.array(np.array([simhash.fingerprint(t) for t in texts], np.uint64).view(np.int64))
            keys = pa.array([band_keys(s).view(np.int64) for s in sets], pa.list_(pa.int64()))
            columns = [batch.column("doc_id").cast(pa.int64()), names, prints, keys]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "cls", "fp", "keys"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, cls long, fp long, keys array<long>")


def _simhash_bands(prints: DataFrame, scratch: Scratch) -> DataFrame:
    """``cls, key``: a key for each group of linked fingerprints in ``prints(cls, fp)``, with all sets that have one of them."""
    fps = scratch.keep(prints.select("fp").distinct(), "fingerprints")
    found = prints.select("cls", "fp").distinct().join(simhash.groups(fps), "fp", "left")
    key = F.xxhash64(F.lit("simhash"), F.coalesce("root", "fp")).alias("key")
    bands = scratch.keep(found.select("cls", key).distinct(), "simhash-bands")
    scratch.drop(fps)
    return bands


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``cls, hashes``: the sets (as bytes) of the classes in ``wanted(cls, doc_id)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingles(t) for t in texts_of(batch)]
            # An id may have several texts; only the one that names the class counts.
            own = [(c, s.tobytes()) for c, s in zip(batch.column("cls").to_pylist(), sets) if class_of(s) == c]
            columns = zip(*own) if own else ([], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary()))], names=["cls", "hashes"])

    found = docs.select("doc_id", "text").join(wanted, "doc_id").select("cls", "text")
    return found.mapInArrow(run, "cls long, hashes binary").dropDuplicates(["cls"])


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The rows of ``pairs(a, b)`` whose sets are alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            two = zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())
            flags = [alike(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in two]
            yield batch.select(["a", "b"]).filter(pa.array(flags, pa.bool_()))

    both = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def linked(sets: list[np.ndarray], roots: list[int], sides: list[int]) -> Iterator[tuple[int, int]]:
    """Positions of alike sets, as links that join two of the components ``roots``; all are connected in the end.

    If there are two sides only sets of different sides are compared. With hashes in the order of their
    frequency, alike sets share one of the first ``n - ceil(n * SIMILARITY) + 1`` of their n hashes.
    """
    up, down = SIMILARITY
    order = sorted(range(len(sets)), key=lambda k: len(sets[k]))
    sizes = np.array([len(sets[k]) for k in order])
    side = np.array(sides)[order]
    across = len(set(sides)) > 1
    _, at, counts = np.unique(np.concatenate([sets[k] for k in order]), return_inverse=True, return_counts=True)
    rank = np.empty(len(counts), np.int64)
    rank[np.argsort(counts, kind="stable")] = np.arange(len(counts))
    # The first hashes of each set by rank, then by rank over all sets, members in order of size.
    member = np.repeat(np.arange(len(order)), sizes)
    rank = rank[at]
    by_member = np.lexsort((rank, member))
    ends = np.cumsum(sizes)
    place = np.arange(len(member)) - np.repeat(ends - sizes, sizes)
    first = by_member[place < np.repeat(sizes - -(-up * sizes // down) + 1, sizes)]
    first = first[np.lexsort((member[first], rank[first]))]
    rank, member = rank[first], member[first]
    starts = np.searchsorted(rank, rank, "left")
    later = np.flatnonzero(starts < np.arange(len(rank)))  # hashes that a smaller set has among its first
    later = later[np.argsort(member[later], kind="stable")]
    forest = Forest()
    for rows in np.split(later, np.flatnonzero(np.diff(member[later])) + 1):
        if not len(rows):
            continue
        k = int(member[rows[0]])
        others = np.unique(np.concatenate([member[s:e] for s, e in zip(starts[rows], rows)]))
        others = others[down * sizes[others] >= up * sizes[k]]
        if across:
            others = others[side[others] != side[k]]
        for other in others.tolist():
            x, y = order[other], order[k]
            if forest.find(roots[x]) != forest.find(roots[y]) and alike(sets[x], sets[y]):
                forest.joins(roots[x], roots[y])
                yield x, y


def _linked_bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``linked`` for each run of rows with equal ``key, lo, hi``."""
    held: list[tuple[int, int, int, np.ndarray]] = []
    of = None

    def flush() -> Iterator[pa.RecordBatch]:
        names, roots, sides, sets = zip(*held)
        found = [(names[x], names[y]) for x, y in linked(list(sets), list(roots), list(sides))]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

    for batch in batches:
        for part in slices([batch]):
            for row in part.to_pylist():
                if of != (group := (row["key"], row["lo"], row["hi"])):
                    if held:
                        yield from flush()
                    held, of = [], group
                held.append((row["cls"], row["root"], row["side"], np.frombuffer(row["hashes"], np.uint64)))
    if held:
        yield from flush()


def _links_left(held: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b``: links between the components that share a band of ``held(key, cls, root)``.

    A band with ``c`` chunks has c (c + 1) / 2 pairs of chunks, and a set goes to the c of them
    that hold its chunk, so any two sets of the band meet.
    """
    open_ = held.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
    members = held.join(open_, "key", "left_semi").join(sets.select("cls", (F.length("hashes") / 8).alias("size")), "cls")
    chunks = members.groupBy("key").agg(F.ceil(F.sum("size") / BAND_HASHES).cast("int").alias("chunks"))
    mine = F.pmod(F.xxhash64("cls"), F.col("chunks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    dealt = members.join(chunks, "key").select("key", "cls", "root", mine.alias("side"), other)
    dealt = dealt.select("key", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"), "side", "cls", "root")
    met = dealt.join(sets, "cls").repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    return met.select("key", "lo", "hi", "side", "cls", "root", "hashes").mapInArrow(_linked_bands, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, component_id`` for each document with an id; component_id is the smallest doc_id reachable.

    Null and empty texts have the empty set and are one class. Rows without doc_id
    have no identity to compare and are left out; repeated rows repeat.
    """
    scratch = Scratch(docs.sparkSession)
    prints = scratch.keep(_sketches(docs.where("doc_id IS NOT NULL")), "sketches")
    classes = scratch.keep(prints.groupBy("cls").agg(F.min("doc_id").alias("low"), F.first("keys").alias("keys")), "classes")
    groups = _simhash_bands(prints, scratch)
    keys = classes.select("cls", F.explode("keys").alias("key")).unionByName(groups)
    firsts = keys.groupBy("key").agg(F.min("cls").alias("first"), F.count("*").alias("n")).where("n > 1").select("key", "first")
    bands = scratch.keep(keys.join(firsts, "key"), "bands")
    wanted = classes.join(bands.select("cls").distinct(), "cls", "left_semi").select("cls", F.col("low").alias("doc_id"))
    sets = scratch.keep(_sets(docs, wanted), "sets")

    stars = bands.where(F.col("cls") != F.col("first")).select(F.col("cls").alias("a"), F.col("first").alias("b")).distinct()
    links = scratch.keep(_verified(stars, sets), "links")
    roots = scratch.keep(components(links), "roots")

    held = bands.join(roots.withColumnRenamed("node", "cls"), "cls", "left").select("key", "cls", F.coalesce("root", "cls").alias("root"))
    held = scratch.keep(held, "held")
    more = scratch.keep(_links_left(held, sets), "more-links")
    if not more.isEmpty():
        first, roots = roots, scratch.keep(components(links.unionByName(more)), "roots")
        scratch.drop(first)
    scratch.drop(groups, bands, sets, links, held, more)

    rooted = classes.join(roots.withColumnRenamed("node", "cls"), "cls", "left")
    rooted = rooted.select("cls", "low", F.coalesce("root", "cls").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(lowest, "root").select("cls", "component_id")
    return prints.join(named, "cls").select("doc_id", "component_id")


def keep_representatives(docs: DataFrame) -> DataFrame:
    """The row with the smallest doc_id of each component, with all columns.

    Of rows that share a kept doc_id, all stay; rows without doc_id all stay.
    """
    kept = near_duplicates(docs).where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    return docs.where("doc_id IS NULL").unionByName(docs.join(kept, "doc_id", "left_semi"))
