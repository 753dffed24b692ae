"""Approximate nearest neighbours by collision-counting hashing.

Each block of vectors has an index of sorted arrays, one for each random
projection. A query opens a narrow window around its own projection in every array;
a vector whose projection lies in at least ``THRESHOLD`` of the ``PROJECTIONS`` windows
is verified with its exact inner product. Windows widen by virtual rehashing, and only what
they gain is counted, until a vector as near as the k-th best found so far would have been met
with probability ``CERTAINTY``. Largest inner products become smallest distances by one more
coordinate that gives all vectors the same length.

An index block stays in one task and small blocks of queries come to it, so the vectors are
shuffled once and only the queries are copied, once for each index block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lumenreef.llm._scratch import materialise

PROJECTIONS = 160
THRESHOLD = 75
CERTAINTY = 0.85
#: Factor by which windows widen, and the first half-width as a share of the common length.
WIDEN, FIRST = 1.07, 0.4
#: Steps after which the windows are wider than any projection (0.4 * 1.07 ** 80 is over 80 lengths).
LEVELS = 80
#: Share of the queries that may stop before the level at which a query starts; these are walked again from the narrowest window.
EARLY = 0.05
#: Vectors of an index block and queries of a query block, on average.
BLOCK_ROWS, QUERY_ROWS = 16384, 512


def needed_width(projections: int = PROJECTIONS, threshold: int = THRESHOLD, certainty: float = CERTAINTY) -> float:
    """Half-width of a window, in units of distance, that makes ``threshold`` collisions as probable as ``certainty``."""

    def met(p: float) -> float:
        return sum(math.comb(projections, k) * p**k * (1 - p) ** (projections - k) for k in range(threshold, projections + 1))

    low, high = 0.0, 1.0
    for _ in range(50):
        p = (low + high) / 2
        low, high = (low, p) if met(p) >= certainty else (p, high)
    return NormalDist().inv_cdf((1 + high) / 2)


def scores_of(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, each summed from the first component to the last: equal vectors have equal scores anywhere."""
    return np.add.accumulate(vectors * query, axis=1)[:, -1]


class BlockIndex:
    """Sorted projection arrays of a block of vectors (rows of ``vectors``).

    ``scale`` is the largest component and ``length`` the largest length, in units of it, of all
    blocks' vectors; distances are taken in these units, so they cannot overflow.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, scale: float, length: float, seed: int = 3) -> None:
        self.ids, self.vectors, self.scale, self.length = ids, vectors, scale, length
        rng = np.random.default_rng(seed)
        self.directions = rng.normal(size=(PROJECTIONS, vectors.shape[1] + 1))
        units = vectors / scale
        rest = np.sqrt(np.maximum(0, length**2 - (units**2).sum(1)))
        values = (self.directions[:, :-1] @ units.T + self.directions[:, -1:] * rest).astype(np.float32)
        self.order = np.argsort(values, axis=1, kind="stable")
        self.sorted = np.take_along_axis(values, self.order, axis=1)
        self.reach = needed_width()
        self.verified = 0  # inner products so far
        self.stops = np.zeros(LEVELS, np.int64)  # searches that stopped at each level

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query its id, and ids and scores of the best ``k`` verified vectors.

        Best first, ties to the smaller id. All queries widen along one ladder of
        widths, so a window's ends are looked up once for a projection and all queries.
        """
        centres = (self.directions[:, :-1] @ (queries / self.scale).T).astype(np.float32)
        ends: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def window(level: int) -> tuple[float, np.ndarray, np.ndarray]:
            width = FIRST * self.length * WIDEN**level
            if level not in ends:
                low = np.stack([np.searchsorted(row, c - np.float32(width), "left") for row, c in zip(self.sorted, centres)], axis=1)
                high = np.stack([np.searchsorted(row, c + np.float32(width), "right") for row, c in zip(self.sorted, centres)], axis=1)
                ends[level] = low, high
            return width, *ends[level]

        for number, (query_id, query) in enumerate(zip(query_ids.tolist(), queries)):
            yield query_id, *self._search_one(query_id, query, k, number, window)

    def _search_one(self, query_id: int, query: np.ndarray, k: int, number: int, window) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.ids)
        unit = query / self.scale
        square = float(unit @ unit) + self.length**2
        slack = 1e-14 * len(query) * self.length * math.sqrt(square)  # more than rounding can change
        known = np.full(n, np.nan)  # scores of verified vectors

        def walk(start: int) -> tuple[np.ndarray, int]:
            """Rows of the best verified vectors at the level that ends the search, and that level; levels before ``start`` are passed over."""
            counts = np.zeros(n, np.int64)
            todo = self.ids != query_id
            rows, scores = np.empty(0, np.int64), np.empty(0)
            before = None
            for level in range(start, LEVELS):
                width, low, high = window(level)
                now = low[number].tolist(), high[number].tolist()
                if before is None:
                    new = [o[a:b] for o, a, b in zip(self.order, *now)]
                else:
                    new = [x for o, a, b, a0, b0 in zip(self.order, *now, *before) for x in (o[a:a0], o[b0:b]) if len(x)]
                before = now
                if new:
                    counts += np.bincount(np.concatenate(new), minlength=n)
                met = np.flatnonzero((counts >= THRESHOLD) & todo)
                todo[met] = False
                fresh = met[np.isnan(known[met])]
                self.verified += len(fresh)
                known[fresh] = (self.vectors[fresh] / self.scale) @ unit
                found = known[met]
                if len(rows) >= k:  # most of the new ones are no better than the worst held
                    better = found >= np.partition(scores, -k)[-k] - slack
                    met, found = met[better], found[better]
                rows, scores = np.concatenate([rows, met]), np.concatenate([scores, found])
                if len(rows) >= k:
                    worst = np.partition(scores, -k)[-k]
                    near = scores >= worst - slack
                    rows, scores = rows[near], scores[near]
                    if width >= self.reach * math.sqrt(max(0.0, square - 2 * float(worst))):
                        break
                if min(now[1]) == n and not max(now[0]):  # all windows hold all vectors
                    break
            return rows, level

        # Wider windows only find more and better vectors, so a search that goes on after a level goes on after all before it.
        done = np.cumsum(self.stops)
        start = max(0, int(np.searchsorted(done, EARLY * done[-1], "right")) - 1) if done[-1] else 0
        rows, level = walk(start)
        if level == start > 0:
            rows, level = walk(0)
        self.stops[level] += 1
        exact = scores_of(self.vectors[rows], query)
        best = np.lexsort((self.ids[rows], -exact))[:k]
        return self.ids[rows[best]], exact[best]


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v`` (doubles): rows with an id, and finite components that are not all zero."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("v", lambda x: x != 0)
    return vectors.select("vec_id", v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & some)


_PACKED = "part int, dim int, ids binary, vectors binary"


def _packed(rows: DataFrame, parts: int) -> DataFrame:
    """Rows of equal dimension dealt to ``parts`` parts, one row each; repeated rows are spread like others."""

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy().astype("<i8")
        flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype("<f8")
        return pa.table({
            "part": pa.array([key[0].as_py()], pa.int32()), "dim": pa.array([key[1].as_py()], pa.int32()),
            "ids": pa.array([ids.tobytes()]), "vectors": pa.array([flat.tobytes()]),
        })

    part = F.pmod(F.xxhash64("n"), F.lit(parts)).cast("int")
    keyed = rows.select("vec_id", "v", F.monotonically_increasing_id().alias("n"))
    return keyed.select("vec_id", "v", part.alias("part"), F.size("v").alias("dim")).groupBy("part", "dim").applyInArrow(pack, _PACKED)


FOUND_SCHEMA = "query_id long, vec_id long, score double"


def nearest(vectors: DataFrame, is_query, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each query, by inner product.

    ``is_query`` is a condition on ``vec_id``. Candidates are all usable rows with
    another id and as many components; rows that are null, zero or not finite take no
    part, nor rows without id. Repeated rows are candidates each; of a query id with
    several vectors the smallest is asked. A query with no
    candidate has no rows, one with fewer than ``k`` gets all of them. An empty table gives no rows.
    """
    rows = materialise(usable(vectors), "vectors")
    n, scale = rows.agg(F.count("*"), F.max(F.array_max(F.transform("v", lambda x: F.abs(x))))).first()
    scale = float(scale or 1.0)
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + (x / scale) * (x / scale))
    length = math.sqrt(rows.agg(F.max(squares)).first()[0] or 1.0) * (1 + 1e-12)
    blocks = max(1, math.ceil(n / BLOCK_ROWS))
    queries = rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = max(1, math.ceil(queries.count() / QUERY_ROWS))
    # Every query block meets every index block: the stated query set against all rows.
    index = _packed(rows, blocks).select(F.col("part").alias("block"), "dim", F.lit(-1).alias("q_part"), "ids", "vectors")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    sent = _packed(queries, asked).select(every.alias("block"), "dim", F.col("part").alias("q_part"), "ids", "vectors")
    spread = index.unionByName(sent).repartition(min(4 * blocks, 4096), "block", "dim").sortWithinPartitions("block", "dim", "q_part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, of = None, None
        for batch in batches:
            for row in batch.to_pylist():
                ids, flat = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["vectors"], "<f8").reshape(-1, row["dim"])
                if row["q_part"] < 0:
                    held, of = (row["block"], row["dim"]), BlockIndex(ids, flat, scale, length)
                elif held == (row["block"], row["dim"]):  # else the block has no vectors of this dimension
                    for query_id, found, scores in of.search(ids, flat, k):
                        if len(found):
                            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), query_id)), pa.array(found), pa.array(scores)], names=["query_id", "vec_id", "score"])

    found = spread.mapInArrow(run, FOUND_SCHEMA)
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest_report(vectors: DataFrame) -> DataFrame:
    """The 20 nearest found of every vector whose id is divisible by 20."""
    return nearest(vectors, F.col("vec_id") % 20 == 0)
