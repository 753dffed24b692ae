"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its hashed character n-grams and itself, and its vector the mean of
their embeddings; an unseen misspelling, which shares most of its n-grams with the word it
comes from, gets nearly its vector. A text is the weighted mean of its distinct words' vectors
and of one zero vector, and goes through a two-class softmax. The weight of a word is learnt
like its vector: the exponential of the mean of one more number for each n-gram. So a few
telling words are not lost among many others, and the score does not grow with the length of
a text. Embeddings, weights and softmax are trained jointly, in numpy, on a bounded sample of
labelled rows. At scoring time the product of embeddings and softmax weights is one number
for each bucket, so the broadcast model has two times ``BUCKETS`` floats whatever the corpus.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenreef.llm._arrow import slices, texts_of
from lumenreef.llm._scratch import materialise

BUCKETS = 1 << 17  # a power of two
DIM = 4
NGRAMS = (3, 4, 5)
#: Bound on the training rows of either class (the documented sample bound).
SAMPLE_PER_CLASS = 2000
#: Distinct words of a training text that are learnt from: those of smallest hash (a text to be scored is taken whole).
WORDS_PER_TEXT = 1000
#: Logarithm of the largest weight of a word.
LARGEST_WEIGHT = 30.0
EPOCHS = 60
RATE = 6.0
#: Length of the softmax weights at the start.
LENGTH = 2.0
#: Steps of the words' weights, as a multiple of those of their vectors.
RATE_OF_WEIGHTS = 3.0
#: Entries of a task's word cache; a full cache is emptied, results do not change.
CACHE_WORDS = 400_000

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_KEEP = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
_TABLE = bytes(c if c in _KEEP else c + 32 if c in _UPPER else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    """Lower-case words: runs of letters and digits, every non-ASCII character counting as a letter."""
    return text.lower().encode("utf-8", "replace").translate(_TABLE).split()


def buckets_of(word: bytes) -> list[int]:
    """Buckets of a word's character n-grams and of the whole word."""
    crc, mask = zlib.crc32, BUCKETS - 1
    if word.isascii():  # bytes are characters
        b = b"<" + word + b">"
        bag = [crc(b[i : i + n]) & mask for n in NGRAMS for i in range(len(b) - n + 1)]
        return [*bag, crc(b + b"#") & mask]
    w = f"<{word.decode('utf-8', 'replace')}>"
    bag = [crc(w[i : i + n].encode()) & mask for n in NGRAMS for i in range(len(w) - n + 1)]
    return [*bag, crc(f"{w}#".encode()) & mask]


@dataclass(frozen=True)
class ToxicityModel:
    """For each bucket its part in a word's log-odds and in its weight (two columns), and the bias."""

    buckets: np.ndarray
    bias: float

    def scorer(self):
        """A function text -> probability, with a bounded memory of words.

        The memory belongs to the process, so later tasks of a worker find it filled.
        Sums are exact before they are rounded, so the order of the words does not matter.
        """
        odds, weights = self.__dict__.setdefault("_tables", self.buckets.T.tolist())
        seen: dict[bytes, tuple[float, float]] = self.__dict__.setdefault("_seen", {})

        def score(text: str) -> float:
            if len(seen) > CACHE_WORDS:
                seen.clear()
            found = []
            for w in set(words_of(text)):
                pair = seen.get(w)
                if pair is None:
                    bag = buckets_of(w)
                    weight = math.exp(min(LARGEST_WEIGHT, sum([weights[k] for k in bag]) / len(bag)))
                    pair = seen[w] = weight, weight * sum([odds[k] for k in bag]) / len(bag)
                found.append(pair)
            total = 1.0 + math.fsum([a for a, _ in found])  # 1: the zero vector, all that a text without words has
            z = self.bias + math.fsum([b for _, b in found]) / total
            return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, z))))

        return score


class _Mean:
    """The linear map that averages rows of a matrix by group, and its transpose.

    Both take ``STEP`` groups at a time, so that memory follows the result and not the entries.
    """

    STEP = 1 << 14

    def __init__(self, index: np.ndarray, sizes: np.ndarray, n_in: int) -> None:
        self.index, self.n_in = index, n_in
        self.bounds = np.concatenate([[0], np.cumsum(sizes)])
        self.inverse = (1.0 / sizes).astype(np.float32)[:, None]
        order = np.argsort(index, kind="stable").astype(np.int32)
        self.back_row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[order]
        self.back_key, starts = np.unique(index[order], return_index=True)
        self.back_bounds = np.append(starts, len(index))

    def _sums(self, x: np.ndarray, index: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        for at in range(0, len(bounds) - 1, self.STEP):
            some = bounds[at : at + self.STEP + 1]
            yield at, np.add.reduceat(x[index[some[0] : some[-1]]], some[:-1] - some[0], axis=0)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(self.inverse), x.shape[1]), np.float32)
        for at, sums in self._sums(x, self.index, self.bounds):
            out[at : at + len(sums)] = sums
        return out * self.inverse

    def back(self, g: np.ndarray) -> np.ndarray:
        out = np.zeros((self.n_in, g.shape[1]), np.float32)
        for at, sums in self._sums(g * self.inverse, self.back_row, self.back_bounds):
            out[self.back_key[at : at + len(sums)]] = sums
        return out


def word_id(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) - (1 << 63)


def learnt_words(text: str) -> dict[int, bytes]:
    """The words of a training text that are learnt from, by their ids in rising order."""
    ids = {word_id(w): w for w in words_of(text)}
    return {k: ids[k] for k in heapq.nsmallest(WORDS_PER_TEXT, ids)}


def train(texts: Sequence[str], labels: Sequence[int], epochs: int = EPOCHS, seed: int = 11) -> ToxicityModel:
    """``fit`` on texts."""
    docs, bags = [], {}
    for t in texts:
        ids = learnt_words(t)
        bags.update((k, buckets_of(w)) for k, w in ids.items() if k not in bags)
        docs.append(np.array(sorted(ids), np.int64))
    order = sorted(bags)
    return fit(docs, labels, np.array(order, np.int64), [np.array(bags[k], np.int32) for k in order], epochs, seed)


def fit(docs: list[np.ndarray], labels: Sequence[int], vocabulary: np.ndarray, bags: list[np.ndarray], epochs: int = EPOCHS, seed: int = 11) -> ToxicityModel:
    """Fit embeddings, weights and softmax jointly by full-batch momentum descent.

    Both classes weigh alike. Steps are scaled by one number for each parameter block, so that rare
    n-grams move less than those that many texts share. With no rows, one class
    only, or no words, the embeddings are zero and the bias is the smoothed log-odds.

    ``docs`` has the ids of each text's distinct words, ``vocabulary`` all ids in
    order and ``bags`` their buckets.
    """
    y = np.asarray(labels, np.int64)
    n1 = int(y.sum())
    docs = [np.searchsorted(vocabulary, d).astype(np.int32) for d in docs]
    if n1 in (0, len(y)) or not len(vocabulary):
        return ToxicityModel(np.zeros((BUCKETS, 2), np.float32), math.log((n1 + 0.5) / (len(y) - n1 + 0.5)))
    every = np.concatenate(bags)
    used = np.unique(every)
    place = np.zeros(BUCKETS, np.int32)
    place[used] = np.arange(len(used))
    to_word = _Mean(place[every], np.array([len(b) for b in bags]), len(used))
    del every, bags

    full = np.array([k for k, d in enumerate(docs) if len(d)])  # texts with words
    y, docs = y[full], [docs[k] for k in full]
    n1 = max(1, int(y.sum()))
    n0 = max(1, len(y) - n1)
    word = np.concatenate(docs)
    sizes = np.array([len(d) for d in docs])
    starts, row = np.concatenate([[0], np.cumsum(sizes)[:-1]]), np.repeat(np.arange(len(docs), dtype=np.int32), sizes)
    del docs
    share_of = np.where(y == 1, 0.5 / n1, 0.5 / n0)

    rng = np.random.default_rng(seed)
    e = np.zeros((len(used), DIM + 1), np.float32)  # the last column is for the weights
    half = rng.normal(size=(DIM, 1)).astype(np.float32)
    half *= LENGTH / np.linalg.norm(half)  # of one length, as only the direction may be left to chance
    w = np.concatenate([-half, half], axis=1)
    b = np.zeros(2, np.float32)
    blocks = [(e, RATE), (w, 0.05), (b, 0.1)]
    momentum, largest = [np.zeros_like(q) for q, _ in blocks], [0.0] * 3
    for step in range(1, epochs + 1):
        h = to_word(e)
        z = h[:, :DIM] @ w
        odds, weight = (z[:, 1] - z[:, 0])[word], np.minimum(h[:, DIM], LARGEST_WEIGHT)[word]
        top = np.maximum(np.maximum.reduceat(weight, starts), 0)  # 0: the weight of the zero vector
        part = np.exp(weight - top[row])
        part /= (np.add.reduceat(part, starts) + np.exp(-top))[row]
        mean = np.add.reduceat(part * odds, starts)
        p = 1 / (1 + np.exp(-(mean + b[1] - b[0])))
        error = (p - y) * share_of
        pull = error[row] * part
        g_odds = np.bincount(word, pull, len(vocabulary)).astype(np.float32)
        g_weight = np.bincount(word, pull * (odds - mean[row]), len(vocabulary)).astype(np.float32)
        g = np.stack([-g_odds, g_odds], axis=1)
        grads = [
            to_word.back(np.concatenate([g @ w.T, RATE_OF_WEIGHTS * g_weight[:, None]], axis=1)),
            h[:, :DIM].T @ g,
            np.array([-error.sum(), error.sum()], np.float32),
        ]
        for k, ((q, rate), dq) in enumerate(zip(blocks, grads)):
            momentum[k] += 0.2 * (dq - momentum[k])
            largest[k] += 0.1 * (float((dq * dq).max()) - largest[k])
            q -= (1 - (step - 1) / epochs) * rate * momentum[k] / (math.sqrt(largest[k] / (1 - 0.9**step)) + 1e-12)
    folded = np.zeros((BUCKETS, 2), np.float32)
    folded[used, 0], folded[used, 1] = e[:, :DIM] @ (w[:, 1] - w[:, 0]), e[:, DIM]
    return ToxicityModel(folded, float(b[1] - b[0]))


def remainder(modulus: int):
    """crc32 of doc_id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus


def training_sample(docs: DataFrame, labels: DataFrame, label: str, rows, per_class: int) -> DataFrame:
    """``doc_id, y, text`` of at most ``per_class`` labelled rows of either class.

    ``rows`` is the condition on ``doc_id`` for a row to be learnt from. Ids are
    taken in the order of a hash; rows without id or label are passed over, of
    an id with several labels the largest counts, and of repeated rows one text.
    """
    known = labels.where(rows & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    known = known.groupBy("doc_id").agg(F.max(F.col(label)).cast("int").alias("y"))
    picks = [
        known.where(F.col("y") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        for c in (0, 1)
    ]
    chosen = F.broadcast(picks[0].unionByName(picks[1]))  # at most 2 * per_class rows
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(chosen, "doc_id")
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y"))


def hashed_sample(sample: DataFrame) -> tuple[list[np.ndarray], list[int], np.ndarray, list[np.ndarray]]:
    """The arguments of ``fit`` for ``sample(doc_id, y, text)``; texts and words stay on the executors."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = [learnt_words(t) for t in texts_of(batch)]
            ids = pa.array([list(w) for w in words], pa.list_(pa.int64()))
            listed = pa.array([list(w.values()) for w in words], pa.list_(pa.binary()))
            columns = [batch.column("doc_id").cast(pa.int64()), batch.column("y").cast(pa.int32()), ids, listed]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "y", "ids", "words"])

    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            bags = pa.array([np.array(buckets_of(w), "<i4").tobytes() for w in batch.column("word").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), bags], names=["id", "bag"])

    kept = materialise(sample.select("doc_id", "y", "text").mapInArrow(split, "doc_id long, y int, ids array<long>, words array<binary>"), "sample")
    rows = kept.select("doc_id", "y", "ids").toArrow().sort_by("doc_id")
    docs = [x.values.to_numpy() for x in rows["ids"]]
    pairs = kept.select(F.explode(F.arrays_zip("ids", "words")).alias("p")).select(F.col("p.ids").alias("id"), F.col("p.words").alias("word"))
    found = pairs.groupBy("id").agg(F.min("word").alias("word")).mapInArrow(bag, "id long, bag binary").toArrow().sort_by("id")
    whole = found["bag"].combine_chunks()
    ends = np.frombuffer(whole.buffers()[1], "<i4")[whole.offset : whole.offset + len(whole) + 1] // 4
    flat = np.frombuffer(whole.buffers()[2], "<i4") if len(whole) else np.zeros(0, np.int32)
    bags = [flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
    return docs, rows["y"].to_pylist(), found["id"].to_numpy(), bags


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> ToxicityModel:
    """Train on a bounded sample of the labelled rows with crc32(doc_id) mod 5 not 0."""
    return fit(*hashed_sample(training_sample(docs, labels, "toxic", remainder(5) != 0, per_class)))


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` with a column ``toxicity`` (0 to 1); a column of that name is replaced.

    Null and empty texts get the bias's score. All columns and rows stay.
    """
    docs = docs.drop("toxicity")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shared.value.scorer()
        for batch in slices(batches):
            scores = pa.array([of(t) for t in texts_of(batch)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, "toxicity"])

    return docs.mapInArrow(score, docs.withColumn("toxicity", F.lit(0.0)).schema)


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each document: doc_id, held_out, score, predicted.

    Null and empty texts have the bias's score. Repeated rows repeat, a null doc_id keeps its
    row, an empty table gives no rows. Without labels to learn from all scores are one number.
    """
    scored = score_toxicity(docs.select("doc_id", "text"), fit_toxicity(docs, labels))
    return scored.select(
        "doc_id",
        (remainder(5) == 0).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )
