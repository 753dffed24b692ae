"""Quality classifier: random Fourier features over document statistics.

A document becomes a few statistics; random cosines of them approximate
a Gaussian kernel. Ridge weights come from normal equations that are summed within
partitions and then by cell on the cluster, over all labelled training rows, so the
driver gets one small matrix. Ridge scores are calibrated by isotonic regression on
a histogram of score bins. Every size met on the driver depends on ``FEATURES`` and
``BINS`` alone.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenreef.llm._arrow import slices, texts_of
from lumenreef.llm._scratch import materialise

STATISTICS = (
    "log_words", "log_chars", "word_length", "symbols", "marks", "upper", "digits", "non_ascii",
    "distinct_words", "adjacent_repeats", "repeated_windows", "duplicate_lines", "words_per_line",
    "ended_lines", "bars",
)
FEATURES = 160
GAMMA = 0.08
RIDGE = 1e-3
BINS = 2048
#: Range of ridge scores that the bins cover; scores beyond go to the end bins.
LOW, HIGH = -0.5, 1.5

_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_SYMBOLS = b"#*$%&|<>"
_MARKS = b"!?.,;:"
_ASCII = bytes(range(128))


def statistics(text: str) -> list[float]:
    """The statistics of a text in the order of ``STATISTICS``; all defined for the empty text."""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    n, size, n_lines = max(1, len(words)), max(1, len(raw)), max(1, len(lines))

    def share(kind: bytes) -> float:
        return (len(raw) - len(raw.translate(None, kind))) / size

    windows = max(1, len(words) - 2)
    return [
        float(np.log1p(len(words))), float(np.log1p(len(raw))), sum(map(len, words)) / n,
        share(_SYMBOLS), share(_MARKS), share(_UPPER), share(_DIGITS), len(raw.translate(None, _ASCII)) / size,
        len(set(words)) / n, sum(map(operator.eq, words, words[1:])) / n,
        1 - len(set(zip(words, words[1:], words[2:]))) / windows if len(words) > 2 else 0.0,
        1 - len(set(lines)) / n_lines if lines else 0.0, float(np.log1p(len(words) / n_lines)),
        sum(x.rstrip()[-1] in _MARKS for x in lines) / n_lines, raw.count(b" | ") / n,
    ]


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, x`` (array of the statistics), one row for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = pa.array([statistics(t) for t in texts_of(batch)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), x], names=["doc_id", "x"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, x array<double>")


@dataclass(frozen=True)
class QualityModel:
    """Standardisation, random projection, ridge weights and the calibration curve."""

    mean: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        """Cosine features and a constant."""
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        cosines = np.sqrt(2 / len(self.phases)) * np.cos(z @ self.frequencies + self.phases)
        return np.concatenate([cosines, np.ones((len(x), 1))], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability of label 1."""
        return np.interp(self.raw(x), self.knots, self.levels)


def isotonic(weights: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The non-decreasing fit to weighted values, by pooling adjacent violators."""
    blocks: list[list[float]] = []  # weight, mean, members
    for w, v in zip(weights.tolist(), values.tolist()):
        blocks.append([w, v, 1])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            w2, v2, n2 = blocks.pop()
            w1, v1, n1 = blocks[-1]
            blocks[-1] = [w1 + w2, (w1 * v1 + w2 * v2) / (w1 + w2), n1 + n2]
    return np.repeat([b[1] for b in blocks], [int(b[2]) for b in blocks])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))


def fit_quality(stats: DataFrame, labels: DataFrame, rows, label: str = "quality", seed: int = 5) -> QualityModel:
    """Fit on every labelled row of ``stats`` for which ``rows`` holds on its doc_id.

    Of an id with several labels the largest counts; rows without id or label are
    passed over. Without training rows the score is 0.5 for all, with one class that
    class's smoothed share.
    """
    d = len(STATISTICS)
    rng = np.random.default_rng(seed)
    frequencies = rng.normal(size=(d, FEATURES)) * np.sqrt(2 * GAMMA)
    phases = rng.uniform(0, 2 * np.pi, FEATURES)
    known = labels.where(rows & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    known = known.groupBy("doc_id").agg(F.max(label).cast("double").alias("y"))
    training = materialise(stats.join(known, "doc_id").select("x", "y"), "training")
    moments = training.agg(
        F.count("y"), F.sum("y"), *[f(F.col("x")[k]) for k in range(d) for f in (F.avg, F.stddev_pop)]
    ).first()
    n, n1 = moments[0], moments[1] or 0.0
    mean = np.array([m or 0.0 for m in moments[2::2]])
    scale = np.array([s or 1.0 for s in moments[3::2]])
    flat = QualityModel(mean, scale, frequencies, phases, np.zeros(FEATURES + 1), np.zeros(1), np.array([(n1 + 0.5) / (n + 1)]))
    if n1 in (0, n):
        return flat

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            z = flat.features(_matrix(batch.column("x")))
            total += z.T @ np.concatenate([z, batch.column("y").to_numpy()[:, None]], axis=1)
        i, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "v"])

    cells = training.mapInArrow(equations, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    total = np.zeros((FEATURES + 1, FEATURES + 2))
    for i, j, v in cells.collect():
        total[i, j] = v
    penalty = RIDGE * n * np.eye(FEATURES + 1)
    penalty[-1, -1] = 1e-9
    weights = np.linalg.solve(total[:, :-1] + penalty, total[:, -1])
    ridge = QualityModel(mean, scale, frequencies, phases, weights, np.zeros(1), np.zeros(1))

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((BINS, 2))
        for batch in batches:
            at = np.clip((ridge.raw(_matrix(batch.column("x"))) - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1).astype(int)
            sums[:, 0] += np.bincount(at, minlength=BINS)
            sums[:, 1] += np.bincount(at, batch.column("y").to_numpy(), BINS)
        used = np.flatnonzero(sums[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[used, 0]), pa.array(sums[used, 1])], names=["bin", "n", "y"])

    bins = training.mapInArrow(binned, "bin long, n double, y double").groupBy("bin").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
    rows_ = sorted(bins.collect())
    knots = LOW + (np.array([r[0] for r in rows_]) + 0.5) * (HIGH - LOW) / BINS
    weight = np.array([r[1] for r in rows_])
    levels = isotonic(weight, (np.array([r[2] for r in rows_]) + 0.02 * n1 / n) / (weight + 0.02))
    return QualityModel(mean, scale, frequencies, phases, weights, knots, levels)


def score_quality(stats: DataFrame, model: QualityModel) -> DataFrame:
    """``doc_id, score`` for each row of ``stats``."""
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(shared.value.score(_matrix(batch.column("x"))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], names=["doc_id", "score"])

    return stats.mapInArrow(run, "doc_id long, score double")


def held_out():
    """crc32 of doc_id as text, modulo 3, is 1; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each document: doc_id, held_out, score, predicted.

    Null and empty texts have the statistics of the empty text. Repeated rows
    repeat; a null doc_id keeps its row; an empty table gives no rows.
    """
    stats = materialise(document_statistics(docs), "statistics")
    scored = score_quality(stats, fit_quality(stats, labels, ~held_out()))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
