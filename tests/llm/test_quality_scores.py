"""The result of op9_quality_classifier against plain numpy over all rows at once."""

import zlib

import numpy as np
import pyarrow.parquet as pq
from lumenreef.llm import quality_classifier as qc
from lumenreef.llm import registry

DIR = "/root/testdata/sf0.01"


def monotone(weight, value):
    """The isotonic fit as the largest least mean over all stretches."""
    n = len(value)
    total = np.concatenate([[0], np.cumsum(weight * value)])
    mass = np.concatenate([[0], np.cumsum(weight)])
    means = np.full((n, n), np.inf)
    for i in range(n):
        means[i, i:] = (total[i + 1 :] - total[i]) / (mass[i + 1 :] - mass[i])
    least = np.minimum.accumulate(means[:, ::-1], axis=1)[:, ::-1]  # over ends at or after j
    return np.array([least[: j + 1, j].max() for j in range(n)])


def test_scores_equal_plain_numpy(spark):
    docs = pq.read_table(f"{DIR}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    known = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{DIR}/labels.parquet").to_pylist() if r["quality"] is not None}
    x = np.array([qc.statistics(d["text"] or "") for d in docs])
    held = np.array([zlib.crc32(str(d["doc_id"]).encode()) % 3 == 1 for d in docs])
    train = np.array([d["doc_id"] in known for d in docs]) & ~held
    y = np.array([float(known.get(d["doc_id"], 0)) for d in docs])[train]

    rng = np.random.default_rng(5)
    frequencies = rng.normal(size=(x.shape[1], qc.FEATURES)) * np.sqrt(2 * qc.GAMMA)
    phases = rng.uniform(0, 2 * np.pi, qc.FEATURES)
    spread = x[train].std(axis=0)
    z = np.clip((x - x[train].mean(axis=0)) / np.where(spread > 0, spread, 1), -8, 8)
    features = np.hstack([np.sqrt(2 / qc.FEATURES) * np.cos(z @ frequencies + phases), np.ones((len(z), 1))])
    penalty = np.diag([qc.RIDGE * len(y)] * qc.FEATURES + [1e-9])
    raw = features @ np.linalg.solve(features[train].T @ features[train] + penalty, features[train].T @ y)

    bins = np.clip((raw[train] - qc.LOW) / (qc.HIGH - qc.LOW) * qc.BINS, 0, qc.BINS - 1).astype(int)
    used = np.unique(bins)
    n = np.array([(bins == b).sum() for b in used])
    positive = np.array([y[bins == b].sum() for b in used])
    levels = monotone(n, (positive + 0.02 * y.mean()) / (n + 0.02))
    want = np.interp(raw, qc.LOW + (used + 0.5) * (qc.HIGH - qc.LOW) / qc.BINS, levels)

    got = {r.doc_id: r for r in registry.queries()["op9_quality_classifier"](spark, DIR).collect()}
    assert len(got) == len(docs)
    assert all(got[d["doc_id"]].held_out == h for d, h in zip(docs, held))
    # A score on the edge of two bins may fall into either.
    off = np.array([abs(got[d["doc_id"]].score - w) for d, w in zip(docs, want)])
    assert (off < 1e-6).mean() > 0.95 and off.max() < 0.02
