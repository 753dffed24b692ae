"""Ties, repeated rows, extreme lengths and pruning of the nearest-neighbour search."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from lumenreef.llm import ann_search

SCHEMA = "vec_id long, embedding array<double>"


def ranked(vectors, k=20, modulus=20):
    """The whole answer by comparing every query with every row; scores summed from left to right."""
    out = set()
    for q in {i for i, _ in vectors if i % modulus == 0}:
        v = min(v for i, v in vectors if i == q)
        scored = sorted((-float(ann_search.scores_of(np.array([w]), np.array(v))[0]), i) for i, w in vectors if i != q)
        out.update((q, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1))
    return out


def answer(spark, vectors):
    got = ann_search.nearest_report(spark.createDataFrame(vectors, SCHEMA)).collect()
    return {(r.query_id, r["rank"], r.vec_id, r.score) for r in got}


def test_ties_go_to_the_smaller_id_whatever_the_block(spark, monkeypatch):
    monkeypatch.setattr(ann_search, "BLOCK_ROWS", 150)
    rng = np.random.default_rng(4)
    base = [rng.normal(size=12).tolist() for _ in range(120)]
    vectors = [(int(i), base[i % 120]) for i in rng.permutation(720)]
    # few distinct vectors, each six times: every score of a query is tied
    got, want = answer(spark, vectors), ranked(vectors)
    assert len(got & want) >= 0.98 * len(want)
    for q in {x[0] for x in got}:
        mine = sorted((n, -s, i) for a, n, i, s in got if a == q)
        assert [x[1:] for x in mine] == sorted(x[1:] for x in mine)


def test_repeated_ids_and_one_very_common_vector(spark):
    common = [1.0, 2.0, 3.0]
    vectors = [(k, common) for k in range(1, 60)] + [(60, common), (60, [9.0, 0.0, 0.0]), (7, common), (7, common)]
    assert answer(spark, vectors) == ranked(vectors)


def test_lengths_that_overflow(spark):
    vectors = [(0, [1e200, 1e200]), (1, [1e190, -1e190]), (2, [1e-200, 1e-200]), (20, [1.0, 1.0]), (3, [5e-324, 0.0])]
    got = answer(spark, vectors)
    assert {(q, i) for q, _, i, _ in got} == {(q, i) for q in (0, 20) for i in (0, 1, 2, 3, 20) if i != q}


def table(name):
    """Ids and vectors: of a given table, or 50,000 with the spread of the given ones (directions of even density)."""
    if name != "made":
        rows = pq.read_table(f"/root/testdata/{name}/embeddings.parquet").to_pydict()
        rows = [(i, v) for i, v in zip(rows["vec_id"], rows["embedding"]) if v is not None]
        return np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    like = table("sf0.1")[1]
    rng = np.random.default_rng(17)
    v = rng.normal(size=(50_000, like.shape[1]))
    return np.arange(len(v)), v / np.linalg.norm(v, axis=1, keepdims=True) * np.linalg.norm(like, axis=1).mean()


@pytest.mark.parametrize(("name", "share", "every"), [("sf0.01", 0.7, 1), ("sf0.1", 0.4, 1), ("made", 0.2, 100)])
def test_recall_and_share_of_verified_vectors(name, share, every):
    """Recall against brute force, and vectors verified a query: the share falls as tables grow."""
    ids, v = table(name)
    queries = np.flatnonzero(ids % 20 == 0)[::every]
    scale = np.abs(v).max()
    length = float(np.sqrt(((v / scale) ** 2).sum(1).max()))
    found, verified = {int(ids[q]): [] for q in queries}, 0
    for at in range(0, len(v), ann_search.BLOCK_ROWS):
        index = ann_search.BlockIndex(ids[at : at + ann_search.BLOCK_ROWS], v[at : at + ann_search.BLOCK_ROWS], scale, length)
        for q, near, scores in index.search(ids[queries], v[queries], 20):
            found[q] += zip((-scores).tolist(), near.tolist())
        verified += index.verified
    hits = 0
    for q in queries:
        scores = v @ v[q]
        scores[q] = -np.inf
        hits += len({i for _, i in sorted(found[int(ids[q])])[:20]} & set(ids[np.argsort(-scores)[:20]].tolist()))
    recall, part = hits / (20 * len(queries)), verified / (len(queries) * len(v))
    assert recall >= 0.9 and part <= share, (recall, part)


def test_levels_before_the_usual_stop_are_passed_over(monkeypatch):
    """Answers do not depend on the level a query starts from, and counting takes few levels of windows a query."""
    ids, v = table("sf0.1")
    v = np.concatenate([v, v[:40] * 0.1, np.repeat(v[:1], 40, axis=0)])  # some queries stop much earlier or later
    ids = np.arange(len(v))
    scale = np.abs(v).max()
    length = float(np.sqrt(((v / scale) ** 2).sum(1).max()))
    queries = np.flatnonzero(ids % 5 == 0)
    make = lambda: ann_search.BlockIndex(ids, v, scale, length)
    alone, steps = [], []
    index = make()
    for q in queries[:60]:
        index.stops = np.zeros(ann_search.LEVELS, np.int64)  # as if it were the first
        alone += [(i, a.tolist(), b.tolist()) for i, a, b in index.search(ids[[q]], v[[q]], 20)]
    plain = np.bincount
    monkeypatch.setattr(ann_search.np, "bincount", lambda *a, **k: steps.append(1) or plain(*a, **k))
    found = [(i, a.tolist(), b.tolist()) for i, a, b in make().search(ids[queries], v[queries], 20)]
    assert found[:60] == alone
    assert len(steps) < 6 * len(queries), len(steps) / len(queries)
