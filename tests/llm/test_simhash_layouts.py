"""Every layout of segments finds the links that comparing all fingerprints does."""

import random

import pytest
from lumenreef.llm import _graph, simhash

ALL_ONES = (1 << 64) - 1


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def some_fingerprints():
    """Chains of fingerprints 1 to 7 bits apart, wherever the bits fall."""
    rng = random.Random(9)
    found = {0, ALL_ONES, 1, 1 << 63}
    for _ in range(25):
        fp = rng.getrandbits(64)
        for _ in range(8):
            found.add(fp)
            for bit in rng.sample(range(64), rng.randint(1, 7)):
                fp ^= 1 << bit
    for k in range(0, 64, 5):  # all differing bits within one segment
        found.add(sum(1 << (k + j) % 64 for j in range(4)))
    return sorted(found)


def brute_roots(fps, radius):
    root = {f: f for f in fps}
    for a in fps:
        for b in fps:
            if a < b and (a ^ b).bit_count() <= radius:
                x, y = root[a], root[b]
                if x != y:
                    root = {f: (min(x, y) if r in (x, y) else r) for f, r in root.items()}
    groups = {}
    for f, r in root.items():
        groups.setdefault(r, set()).add(f)
    return {frozenset(g) for g in groups.values() if len(g) > 1}


@pytest.mark.parametrize("radius,layout", [(4, simhash.Layout(2, 2)), (4, simhash.Layout(3, 1)), (2, simhash.Layout(1, 2)), (7, None), (0, None)])
def test_layouts_equal_brute_force(spark, monkeypatch, radius, layout):
    monkeypatch.setattr(simhash, "HOT_ROWS", 40)
    fps = some_fingerprints()
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    groups = {}
    for r in _graph.components(simhash.links(df, radius, layout)).collect():
        groups.setdefault(r.root, set()).add(r.node % (1 << 64))
    assert {frozenset(g) for g in groups.values()} == brute_roots(fps, radius)


def test_layout_widens_with_the_table():
    assert simhash.layout_for(200_000_000, 4) == simhash.Layout(3, 1)
    assert simhash.layout_for(2_000_000_000, 4) == simhash.Layout(2, 2)
    for n in (0, 10**6, 10**12):
        for radius in range(12):
            layout = simhash.layout_for(n, radius)
            assert layout.parts * (layout.reach + 1) > radius and sum(w for _, w in layout.segments) == 64
