"""Mixing against plain water-filling and a plain solution of the dual."""

import math
from collections import defaultdict

import pytest

from lumenreef.llm import mixing, registry

DOCS = "doc_id long, text string, source string"


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    """Shares by weight; what is above a cap is shared again among the rest."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, left, total = {}, set(order), sum(sizes.values())
    while left:
        rest = total - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        above = {s for s in left if share[s] > most * sizes[s]}
        if not above:
            target.update(share)
            break
        target.update({s: most * sizes[s] for s in above})
        left -= above
    return target


def plain_multiplier(sizes, target, most=3):
    """The tilt ``exp(t * size)``, cut off at ``most``, that meets a target, by bisection."""
    low, high = -50.0, 50.0
    for _ in range(200):
        t = (low + high) / 2
        if sum(x * (most if t * x > math.log(most) else math.exp(t * x)) for x in sizes) < target:
            low = t
        else:
            high = t
    return (low + high) / 2


def mixed(spark, rows):
    return mixing.mix(spark.createDataFrame(rows, DOCS)).collect()


def by_source(found):
    out = defaultdict(list)
    for r in found:
        out[r.source].append(r)
    return out


def corpus():
    rows = []
    for s, (count, length) in {"a": (300, 40), "b": (30, 90), "c": (80, 25), "Z": (500, 11), None: (60, 60), "é": (3, 5)}.items():
        rows += [(len(rows) + i, "w " * (1 + (i * 37) % (2 * length)), s) for i in range(count)]
    return rows


def test_rates_solve_the_dual_and_copies_meet_the_targets(spark):
    found = by_source(mixed(spark, corpus()))
    sizes = {s: sum(r["size"] for r in rows) for s, rows in found.items()}
    targets = plain_targets(sizes)
    for s, rows in found.items():
        target = targets[s]
        assert all(r.source_size == sizes[s] and r.target == pytest.approx(target) for r in rows)
        assert all(0 <= r.copies <= 3 for r in rows)
        assert sum(r.copies * r["size"] for r in rows) == pytest.approx(target, abs=5 + 0.002 * target)
        if target < 3 * sizes[s]:
            t = plain_multiplier([r["size"] for r in rows], target)
            assert all(r.rate == pytest.approx(min(3, math.exp(t * r["size"])), abs=1e-4) for r in rows)
        else:
            assert all(r.rate == 3 and r.copies == 3 for r in rows)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_report(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "source", "text").collect()
    found = {r.doc_id: r for r in registry.queries()["op12_mixing"](spark, f"/root/testdata/{sf}").collect()}
    again = registry.queries()["op12_mixing"](spark, f"/root/testdata/{sf}").collect()
    assert found == {r.doc_id: r for r in again} and len(again) == len(docs)
    sizes, taken = defaultdict(int), defaultdict(int)
    for d in docs:
        r = found[d.doc_id]
        assert r["size"] == len((d.text or "").encode().split()) and 0 <= r.taken <= 3 * r["size"]
        sizes[d.source] += r["size"]
        taken[d.source] += r.taken
    targets = plain_targets(sizes)
    near = 0.05 if sf == "sf0.001" else 0.005  # ten or fifty documents a source
    for d in docs:
        r = found[d.doc_id]
        assert (r.source_size, r.target) == (sizes[d.source], pytest.approx(targets[d.source]))
        assert taken[d.source] == pytest.approx(targets[d.source], rel=near)


def test_targets_share_again_what_a_source_cannot_take(spark):
    sizes = {"a": 1000, "b": 1, "c": 2, "d": 500, "e": 3, "f": 0}
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(sorted(sizes))}
    table = spark.createDataFrame([(s, n, float(weight[s])) for s, n in sizes.items()], "key string, source_size long, weight double")
    found = {r.key: r.target for r in mixing.source_targets(table).collect()}
    assert found == pytest.approx(plain_targets(sizes)) and sum(found.values()) == pytest.approx(sum(sizes.values()))


def test_source_of_one_document_and_of_a_third_of_all(spark):
    rows = [(i, "x " * (5 + i % 9), "hot") for i in range(3000)] + [(10_000 + i, "y " * (3 + i % 30), f"s{i % 40}") for i in range(5000)] + [(99_999, "z " * 70, "one")]
    found = by_source(mixed(spark, rows))
    for s, mine in found.items():
        assert sum(r.copies * r["size"] for r in mine) == pytest.approx(mine[0].target, rel=0.01, abs=35)


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", None), (3, " \n", "b"), (None, "p q r", "a"), (None, "p q r", "a"), (4, "p q", None), (4, "p q", None), (5, "w" * 500_000 + " v" * 100_000, "b")]
    found = mixed(spark, rows)
    assert len(found) == len(rows) and all(r.copies == 1 for r in found if r["size"] == 0)
    assert sorted(r["size"] for r in found) == [0, 0, 0, 2, 2, 3, 3, 100_001]
    assert len({r.copies for r in found if r["size"] == 3}) == 1 and len({r.copies for r in found if r["size"] == 2}) == 1
    clashing = spark.createDataFrame([(1, "a b", "s", 9, "k")], DOCS + ", size int, key string")
    assert mixing.mix(clashing).first()["size"] == 2
    assert mixed(spark, []) == []
