"""Periodic runs against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from lumenreef.llm import periodic_runs, registry

DOCS = "doc_id long, text string"


def brute(words, least=12):
    """Runs of a sequence by comparing it with itself at every lag."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted([(a, b - a, q) for (a, b), q in found.items()], key=lambda r: (r[0], r[2]))


def sequences(count):
    """Random sequences over few words, with planted and nested periods, and Fibonacci words."""
    rng = random.Random(5)
    for _ in range(count):
        few = rng.choice([1, 2, 2, 3, 6])
        words = [rng.randrange(few) for _ in range(rng.randrange(0, 160))]
        for _ in range(rng.randrange(0, 4) if words else 0):
            root = [rng.randrange(few) for _ in range(rng.randrange(1, 30))]
            root = rng.choice([root, root + root[: len(root) // 2] + root, (root[:3] * 5)[: len(root)]])
            at = rng.randrange(len(words))
            words[at : at + rng.randrange(0, 6 * len(root))] = (root * 8)[: rng.randrange(2 * len(root), 6 * len(root) + 1)]
        yield words
    a, b = [0], [0, 1]
    for _ in range(9):
        a, b = b, b + a
        yield b


def test_runs_equal_brute_force():
    for words in sequences(1500):
        assert periodic_runs.find_runs(np.array(words, np.int64)) == brute(words), words


@pytest.mark.parametrize("least", [4, 7, 20])
def test_other_least_lengths(least):
    for words in sequences(200):
        assert periodic_runs.find_runs(np.array(words, np.int64), least) == brute(words, least), words


def test_work_does_not_grow_with_the_square():
    m = 200_000
    one = np.zeros(m, np.int64)
    assert periodic_runs.find_runs(one) == [(0, m, 1)]
    assert periodic_runs.find_runs(np.concatenate([one, [1], one])) == [(0, m, 1), (m + 1, m, 1)]
    phrase = np.concatenate([np.append(np.arange(10), 100 + i) for i in range(20_000)])  # a frequent phrase without a period
    assert periodic_runs.find_runs(phrase) == []


def plain_report(doc_id, text):
    """The row of the report, written down from its definition."""
    words = [] if text is None else text.encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a, original = g % n, list(words)
            p = 1 + (n - a) // (3 + g % 8)
            words = [original[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in runs)]
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    longest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join("%d,%d,%d\n" % r for r in runs)
    return (doc_id, len(runs), *longest, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


def test_report_equals_definition(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = registry.queries()["op13_periodic_runs"](spark, "/root/testdata/sf0.001").collect()
    want = [plain_report(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, found), key=lambda r: r[0]) == sorted(want, key=lambda r: r[0])


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a b " * 9), (30, "x " * 40), (30, "x " * 40), (5, "ñ é ñ é ñ é ñ é ñ é ñ é"), (6, "w" * 300_000 + " z" * 20_000)]
    found = [tuple(r) for r in periodic_runs.runs_report(spark.createDataFrame(rows, DOCS)).collect()]
    plain = [plain_report(*r) if r[0] != 6 else None for r in rows]
    assert all(r in found for r in plain if r) and len(found) == len(rows)
    assert [r[1:5] for r in found if r[0] == 6] == [(1, 1, 20_000, 1)]
    assert periodic_runs.runs_report(spark.createDataFrame([], DOCS)).count() == 0


def test_marked_texts_keep_other_columns(spark):
    rows = spark.createDataFrame([(7, "a b c " * 4 + "d", "x", 1.5), (8, None, None, None)], "doc_id long, text string, runs string, period double")
    marked = {r.doc_id: r for r in periodic_runs.mark_runs(rows).collect()}
    assert marked[7].collapsed == "a b c d" and [tuple(r) for r in marked[7].runs] == [(0, 12, 3)] and marked[7].period == 1.5
    assert marked[8].collapsed == "" and marked[8].runs == []
