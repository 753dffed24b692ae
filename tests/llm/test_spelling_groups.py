"""Spelling groups against brute force."""

import random
import zlib
from collections import Counter
from itertools import combinations

import duckdb
import pytest

from lumenreef.llm import registry, spelling_groups
from lumenreef.llm.spelling_groups import SortedList

DIR = "/root/testdata/sf0.001"
VOCAB = "word string, n long"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, ratio=5):
    """The rows of the groups, from all pairs of words."""
    near = {w: [] for w in counts}
    for a, b in combinations(counts, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), counts[w], len(near[w]), counts[form[w]] if form[w] is not None else None) for w in counts}


def invented(count, seed=2, shared=""):
    rng = random.Random(seed)
    words = {shared + "".join(rng.choice("abéz") for _ in range(rng.randrange(3, 8))) for _ in range(count)}
    return {w: 5 ** rng.randrange(1, 6) + rng.randrange(3) for w in words}


def test_sorted_list_finds_every_word_one_edit_away():
    rng = random.Random(3)
    for _ in range(400):
        words = sorted({"".join(rng.choice("abé") for _ in range(rng.randrange(1, 7))) for _ in range(rng.randrange(1, 60))})
        listed = SortedList(words)
        for q in [*words, "ab", "bbbbb", "aébaéb"]:
            assert list(listed.one_edit(q)) == [i for i, w in enumerate(words) if one_edit(q, w)]


@pytest.mark.parametrize("shared", ["", "aaaaaaaaaa"])
@pytest.mark.parametrize("limit", [20_000, 7])
def test_groups_equal_brute_force(spark, limit, shared):
    """Also where one first half holds every word, and lists are cut into many chunks."""
    counts = invented(250, shared=shared)
    found = spelling_groups.spelling_groups(spark.createDataFrame(list(counts.items()), VOCAB), limit=limit)
    assert {tuple(r) for r in found.collect()} == brute(counts) and found.count() == len(counts)


def test_chain_of_forms_and_ties(spark):
    counts = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "zzzzzz": 5, "yzzzzz": 25, "xzzzzz": 25, "qqqqqq": 5, "qqqqqp": 24}
    found = {tuple(r) for r in spelling_groups.spelling_groups(spark.createDataFrame(list(counts.items()), VOCAB)).collect()}
    assert found == brute(counts)
    assert ("aaaaaa", "aaaaab", "aaabbb", 5, 1, 25) in found and ("zzzzzz", "xzzzzz", "xzzzzz", 5, 2, 25) in found


def counted(rows):
    """The vocabulary by the report's definition."""
    counts = Counter()
    for doc_id, text in rows:
        run = ""
        for x in (text or "") + " ":
            if x.isascii() and x.isalpha() or "À" <= x <= "ÿ":
                run += x.lower() if x.isascii() else x
            elif run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                at = h % len(run)
                counts[run if h % 199 else run[:at] + run[at + 1 :]] += 1
                run = ""
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def test_report_equals_definition(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").collect()
    found = registry.queries()["op11_spelling_groups"](spark, DIR)
    assert {tuple(r) for r in found.collect()} == brute(counted(docs))


def test_report_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DIR}/documents.parquet'")
    df = registry.queries()["op11_spelling_groups"](spark, DIR)
    found = con.execute(registry.oracle_sql()["op11_spelling_groups"])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    assert set(map(tuple, df.select(*names).collect())) == set(map(tuple, found.fetchall()))


def test_odd_rows(spark):
    rows = [(1, None, "s"), (2, "", None), (None, "Señora señora SEÑORA " * 3, "s"), (3, "señorb " * 30, "s"), (3, "señorb " * 30, "s"), (4, "a" * 200_000, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string")
    assert {tuple(r) for r in spelling_groups.spelling_report(docs).collect()} == brute(counted([r[:2] for r in rows]))
    assert spelling_groups.spelling_report(spark.createDataFrame([], docs.schema)).count() == 0
