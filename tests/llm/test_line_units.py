"""Units of long lines and copies of short ones in line dedup, against brute force."""

import random

from lumenreef.llm import line_dedup

DOCS = "doc_id long, text string"


def sentence(rng, n):
    return " ".join(f"w{rng.randrange(4000)}" for _ in range(n)) + "."


def brute(rows, exact_words=line_dedup.MIN_WORDS):
    """Texts by comparing every line and unit with all earlier ones."""
    seen = []
    for d, text in rows:
        for k, line in enumerate((text or "").split("\n")):
            for unit, words in line_dedup.parts(line.encode()):
                if len(words) >= (line_dedup.MIN_WORDS if unit else exact_words):
                    seen.append(((d, (k << line_dedup.UNIT_BITS) + unit), words))
    loose = lambda w: len(w) >= line_dedup.MIN_WORDS
    gone = {}
    for i, (place, w) in enumerate(seen):
        if any(w == v or (loose(w) and loose(v) and line_dedup.within_one(w, v)) for _, v in seen[:i]):
            gone.setdefault(place[0], set()).add(place[1])
    return {d: t if t is None else line_dedup.without(t, gone.get(d, ())) for d, t in rows}


def test_passages_inside_longer_lines_go(spark):
    rng = random.Random(1)
    passage = " ".join(sentence(rng, n) for n in (15, 4, 12, 9, 20))
    changed = passage.split(" ")
    changed[3] = changed[22] = changed[50] = "changed"  # an edit in each of three sentences
    own = [sentence(rng, 14) for _ in range(6)]
    rows = [
        (1, f"{own[0]} {passage} {own[1]}"),
        (2, f"{own[2]} {' '.join(changed)} {own[3]}"),
        (3, f"one line\n{own[4]}  {passage}\t{own[5]}"),
        (4, passage),
    ]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {1: rows[0][1], 2: f"{own[2]} {own[3]}", 3: f"one line\n{own[4]}  {own[5]}", 4: ""}


def test_units_equal_brute_force(spark):
    rng = random.Random(2)
    pool = [sentence(rng, rng.choice([3, 5, 9, 15, 30, 70, 200])) for _ in range(60)]

    def line():
        words = " ".join(rng.choice(pool) for _ in range(rng.randint(1, 5))).split(" ")
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = "changed"
        return " ".join(words)

    rows = [(d, "\n".join(line() for _ in range(rng.randint(1, 3)))) for d in range(70)]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == brute(rows)


def test_units_are_bounded_and_never_the_line():
    rng = random.Random(3)
    for _ in range(300):
        words = " ".join(sentence(rng, rng.choice([1, 2, 8, 50, 300])) for _ in range(rng.randint(1, 4))).encode().split()
        found = line_dedup.units(words)
        assert all(line_dedup.MIN_WORDS <= b - a <= 2 * line_dedup.UNIT_WORDS and len(words) - (b - a) > 1 for a, b in found)
        assert all(x[1] <= y[0] for x, y in zip(found, found[1:]))


def test_short_lines_go_as_exact_copies(spark):
    rng = random.Random(4)
    short = ["Home", "home ", "About us", "about", "one two three four five six seven", "one two three four five six eight", "", " "]
    rows = [(d, "\n".join(rng.choice([*short, sentence(rng, 9)]) for _ in range(rng.randint(0, 6)))) for d in range(60)]
    report = line_dedup.dedup_report(spark.createDataFrame(rows, DOCS)).collect()
    assert {r.doc_id: r.text for r in report} == brute(rows, exact_words=1)
    left = [w for r in report for x in r.text.split("\n") if (w := tuple(x.lower().split()))]
    assert len(left) == len(set(left))
    assert sum(w in {("home",), ("about",), ("about", "us")} for w in left) == 3
