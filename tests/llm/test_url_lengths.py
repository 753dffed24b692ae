"""Long labels and long words in the URL filter."""

import time

from lumenreef.llm import url_filter


def test_long_labels_are_segmented(spark):
    words = spark.createDataFrame([("river", 50), ("stone", 40)], "word string, n long")
    label = "riverstone" * 9 + "casino"
    got = url_filter.segmented_labels(spark.createDataFrame([(label,), ("",)], "label string"), words).collect()
    assert {r.label: r.words for r in got} == {label: ["river", "stone"] * 9 + ["casino"], "": []}


def test_only_whole_words_are_counted(spark):
    html = f"<p>{'x' * 20} {'y' * 21} {'z' * 45} a1bc d\u00e9f</p>"
    got = url_filter.page_words(spark.createDataFrame([(html,)], "html string")).collect()
    assert {r.word: r.n for r in got} == {"x" * 20: 1, "bc": 1, "d\u00e9f": 1}


def test_a_label_of_a_megabyte(spark):
    """Parts of a label go by its number and come from windows, so the work does not grow with its square."""
    words = spark.createDataFrame([("river", 50), ("stone", 40), ("r" * 20, 7)], "word string, n long")
    label = "riverstone" * 100_000
    began = time.monotonic()
    got = url_filter.segmented_labels(spark.createDataFrame([(label,), ("stoneriver",)], "label string"), words).collect()
    assert {r.label: r.words for r in got} == {label: ["river", "stone"] * 100_000, "stoneriver": ["stone", "river"]}
    assert time.monotonic() - began < 60  # about 15 s alone; machines differ


def test_words_across_windows(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "WINDOWS", (19, 7))
    words = spark.createDataFrame([("river", 50), ("stone", 40)], "word string, n long")
    labels = ["river" * n + "stone" * (9 - n) for n in range(9)]
    got = url_filter.segmented_labels(spark.createDataFrame([(x,) for x in labels], "label string"), words).collect()
    assert {r.label: r.words for r in got} == {x: ["river"] * n + ["stone"] * (9 - n) for n, x in enumerate(labels)}


def test_the_model_weighs_more_than_the_seed_list(spark):
    """Words that come with seed words block a host without one; a seed word among words of clean hosts does not."""
    bad = [f"http://{s}-farm-win.org/prize/{k}" for s in ("casino", "poker", "slots") for k in range(12)]
    clean = [f"http://river-stone.org/about/{k}" for k in range(60)]
    asked = ["http://farm-win.org/prize/3", "http://track-river-stone.org/about/us"]
    rows = [(k, u, "<p>river stone farm win prize</p>") for k, u in enumerate(bad + clean + asked)]
    got = {r.host: r.verdict for r in url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string"), rules=()).collect()}
    assert (got["farm-win.org"], got["track-river-stone.org"], got["casino-farm-win.org"], got["river-stone.org"]) == ("block", "allow", "block", "allow")
