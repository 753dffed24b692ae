"""Odd rows through each stage of the pipeline."""

import corpus_pipeline
import pytest
from lumenreef.llm import quality_rules

DIR = "/root/testdata/sf0.001"
NAMES = "doc_id long, text string, lang string, source string, n_chars long, toxicity double, gone string, keys string, went int"
ENDS = [a + b for a in "abcd" for b in "ghijklmnop"]
GOOD = " ".join(f"river{x} stone{x}" for x in ENDS) + "."
OTHER = " ".join(f"table{x} music{x}" for x in ENDS) + "."


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 7, 0.5, "g", "k", 1) for i, t in rows], NAMES)


ROWS = [(1, GOOD), (1, GOOD), (2, None), (3, ""), (None, OTHER), (None, GOOD), (4, GOOD + "\n" + OTHER), (5, "w " * 200_000), (6, GOOD.upper())]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_stages_take_odd_rows(spark, name, stage):
    got = stage(spark, table(spark, ROWS), DIR)
    assert got.columns == list(corpus_pipeline.COLUMNS)
    rows = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    if name == "toxicity":
        assert rows == sorted(ROWS, key=str)
    elif name == "quality rules":
        cascade = quality_rules.Cascade(quality_rules.RULES)
        assert rows == sorted((x for x in ROWS if cascade.first_failing(quality_rules.TextStats(x[1] or "")) is None), key=str)
        assert (1, GOOD) in rows and not {i for i, _ in rows} & {2, 3, 5}
    elif name == "line dedup":
        want = [(1, GOOD), (1, GOOD), (2, None), (3, ""), (None, ""), (None, ""), (4, OTHER), (6, "")]
        assert [x for x in rows if x[0] != 5] == sorted(want, key=str)
    else:
        assert [x for x in rows if x[0] not in (4, 5)] == sorted([(1, GOOD), (1, GOOD), (2, None), (None, OTHER), (None, GOOD)], key=str)


def test_stages_take_an_empty_table(spark):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, table(spark, []), DIR).count() == 0
