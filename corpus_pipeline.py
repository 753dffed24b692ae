"""The corpus pipeline: toxicity, quality rules, line dedup, near-dedup, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage
before it kept. All but the last return the columns of ``documents``; the last
returns a row for each packed piece.

In every stage other columns of its input are left out, so names cannot clash; rows
without doc_id and repeated rows are rows like others; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenreef.llm import line_dedup, near_dedup, packing, quality_rules, toxicity
from lumenreef.llm._scratch import materialise

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5; the model is fitted on their labelled rows.

    Null and empty texts have the model's bias as score. Repeated rows are judged alike.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score_toxicity(_columns(docs), toxicity.fit_toxicity(docs, labels))
    return _columns(scored.where(F.col("toxicity") < 0.5))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects. Null and empty texts have too few words and go."""
    return quality_rules.filter_quality(_columns(docs))


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that repeat an earlier one or nearly so.

    Null texts stay null; a text may become empty. Rows with one doc_id and text lose the same
    lines; rows without doc_id come last in the order.
    """
    return line_dedup.dedup_lines(_columns(docs), exact_words=line_dedup.EXACT_WORDS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group.

    Candidates come from op5's SimHash groups, and from MinHash bands, which hold the alike texts beyond its 4 bits;
    links are those whose sets of five-word shingles have a similarity of 0.8 or more.
    Null and empty texts are one group. Rows without doc_id all stay, and rows that share a kept doc_id.
    """
    return near_dedup.keep_representatives(_columns(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece of a packed sequence; null and empty texts are one end id."""
    return packing.pack(_columns(docs), with_ids=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", keep_quality),
    ("line dedup", cut_repeated_lines),
    ("near-dedup", keep_one_of_each_group),
    ("packing", pack_sequences),
]

#: A trained model and packing by rank have no SQL form. Tests hold the operators, and near-dedup as the
#: stage, against brute force; the stages together against each other and on odd rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
