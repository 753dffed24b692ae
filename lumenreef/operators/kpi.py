"""Catalog KPIs: one-pass counts, a weighted score, and predicates on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Weights of the score.
ORGANISER_WEIGHT, EMAIL_WEIGHT, SOURCE_WEIGHT = 2, 3, 10
# Thresholds of the predicates.
FEW_ORGANISERS, MANY_EVENTS, FEW_SOURCES, FEW_EVENTS = 20, 50, 5, 50
GOAL_EVENTS, GOAL_ORGANISERS = 200, 40

METRIC_COLUMNS = ("eventos", "fuentes", "organizadores", "emails", "score")


def score() -> Column:
    """The weighted score of the columns eventos, organizadores, emails and fuentes."""
    c = F.col
    return (
        c("eventos") + c("organizadores") * ORGANISER_WEIGHT + c("emails") * EMAIL_WEIGHT + c("fuentes") * SOURCE_WEIGHT
    ).alias("score")


def _counts(catalog: DataFrame) -> list[Column]:
    """Row, distinct-source, organiser and email counts; 0 for a column that is absent (case matters)."""
    has = set(catalog.columns)
    zero = F.lit(0).cast("bigint")
    return [
        F.count(F.lit(1)).alias("eventos"),
        (F.count_distinct("fuente") if "fuente" in has else F.max(zero)).alias("fuentes"),
        (F.count("organizador") if "organizador" in has else F.max(zero)).alias("organizadores"),
        (F.count("email") if "email" in has else F.max(zero)).alias("emails"),
    ]


def catalog_kpi(catalog: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """KPIs of the whole catalog (one row, all 0 if empty), or of each group of ``by``."""
    found = catalog.groupBy(*by).agg(*_counts(catalog))
    found = found.fillna(0, ["fuentes", "organizadores", "emails"])
    return found.withColumn("score", score())


def needs_enrichment(organisers: int = FEW_ORGANISERS, events: int = MANY_EVENTS) -> Column:
    return (F.col("organizadores") < organisers) & (F.col("eventos") > events)


def goal_reached(events: int = GOAL_EVENTS, organisers: int = GOAL_ORGANISERS) -> Column:
    return (F.col("eventos") >= events) & (F.col("organizadores") >= organisers)


def advice(low_score: int, events: int = MANY_EVENTS, organisers: int = FEW_ORGANISERS, sources: int = FEW_SOURCES) -> Column:
    """Advice codes that apply, comma-joined; what counts as a low score is the caller's choice."""
    return F.concat_ws(
        ",",
        F.when(needs_enrichment(organisers, events), "enrich_events"),
        F.when(F.col("fuentes") < sources, "add_sources"),
        F.when(F.col("score") < low_score, "raise_limits"),
    )


def strategy(few_events: int, many_events: int, few_organisers: int, stagnant: Column) -> Column:
    """Documented strategies that apply, comma-joined."""
    return F.concat_ws(
        ",",
        F.when(F.col("eventos") < few_events, "raise_searches+add_countries+enable_contacts"),
        F.when((F.col("eventos") > many_events) & (F.col("organizadores") < few_organisers), "improve_extraction+search_groups"),
        F.when(stagnant, "change_strategy+vary_countries+lower_searches+raise_timeout"),
    )


# The sources that a catalog is expected to draw on.
KNOWN_SOURCES = ("Goabase", "Facebook", "Instagram", "Songkick", "Eventbrite")


def source_coverage(rows: DataFrame, column: str, expected: Sequence[str] = KNOWN_SOURCES) -> DataFrame:
    """``source, n, expected``: rows of each source, with expected sources that have none."""
    names = rows.sparkSession.createDataFrame([(s,) for s in expected], "source string")
    counted = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("source")).agg(F.count("*").alias("n"))
    joined = counted.join(names.withColumn("expected", F.lit(True)), "source", "full")
    return joined.select("source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("expected", F.lit(False)).alias("expected"))
