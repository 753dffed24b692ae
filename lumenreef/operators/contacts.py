"""Contact extraction, and filling gaps without replacing a value."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenreef.operators import kpi
from lumenreef.sources import versions

#: A match starts where a run of its characters starts, or where the match before ended, so a long run is read once.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)([A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+[.][A-Za-z]{2,})"
OWNER = r"&copy; *([^ <]+) "


def emails_in(rows: DataFrame, key: str, text: str) -> DataFrame:
    """``key, email``: every address in a text, repeats included. Null texts have none."""
    return rows.where(F.contains(F.col(text), F.lit("@"))).select(key, F.explode(F.regexp_extract_all(text, F.lit(EMAIL), F.lit(1))).alias("email"))


def first_contacts(rows: DataFrame, key: str, text: str) -> DataFrame:
    """``key, organizador, email``: the first footer owner and address of each text, else null."""

    def first(pattern: str, mark: str):
        found = F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
        return F.when(F.contains(F.col(text), F.lit(mark)), found)

    return rows.select(key, first(OWNER, "&copy;").alias("organizador"), first(EMAIL, "@").alias("email"))


def fill_contacts(catalog: DataFrame, contacts: DataFrame, key: str = "event_id") -> DataFrame:
    """``catalog`` with missing organisers and emails filled; present values and other columns stay.

    Of several contacts of one key the smallest values count. Rows without key stay unfilled.
    """
    found = contacts.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("organizador").alias("_o"), F.min("email").alias("_e"))
    joined = catalog.join(found, key, "left")
    out = {"organizador": "_o", "email": "_e"}
    columns = [F.coalesce(F.col(c), F.col(out[c])).alias(c) if c in out else F.col(c) for c in catalog.columns]
    return joined.select(*columns)


def enrich_then_measure(
    catalog: DataFrame,
    run: str,
    enrich: Callable[[DataFrame], DataFrame],
    organisers: int = kpi.FEW_ORGANISERS,
    events: int = kpi.MANY_EVENTS,
    available: bool = True,
) -> DataFrame:
    """KPIs of each run, measured again after ``enrich`` where a run needs it (and it is available)."""
    before = kpi.catalog_kpi(catalog, [run])
    if not available:
        return before.withColumn("enriched", F.lit(False))
    poor = before.where(kpi.needs_enrichment(organisers, events)).select(run)
    rich = catalog.join(poor, run, "left_anti")
    again = enrich(catalog.join(poor, run, "left_semi"))
    after = kpi.catalog_kpi(again, [run]).withColumn("enriched", F.lit(True))
    return kpi.catalog_kpi(rich, [run]).withColumn("enriched", F.lit(False)).unionByName(after)


def enrich_version(
    spark: SparkSession,
    root: str,
    contacts: DataFrame,
    run: str,
    organisers: int = kpi.FEW_ORGANISERS,
    events: int = kpi.MANY_EVENTS,
    key: str = "event_id",
) -> int:
    """Read the current version of a catalog, fill the runs that need it, and commit the result as the next version.

    Returns the current version's number afterwards: the same one if no run needs it. A commit by another writer in between
    raises ``versions.VersionConflict``; nothing of this one is seen then.
    """
    base = versions.current_version(spark, root)
    catalog = versions.read(spark, root, base)
    poor = kpi.catalog_kpi(catalog, [run]).where(kpi.needs_enrichment(organisers, events)).select(run).withColumn("_poor", F.lit(True))
    if poor.isEmpty():
        return base
    marked = catalog.join(poor, run, "left")
    found = contacts.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("organizador").alias("_o"), F.min("email").alias("_e"))
    news = {"organizador": "_o", "email": "_e"}
    joined = marked.join(found, key, "left")
    filled = [F.coalesce(F.col(c), F.when(F.col("_poor"), F.col(news[c]))).alias(c) if c in news else F.col(c) for c in catalog.columns]
    return versions.commit(joined.select(*filled), root, base)
