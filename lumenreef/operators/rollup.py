"""KPIs from stored partial results: counts by source that deltas change, and distinct sketches that merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenreef.operators import kpi

COUNTS = ("eventos", "organizadores", "emails")
#: Binary logarithm of a sketch's registers: 4096 of them, a standard error of about 1.6 %.
LG_K = 12


def by_source(catalog: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by, fuente`` and the counts of events, organisers and e-mails: what KPIs can be made of without the catalog."""
    return catalog.groupBy(*by, "fuente").agg(F.count("*").alias("eventos"), F.count("organizador").alias("organizadores"), F.count("email").alias("emails"))


def filled(rows: DataFrame, by: Sequence[str], organiser: str = "organizador", email: str = "email") -> DataFrame:
    """The change of ``by_source`` when ``rows``, which lack a value, get those of their columns ``organiser`` and ``email``.

    ``rows`` has by, fuente and, for a value that was missing and is filled, the new value, else null. No events are added.
    """
    changed = rows.where(F.col(organiser).isNotNull() | F.col(email).isNotNull())
    counts = F.lit(0).cast("bigint").alias("eventos"), F.count(organiser).alias("organizadores"), F.count(email).alias("emails")
    return changed.groupBy(*by, "fuente").agg(F.lit(0).alias("_"), *counts).drop("_")


def merged(*parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Partial counts and changes of them added up; one row for each group and source."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy(*by, "fuente").agg(*[F.sum(c).alias(c) for c in COUNTS])


def kpis(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """KPIs of each group from merged partial counts; a source counts if it has events."""
    sources = F.count(F.when(F.col("eventos") > 0, F.col("fuente"))).alias("fuentes")
    found = parts.groupBy(*by).agg(F.sum("eventos").alias("eventos"), sources, F.sum("organizadores").alias("organizadores"), F.sum("emails").alias("emails"))
    return found.withColumn("score", kpi.score())


def enriched_kpis(rows: DataFrame, run: str, organisers: int = kpi.FEW_ORGANISERS, events: int = kpi.MANY_EVENTS) -> DataFrame:
    """KPIs of each run, after filling where a run needs it, and ``enriched``; one pass over ``rows``.

    ``rows`` is a catalog with ``nuevo_organizador`` and ``nuevo_email``, the values that would fill a gap. Whether a run
    needs them is known once its own are counted, so both are counted together and the change is added where it applies.
    """
    gaps = {f"mas_{name}": F.count(F.when(F.col(c).isNull(), F.col(f"nuevo_{c}"))) for c, name in (("organizador", "organizadores"), ("email", "emails"))}
    counts = {"eventos": F.count("*"), "organizadores": F.count("organizador"), "emails": F.count("email"), **gaps}
    parts = rows.groupBy(run, "fuente").agg(*[c.alias(n) for n, c in counts.items()])
    whole = parts.groupBy(run).agg(F.count("fuente").alias("fuentes"), *[F.sum(n).alias(n) for n in counts])
    needs = kpi.needs_enrichment(organisers, events)

    def after(name: str) -> Column:
        return (F.col(name) + F.when(F.col("enriched"), F.col(f"mas_{name}")).otherwise(0)).alias(name)

    marked = whole.withColumn("enriched", needs).select(run, "enriched", "eventos", "fuentes", after("organizadores"), after("emails"))
    return marked.select(run, *[c for c in kpi.METRIC_COLUMNS if c != "score"], kpi.score(), "enriched")


def sketched(catalog: DataFrame, by: Sequence[str], lg_k: int = LG_K) -> DataFrame:
    """KPIs of each group with a sketch ``fuentes_hll`` in place of the number of sources; it has a fixed size and merges."""
    return catalog.groupBy(*by).agg(*_sketch_columns(lg_k))


def _sketch_columns(lg_k: int = LG_K) -> list[Column]:
    return [F.count("*").alias("eventos"), F.hll_sketch_agg("fuente", F.lit(lg_k)).alias("fuentes_hll"), F.count("organizador").alias("organizadores"), F.count("email").alias("emails")]


def rolled_up(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sketched KPIs of finer groups merged into those of ``by``; the catalog is not read again."""
    return sketches.groupBy(*by).agg(*[F.hll_union_agg("fuentes_hll").alias("fuentes_hll") if c == "fuentes_hll" else F.sum(c).alias(c) for c in ("eventos", "fuentes_hll", "organizadores", "emails")])


def estimated(sketches: DataFrame) -> DataFrame:
    """Sketched KPIs with the number of sources as estimated from the sketch, and the score.

    The estimate is that of a merged sketch, also for one that was never merged, so it does not depend on how sketches were
    rolled up.
    """
    others = [c for c in sketches.columns if c not in ("fuentes_hll", *COUNTS)]
    sources = F.hll_sketch_estimate(F.hll_union("fuentes_hll", "fuentes_hll")).alias("fuentes")
    return sketches.select(*others, "eventos", sources, "organizadores", "emails").withColumn("score", kpi.score())


def windowed(events: DataFrame, time: str = "ts", width: str = "1 day", late: str = "10 minutes", lg_k: int = LG_K) -> DataFrame:
    """Sketched KPIs of each tumbling window; on a stream the state of a window has a fixed size, however many sources it has."""
    rows = events.withWatermark(time, late) if events.isStreaming else events
    return rows.groupBy(F.window(time, width).alias("w")).agg(*_sketch_columns(lg_k)).withColumn("inicio", F.col("w.start")).drop("w")
