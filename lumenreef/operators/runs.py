"""The result of a whole run of the loop, from its metrics and proposals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from lumenreef.functions import policy
from lumenreef.operators import history


def run_results(metrics: DataFrame, proposals: DataFrame, goal: Column, failed: Column, iterations: int = policy.ITERATIONS, enricher: bool = False) -> DataFrame:
    """The best score of each run up to its stop, its iteration, and the configuration used in it.

    ``metrics`` (measured after enrichment, where there was any) ends with the first row of ``goal``, or before the first that
    ``failed``; a missing proposal counts as an empty one. Scores above 0 only, the earliest of equals; a run without one has
    no row.
    """
    kept = history.until_stop(metrics, goal, failed, iterations)
    used = policy.trajectory(history.with_proposals(kept, proposals), enricher, levels=1)
    return history.best_row(kept.select("run_id", "iteracion", "score").join(used, ["run_id", "iteracion"]), *policy.NUMBERS, "priorizar_paises")
