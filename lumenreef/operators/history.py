"""Experiment history: new bests, stops, changes and stagnation, always by run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F


def _run() -> WindowSpec:
    return W.partitionBy("run_id")


def _ordered() -> WindowSpec:
    return _run().orderBy("iteracion")


def _before() -> WindowSpec:
    return _ordered().rowsBetween(W.unboundedPreceding, -1)


def mark_new_best(rows: DataFrame) -> DataFrame:
    """``new_best``: the score is above 0 and above every earlier score of the run."""
    best = F.coalesce(F.max("score").over(_before()), F.lit(0))
    return rows.withColumn("new_best", F.coalesce(F.col("score") > F.greatest(best, F.lit(0)), F.lit(False)))


def best_row(rows: DataFrame, *columns: str) -> DataFrame:
    """``run_id``, best score and its iteration and ``columns``; the earliest of equals, scores above 0 only."""
    key = F.struct("score", (-F.col("iteracion")).alias("i"))
    good = rows.where("score > 0")
    return good.groupBy("run_id").agg(
        F.max("score").alias("score"), *[F.max_by(c, key).alias(c) for c in ("iteracion", *columns)]
    )


def until_stop(rows: DataFrame, goal: Column, failed: Column, iterations: int) -> DataFrame:
    """Rows up to the loop's end: the first goal row stays, the first failed row goes, and all after them."""
    reached = F.min(F.when(goal, F.col("iteracion"))).over(_run())
    broken = F.min(F.when(failed, F.col("iteracion"))).over(_run())
    marked = rows.where(F.col("iteracion") <= iterations).withColumns({"_g": reached, "_f": broken})
    open_end = (F.col("_g").isNull() | (F.col("iteracion") <= F.col("_g"))) & (F.col("_f").isNull() | (F.col("iteracion") < F.col("_f")))
    return marked.where(open_end).drop("_g", "_f")


def with_proposals(rows: DataFrame, proposals: DataFrame) -> DataFrame:
    """``rows`` with the text ``respuesta`` of their proposal; null, which counts as an empty proposal, where none came."""
    answers = proposals.select("run_id", "iteracion", "respuesta")
    return rows.join(answers, ["run_id", "iteracion"], "left")


def mark_changes(rows: DataFrame, *columns: str) -> DataFrame:
    """``changed``: some column differs from the run's row before; false in its first row."""
    changed = F.lit(False)
    for c in columns:
        changed = changed | ~F.col(c).eqNullSafe(F.lag(c).over(_ordered()))
    return rows.withColumn("changed", changed & (F.row_number().over(_ordered()) > 1))


def mark_stagnation(rows: DataFrame) -> DataFrame:
    """``since_best``: iterations since the run's last new best (since its start, if there was none)."""
    marked = mark_new_best(rows)
    upto = _ordered().rowsBetween(W.unboundedPreceding, 0)
    last = F.last(F.when(F.col("new_best"), F.col("iteracion")), ignorenulls=True).over(upto)
    return marked.withColumn("since_best", F.col("iteracion") - F.coalesce(last, F.lit(0)))


def score_by_config(rows: DataFrame, *columns: str) -> DataFrame:
    """Number, mean, least and largest score of each configuration."""
    return rows.groupBy(*columns).agg(
        F.count("*").alias("n"), F.avg("score").alias("avg_score"), F.min("score").alias("min_score"), F.max("score").alias("max_score")
    )
