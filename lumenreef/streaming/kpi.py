"""KPIs and new bests on streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lumenreef.operators import kpi


def windowed_kpi(events: DataFrame, time: str = "ts", width: str = "1 day", late: str = "10 minutes") -> DataFrame:
    """KPIs of each tumbling window of ``events(ts, fuente, organizador, email)``.

    On a stream, exact distinct counts come from the set of a window's sources. Rows
    behind the watermark are dropped in append mode; complete mode keeps all.
    """
    rows = events.withWatermark(time, late) if events.isStreaming else events
    found = rows.groupBy(F.window(time, width).alias("w")).agg(
        F.count(F.lit(1)).alias("eventos"),
        F.size(F.collect_set("fuente")).cast("bigint").alias("fuentes"),
        F.count("organizador").alias("organizadores"),
        F.count("email").alias("emails"),
    )
    return found.select(F.col("w.start").alias("inicio"), "eventos", "fuentes", "organizadores", "emails").withColumn("score", kpi.score())


class BestSoFar(StatefulProcessor):
    """Holds the best score of a run and lets through the rows that beat it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._best = handle.getValueState("best", T.StructType([T.StructField("score", T.LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best = self._best.get()[0] if self._best.exists() else 0
        for part in rows:
            part = part.sort_values("iteracion")
            top = part["score"].cummax().shift(fill_value=0).clip(lower=best)
            yield part.loc[part["score"] > top, ["run_id", "iteracion", "score"]]
            best = max(best, int(part["score"].max()))
        self._best.update((best,))

    def close(self) -> None:
        pass


def stream_new_best(rows: DataFrame) -> DataFrame:
    """``run_id, iteracion, score`` of each new best of a stream that arrives in the order of iterations."""
    return rows.groupBy("run_id").transformWithStateInPandas(
        statefulProcessor=BestSoFar(), outputStructType="run_id bigint, iteracion bigint, score bigint", outputMode="Append", timeMode="None"
    )
