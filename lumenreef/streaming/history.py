"""Experiment history on streams: proposals joined as they come, new bests and configurations in the order of iterations."""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lumenreef.functions import policy


def with_proposals(rows: DataFrame, proposals: DataFrame, time: str = "ts", wait: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """``rows`` with the text ``respuesta`` of their proposal, which comes at the same time or up to ``wait`` later.

    Both are streams with run_id, iteracion and the event time ``time``. A row comes out with its proposal at once; without
    one its text is null, which counts as an empty proposal, as soon as the watermarks of both streams (``late`` behind)
    say that none can come. Rows behind their stream's watermark are dropped; state is kept for ``wait`` and ``late`` only.
    """
    answers = proposals.select(F.col("run_id").alias("_run"), F.col("iteracion").alias("_at"), F.col(time).alias("_time"), "respuesta")
    left, right = rows.withWatermark(time, late), answers.withWatermark("_time", late)
    in_time = (F.col("_time") >= F.col(time)) & (F.col("_time") <= F.col(time) + F.expr(f"INTERVAL {wait}"))
    same = (F.col("run_id") == F.col("_run")) & (F.col("iteracion") == F.col("_at"))
    return left.join(right, same & in_time, "left").drop("_run", "_at", "_time")


#: Rows that leave together, as one text.
OUT_ROWS = 10_000
#: Keys of the state, over which runs are dealt.
BUCKETS = 4096


class InOrder(StatefulProcessor):
    """Holds the rows of a run back until the watermark passes them, then hands them on in the order of iterations.

    Rows may arrive in any order, as long as they are not behind the watermark (those are dropped). Runs are dealt over ``BUCKETS``; a bucket
    has one timer for the earliest row it holds, and rows leave its list with the watermark that passed them. Subclasses say
    what is done with a run's rows in order. Rows enter, wait and leave as JSON, many in a text, as a state call, a frame
    or a conversion for each row or run takes longer than the work on it.
    """

    #: Type of the state of a run, carried from row to row.
    state: T.StructType

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._held = handle.getListState("parts", T.StructType([T.StructField("rows", T.StringType())]))
        self._state = handle.getMapState("runs", T.StructType([T.StructField("run_id", T.LongType())]), self.state)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        first = None
        for part in rows:
            self._held.appendValue((f"[{','.join(part['row'].tolist())}]",))
            ms = min(part["ms"].tolist())
            first = ms if first is None else min(first, ms)
        if first is not None:
            self._handle.registerTimer(first)
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        held = [row for (part,) in self._held.get() for row in json.loads(part)]
        due = sorted((row for row in held if row[2] <= now), key=lambda row: row[:2])
        later = [row for row in held if row[2] > now]
        if not due:
            return
        if later:
            self._held.put([(json.dumps(later[k : k + OUT_ROWS]),) for k in range(0, len(later), OUT_ROWS)])
            self._handle.registerTimer(min(row[2] for row in later))
        else:
            self._held.clear()
        out: list[dict] = []
        for run, rows in itertools.groupby(due, key=lambda row: row[0]):
            state, put = self.advance(self._state.getValue((run,)), rows)
            self._state.updateValue((run,), state)
            out += put
        for k in range(0, len(out), OUT_ROWS):
            yield pd.DataFrame({"rows": [json.dumps(out[k : k + OUT_ROWS])]})

    def advance(self, state: tuple | None, rows: Iterable[list]) -> tuple[tuple, list[dict]]:
        """The state after ``rows`` of ``[run_id, iteracion, ms, value]`` of a run in order, and the rows to put out, by name."""
        raise NotImplementedError

    def close(self) -> None:
        pass


def _in_order(rows: DataFrame, value: Column, processor: InOrder, out: str, time: str, late: str) -> DataFrame:
    """``processor`` over ``rows`` by run, with the JSON ``value``; times are rounded up, so a row is passed only when its whole millisecond is.

    Rows without run, iteration or time are left out.
    """
    ms = F.ceil(F.unix_micros(time) / 1000).cast("bigint")
    row = F.concat(F.lit("["), F.concat_ws(",", F.col("run_id").cast("bigint"), F.col("iteracion").cast("bigint"), ms, F.coalesce(value.cast("string"), F.lit("null"))), F.lit("]"))
    held = rows.withWatermark(time, late).where(F.col("run_id").isNotNull() & F.col("iteracion").isNotNull() & F.col(time).isNotNull())
    bucket = F.pmod(F.xxhash64(F.col("run_id").cast("bigint")), F.lit(BUCKETS)).alias("bucket")
    held = held.select(bucket, time, ms.alias("ms"), row.alias("row"))
    packed = held.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType="rows string", outputMode="Append", timeMode="EventTime"
    )
    return packed.select(F.inline(F.from_json("rows", f"array<struct<run_id: bigint, {out}>>", {"mode": "FAILFAST"})))


class BestInOrder(InOrder):
    """Lets through the rows that beat every earlier score of their run, and 0."""

    state = T.StructType([T.StructField("best", T.LongType())])

    def advance(self, state: tuple | None, rows: Iterable[list]) -> tuple[tuple, list[dict]]:
        best, out = (state or (0,))[0], []
        for run, iteration, _, value in rows:
            if value is not None and value > best:
                best = value
                out.append({"run_id": run, "iteracion": iteration, "score": best})
        return (best,), out


def new_best(rows: DataFrame, time: str = "ts", late: str = "10 minutes") -> DataFrame:
    """``run_id, iteracion, score`` of each new best of ``rows(run_id, iteracion, score, ts)``, which arrive in any order.

    Iterations of a run follow each other in event time. A row comes out once the watermark passes it; a row
    behind the watermark is dropped. A null score is no best.
    """
    return _in_order(rows, F.col("score"), BestInOrder(), "iteracion: bigint, score: bigint", time, late)


def after(config: tuple, effect: dict) -> tuple:
    """The configuration after an effect of ``policy.effect``, given as parsed JSON without null fields."""
    out: list[Any] = []
    for name, x in zip(policy.NUMBERS, config):
        f = effect[name]
        x = f["fixed"] if "fixed" in f else x + f["add"]
        out.append(min(x, f["cap"]) if "cap" in f else x)
    listed = effect["priorizar_paises"]
    start = [] if listed["replaced"] else list(config[3])
    return (*out, list(dict.fromkeys(start + listed["items"])))


class ConfigInOrder(InOrder):
    """Puts out the configuration that each iteration of a run uses, and applies its proposal to it."""

    state = T.StructType([*[T.StructField(n, T.LongType()) for n in policy.NUMBERS], T.StructField("priorizar_paises", T.ArrayType(T.StringType()))])

    def advance(self, state: tuple | None, rows: Iterable[list]) -> tuple[tuple, list[dict]]:
        config = tuple(state or (policy.MAX_EVENTS[0], policy.SEARCHES[0], policy.TIMEOUT[0], []))
        out = []
        for run, iteration, _, effect in rows:
            out.append({"run_id": run, "iteracion": iteration, **dict(zip((*policy.NUMBERS, "priorizar_paises"), config))})
            config = after(config, effect)
        return config, out


def trajectory(rows: DataFrame, enricher: bool = False, time: str = "ts", late: str = "10 minutes") -> DataFrame:
    """``policy.trajectory`` of a stream: one row for each step, the configuration it uses, with runs in keyed state.

    ``rows`` has run_id, iteracion, respuesta, eventos, organizadores and the event time, arrives in any order, and is handed
    on as in ``new_best``. The state of a run is its configuration and the rows that the watermark has not passed.
    Checkpoints of the layout with a key for each run are not read.
    """
    effects = policy.steps(rows, enricher, time)
    out = "iteracion: bigint, max_eventos: bigint, busquedas_facebook: bigint, timeout: bigint, priorizar_paises: array<string>"
    return _in_order(effects, F.to_json("effect"), ConfigInOrder(), out, time, late)
