"""Streams over several micro-batches: joins with late and missing rows, any order of arrival, restarts."""

import json
import random
import time
from datetime import UTC, datetime

import pandas as pd
import pytest
from lumenreef.functions import policy
from lumenreef.operators import history
from lumenreef.streaming import history as streams


class Feed:
    """A folder of files, each a micro-batch, and the runs of a query over it."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema = spark, str(path), schema
        spark.createDataFrame([], schema).write.parquet(self.path)

    def add(self, *rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.path)
        time.sleep(1.1)  # files are taken in the order of their times

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(self.path)


def run(stream, out, state):
    """Run a query over all that is there; return the rows of its batches so far."""
    spark = stream.sparkSession

    def save(batch, number):
        batch.write.mode("overwrite").parquet(f"{out}/batch={number:04d}")

    stream.writeStream.outputMode("append").option("checkpointLocation", str(state)).foreachBatch(save).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(str(out))


def at(minute):
    """An event time, minutes after a fixed one."""
    return datetime.fromtimestamp(1_700_000_000 + 60 * minute, UTC)


HISTORY = "run_id long, iteracion long, ts timestamp, eventos long"
ANSWERS = "run_id long, iteracion long, ts timestamp, respuesta string"


def test_proposals_join_as_they_come(spark, tmp_path):
    rows, answers = Feed(spark, tmp_path / "h", HISTORY), Feed(spark, tmp_path / "p", ANSWERS)
    t = {m: at(m) for m in (0, 1, 5, 30, 61, 90, 200, 201, 400, 800, 1200)}
    rows.add((1, 1, t[0], 10), (1, 2, t[1], 11), (1, 3, t[1], 12), (None, 4, t[1], 13))
    answers.add((1, 1, t[5], "a"), (1, 3, t[90], "beyond the wait"))
    rows.add((1, 4, t[200], 14))
    answers.add((1, 2, t[61], "b"), (1, 4, t[201], "d"))
    out, state = tmp_path / "out", tmp_path / "state"
    run(streams.with_proposals(rows.stream(), answers.stream()), out, state)
    # The watermarks are now beyond the first rows: what is behind them is dropped, on both sides.
    rows.add((1, 9, t[5], 99), (1, 5, t[400], 15))
    answers.add((1, 9, t[5], "late"), (1, 3, t[30], "late"), (7, 7, t[400], "x"))
    rows.add((7, 1, t[800], 0))
    answers.add((7, 1, t[800], "y"))
    rows.add((7, 2, t[1200], 0))
    answers.add((7, 2, t[1200], "z"))
    got = run(streams.with_proposals(rows.stream(), answers.stream()), out, state).collect()  # goes on from its checkpoint
    found = {(r.run_id, r.iteracion): r.respuesta for r in got if r.run_id != 7}
    assert found == {(1, 1): "a", (1, 2): "b", (1, 3): None, (None, 4): None, (1, 4): "d", (1, 5): None}
    assert len(got) == len(set(got))


def shuffled_batches(rng, rows, batches, window):
    """``rows`` (with event minutes) in batches, out of order by up to ``window`` minutes, never behind the watermark."""
    order = sorted(rows, key=lambda r: r[2] + rng.uniform(0, window))
    size = -(-len(order) // batches)
    return [order[k : k + size] for k in range(0, len(order), size)]


def test_new_bests_in_any_order_of_arrival(spark, tmp_path):
    rng = random.Random(6)
    feed = Feed(spark, tmp_path / "in", "run_id long, iteracion long, ts timestamp, score long")
    rows = [(k % 5, k // 5 + 1, k, rng.randrange(0, 100 + k)) for k in range(150)]
    batches = shuffled_batches(rng, rows, 5, 40)
    assert batches[0] != sorted(batches[0], key=lambda r: r[2])
    for batch in batches[:3]:
        feed.add(*[(a, b, at(m), s) for a, b, m, s in batch])
    out, state = tmp_path / "out", tmp_path / "state"
    query = lambda: streams.new_best(feed.stream(), late="60 minutes")
    early = run(query(), out, state).select("run_id", "iteracion", "score").collect()
    for batch in batches[3:]:
        feed.add(*[(a, b, at(m), s) for a, b, m, s in batch])
    feed.add((99, 1, at(10_000), 0))  # moves the watermark past all
    feed.add((3, 1001, at(0), 10**6))  # behind it: dropped
    got = run(query(), out, state).select("run_id", "iteracion", "score").collect()
    whole = spark.createDataFrame([(a, b, s) for a, b, _, s in rows], "run_id long, iteracion long, score long")
    want = history.mark_new_best(whole).where("new_best").select("run_id", "iteracion", "score").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert early and set(early) <= set(got)


@pytest.mark.parametrize("enricher", [False, True])
def test_configurations_on_a_stream_and_after_a_restart(spark, tmp_path, enricher):
    from test_policy import random_steps

    rng = random.Random(11)
    schema = "run_id long, iteracion long, ts timestamp, respuesta string, eventos long, organizadores long"
    feed = Feed(spark, tmp_path / "in", schema)
    texts = random_steps(rng, 120)
    rows = [(k % 4, k // 4 + 1, k, texts[k], 60, rng.choice([5, 30])) for k in range(120)]
    batches = shuffled_batches(rng, rows, 4, 20)
    out, state = tmp_path / "out", tmp_path / "state"
    query = lambda: streams.trajectory(feed.stream(), enricher, late="30 minutes")
    for batch in batches[:2]:
        feed.add(*[(a, b, at(m), *x) for a, b, m, *x in batch])
    first = run(query(), out, state).count()
    for batch in batches[2:]:
        feed.add(*[(a, b, at(m), *x) for a, b, m, *x in batch])
    feed.add((99, 1, at(10_000), "{}", 0, 0))
    put = run(query(), out, state)
    assert 0 < first < len(rows) == put.count()
    plain = spark.createDataFrame([(a, b, *x) for a, b, _, *x in rows], "run_id long, iteracion long, respuesta string, eventos long, organizadores long")
    want = policy.trajectory(plain, enricher)
    assert sorted(map(str, put.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    # Over all batches each run's steps came out in order.
    spans = put.groupBy("run_id", "batch").agg({"iteracion": "min"}).collect()
    assert all((a[1] < b[1]) == (a[2] < b[2]) for a in spans for b in spans if a.run_id == b.run_id and a.batch != b.batch)


def test_state_calls_follow_texts_and_runs_not_rows():
    """2,000 rows of 4 runs that share a bucket: a state call for each text and run, none for each row."""
    calls, stored = [], {"runs": {}, "parts": []}

    class State:
        def __init__(self, name):
            self.name = name

        def __getattr__(self, call):
            def done(*args):
                calls.append(call)
                if call == "appendValue":
                    stored["parts"].append(args[0])
                if call == "updateValue":
                    stored["runs"][args[0]] = args[1]
                return {"getValue": stored["runs"].get(args[0]) if args else None, "get": iter(stored["parts"])}.get(call)

            return done

    class Handle:
        getListState = getMapState = lambda self, name, *_: State(name)

        def registerTimer(self, ms):
            calls.append(ms)

    class Watermark:
        def getCurrentWatermarkInMs(self):
            return 10**6

    rng = random.Random(4)
    rows = [(k % 4, k // 4, k, rng.randrange(1000)) for k in range(2000)]
    rng.shuffle(rows)
    best = streams.BestInOrder()
    best.init(Handle())
    frame = pd.DataFrame({"ms": [r[2] for r in rows], "row": [f"[{','.join(map(str, r))}]" for r in rows]})
    best.handleInputRows((0,), iter([frame]), None)
    out = [r for part in best.handleExpiredTimer((0,), Watermark(), None) for text in part["rows"] for r in json.loads(text)]
    want = []
    for run in range(4):
        top = 0
        for _, at, _, score in sorted(r for r in rows if r[0] == run):
            if score > top:
                want.append({"run_id": run, "iteracion": at, "score": (top := score)})
    assert out == want and len(calls) <= 2 * 4 + 4
