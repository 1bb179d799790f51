"""Streams whose keys share the state of a bucket, beside the same streams with a state for each key."""

import datetime

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from test_sketches import at as at_noon
from test_streams import EVENT, HISTORY, NOON, _rows

from ordertide.operators import quality
from ordertide.plans import registry, replay
from ordertide.session import stream_session
from ordertide.sources import readers
from ordertide.streaming import arrival, buckets, transitions
from ordertide.streaming.arrival import out_of_order_stream
from ordertide.streaming.sinks import finish, start_parquet
from ordertide.streaming.transitions import order_findings

ARRIVAL = "order_id string, event_id string, event_type string, event_time timestamp, ingestion_time timestamp"


def _run(spark, session, folder, parts, schema, build, name):
    """The rows of a stream that is run again after each part."""
    empty = spark.createDataFrame([], schema).schema
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{folder}/{name}-in")
        stream = build(readers.stream_parquet(session, f"{folder}/{name}-in", empty))
        finish(start_parquet(stream, f"{folder}/{name}-out", f"{folder}/{name}-checkpoint"))
    return spark.read.parquet(f"{folder}/{name}-out")


def test_findings_by_buckets(spark, tmp_path):
    session = stream_session(spark, 2)
    timed = [r for r in HISTORY if r[2] is not None]
    cuts = [(-1, 2), (2, 25), (25, 300), (300, 9_000), (9_000, 30_000)]
    parts = [[r for r in timed if low <= (r[2] - NOON).total_seconds() / 60 < high][::-1] for low, high in cuts]
    early = F.col("at") <= F.lit(NOON + datetime.timedelta(minutes=20_161 - 15))  # what the watermark has passed
    want = _rows(order_findings(spark.createDataFrame(timed, EVENT)).filter(early))
    found = _run(spark, session, tmp_path, parts, EVENT, lambda events: order_findings(events, buckets=3), "hard")
    assert _rows(found) == want
    kept = buckets.states(session, f"{tmp_path}/hard-checkpoint", "orders", transitions.ORDERS).collect()
    assert [(r.order_id, r.events, r.stage, r.ready_us) for r in kept] == [("returns", 2, "order_confirmed", None)]


def test_arrival_order_by_buckets(spark, tmp_path):
    session = stream_session(spark, 2)
    at = at_noon
    rows = [("a", f"e{k}", "x", None if k == 4 else at(m), at(k)) for k, m in enumerate([0, 5, 3, 5, 1, 9, 8, 2])]
    rows += [(None, "n", "x", at(0), at(1)), ("b", "b1", None, at(3), at(2)), ("b", "b2", None, at(2), at(2))]
    rows += [("b", "b3", "x", at(1), None), ("n", None, None, None, at(3)), ("m", None, "x", at(5), at(3)), ("m", None, "x", at(4), at(4))]
    rows += [("c", "c1", "x", at(60 * 24 * 6), at(60 * 24 * 6)), ("a", "a9", "x", at(4), at(60 * 24 * 6 + 1))]
    rows += [("d", "d1", "x", datetime.datetime(2300, 1, 1), at(60 * 24 * 10)), ("d", "d2", "x", at(0), at(60 * 24 * 10))]
    rows += [("b", "b4", "x", at(0), at(60 * 24 * 20)), ("d", "d3", "x", at(1), at(60 * 24 * 20))]  # b is forgotten by then
    rows.sort(key=lambda r: r[4] or at(0))
    parts = [rows[:7], rows[7:-4], rows[-4:-2], rows[-2:]]
    want = [r for r in quality.out_of_order(spark.createDataFrame(rows, ARRIVAL)).collect() if r.event_id != "b4"]
    for name, n in (("keys", None), ("buckets", 2)):
        found = _run(spark, session, tmp_path, parts, ARRIVAL, lambda events: out_of_order_stream(events, buckets=n), name)
        assert sorted(map(repr, found.collect())) == sorted(map(repr, want)) and len(want) == 8
    kept = buckets.states(session, f"{tmp_path}/buckets-checkpoint", "latest_of_keys", arrival.TIMES).collect()
    assert sorted(r.key for r in kept) == ["b", "d"]


def test_queries_keep_a_state_for_each_bucket(spark, tmp_path, monkeypatch):
    """Six hundred orders make as many states, and calls for them, as there are buckets, and the rows of the batch form."""
    kinds = F.element_at(F.array(*map(F.lit, ["click", "error", "purchase", "view"])), (F.col("id") % 4 + 1).cast("int"))
    ts = F.timestamp_micros(F.unix_micros(F.lit(NOON).cast("timestamp")) + F.col("id") * 977_000_000)
    events = spark.range(600).select(
        F.col("id").alias("event_id"), ts.alias("ts"), (F.col("id") % 90).alias("user_id"), kinds.alias("event_type")
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    ended = []
    monkeypatch.setattr(replay, "finish", lambda query: (finish(query), ended.append(query)))
    monkeypatch.setattr(registry, "BUCKETS", 4)
    for name, batch in (("lifecycle_transitions_stream", "lifecycle_transitions"), ("out_of_order_stream", "out_of_order_swapped")):
        got, want = (registry.QUERIES[n](spark, str(tmp_path)).collect() for n in (name, batch))
        assert sorted(map(repr, got)) == sorted(map(repr, want)) and want
    kept = [p["stateOperators"][0]["numRowsTotal"] for query in ended for p in query.recentProgress]
    assert len(ended) == 4 and 0 < max(kept) <= 4 * 4


def test_times_that_pandas_cannot_hold(spark, tmp_path):
    session = stream_session(spark, 2)
    far, old = datetime.datetime(9000, 1, 1), datetime.datetime(1500, 1, 1)
    events = [("o", "order_created", at_noon(0)), ("o", "order_delivered", at_noon(1)), ("far", "order_created", far)]
    want = sorted(r for r in _rows(order_findings(spark.createDataFrame(events, EVENT))) if "'far'" not in r)
    found = _run(spark, session, tmp_path, [events], EVENT, lambda e: order_findings(e, buckets=2), "far")
    assert _rows(found) == want and len(want) == 2
    rows = [("o", "e1", "x", far, at_noon(0)), ("o", "e2", "x", old, at_noon(1)), ("p", "e3", "x", old, far)]
    found = _run(spark, session, tmp_path, [rows], ARRIVAL, lambda e: out_of_order_stream(e, buckets=2), "arrival")
    assert [(r.event_id, r.event_time, r.latest_before) for r in found.collect()] == [("e2", old, far)]


def test_packed_rows_come_back():
    schema = pa.schema([("name", pa.string()), ("n", pa.int64()), ("b", pa.bool_())])
    rows = [("a", None, True), (None, 2**62 + 1, None), ("", -(2**63), False)]
    assert list(buckets.unpack(buckets.pack(buckets.framed(rows, schema.names), schema))) == rows
    whole = pd.DataFrame({"name": ["x"], "n": [2**62 + 1], "b": [True]})
    assert list(buckets.unpack(buckets.pack(whole, schema))) == [("x", 2**62 + 1, True)]
