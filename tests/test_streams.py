"""State, restarts and crashes of streams on hand-made feeds."""

import datetime

import pyarrow as pa
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ordertide.operators import panes, windows
from ordertide.schemas import COURIER_EVENTS, COURIER_FEED, ORDER_EVENTS, ORDER_FEED, ORDER_RECORD
from ordertide.session import stream_session
from ordertide.sources import avro_wire, kafka, readers, sinks
from ordertide.streaming import fan_out, quarantine
from ordertide.streaming.sinks import finish, start_parquet
from ordertide.streaming.transitions import order_findings

NOON = datetime.datetime(2024, 3, 1, 12)
EVENT = "order_id string, event_type string, event_time timestamp"
COLUMNS = ("order_id", "kind", "at", "from_event", "event", "events", "illegal")


def at(minutes):
    return NOON + datetime.timedelta(minutes=minutes)


def order(order_id, *steps):
    return [(order_id, kind, None if minute is None else at(minute)) for minute, kind in steps]


HISTORY = [
    *order("good", (0, "order_created"), (1, "order_confirmed"), (1, "order_preparing"), (9, "order_ready_for_pickup")),
    *order("good", (12, "courier_assigned_order"), (15, "order_picked_up"), (30, "order_delivered")),
    *order("good", (30, "order_delivered")),  # a copy
    *order("skips", (0, "order_created"), (5, "order_ready_for_pickup"), (400, "order_delivered")),  # stuck, silent, back
    *order("edge", (0, "order_created"), (240, "order_confirmed"), (480, "order_preparing")),  # silent for the limit exactly
    *order("returns", (0, "order_created"), (10_080, "order_confirmed"), (20_161, "order_confirmed")),  # forgotten once
    *order("tie", (3, "order_preparing"), (3, "order_confirmed"), (3, "order_created")),
    *order("cancelled", (0, "order_created"), (1, "order_cancelled_user"), (2, "order_confirmed")),
    *order("late", (7, "order_ready_for_pickup"), (22, "courier_assigned_order")),  # taken at the deadline
    *order("unknown", (0, "order_teleported"), (None, "order_created")),
    (None, "order_created", at(0)),
    ("typeless", None, at(0)),
]


def _rows(df):
    return sorted(repr(tuple(r[c] for c in COLUMNS)) for r in df.collect())


def test_findings_of_known_orders(spark):
    found = order_findings(spark.createDataFrame(HISTORY, EVENT)).collect()
    of = {}
    for r in found:
        of.setdefault(r.order_id, []).append((r.kind, (r.at - NOON).total_seconds() / 60, r.from_event, r.event, r.illegal))
    assert of["good"] == [("quiet", 270, None, "order_delivered", 0)]
    assert sorted(of["skips"], key=lambda f: f[1]) == [
        ("illegal", 5, "order_created", "order_ready_for_pickup", None),
        ("stuck", 20, None, "order_ready_for_pickup", None),
        ("quiet", 245, None, "order_ready_for_pickup", 1),
        ("illegal", 400, "order_ready_for_pickup", "order_delivered", None),
        ("quiet", 640, None, "order_delivered", 2),
    ]
    assert of["edge"] == [("quiet", 720, None, "order_preparing", 0)]
    assert [f for f in of["returns"] if f[0] == "illegal"] == [("illegal", 20_161, None, "order_confirmed", None)]
    assert of["tie"] == [("quiet", 243, None, "order_preparing", 0)]
    assert [f[2:4] for f in of["cancelled"] if f[0] == "illegal"] == [("order_cancelled_user", "order_confirmed")]
    assert "stuck" not in {f[0] for f in of["late"]}
    assert not {"unknown", None, "typeless"} & set(of)
    with pytest.raises(ValueError):
        order_findings(spark.createDataFrame(HISTORY, EVENT), minutes=300)


def test_findings_do_not_depend_on_arrival(spark, tmp_path):
    """Slices in event-time order, each internally shuffled and restarted, equal the batch; state is read back."""
    session = stream_session(spark, 2)
    timed = [r for r in HISTORY if r[2] is not None]
    cuts = [(-1, 2), (2, 25), (25, 300), (300, 9_000), (9_000, 30_000)]
    rows_before = None
    for low, high in cuts:
        part = [r for r in timed if low <= (r[2] - NOON).total_seconds() / 60 < high]
        spark.createDataFrame(part[::-1], EVENT).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = readers.stream_parquet(session, f"{tmp_path}/in", spark.createDataFrame([], EVENT).schema)
        finish(start_parquet(order_findings(stream), f"{tmp_path}/out", f"{tmp_path}/checkpoint"))
        state = session.read.format("statestore").option("stateVarName", "order").load(f"{tmp_path}/checkpoint")
        rows_before = {r.key.order_id: r.value for r in state.collect()}
    # only orders of the last days are still known, the others are forgotten
    assert set(rows_before) == {"returns"} and rows_before["returns"].events == 2
    metadata = session.read.format("state-metadata").load(f"{tmp_path}/checkpoint").collect()
    assert {r.numPartitions for r in metadata} == {2}
    got = spark.read.parquet(f"{tmp_path}/out")
    want = order_findings(spark.createDataFrame(timed, EVENT))
    early = F.col("at") <= F.lit(at(20_161 - 15))  # what the watermark has passed
    assert _rows(got) == _rows(want.filter(early))


def _orders(spark, rows):
    names = ORDER_EVENTS.names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ORDER_EVENTS)


def _event(number, minute, kind="order_created", **more):
    known = dict(event_id=f"E{number}", event_type=kind, event_time=at(minute), ingestion_time=at(minute))
    known |= dict(order_id=f"O{number}", user_zone_id=f"Z{number % 3}", restaurant_zone_id="R1", anomaly_flag=number % 4 == 0)
    return known | more


@pytest.fixture()
def order_rows():
    first = [_event(k, k) for k in range(20)] + [_event(100 + k, k + 7, "order_delivered", actual_delivery_time=30.0) for k in range(9)]
    first += [first[3], first[3], _event(50, 4, "order_ready_for_pickup"), _event(51, 4, user_zone_id=None)]
    second = [_event(200 + k, 30 + k) for k in range(10)] + first[:5]  # copies of an earlier batch
    second += [_event(300, -6000), _event(301, 0, event_time=None), _event(302, 1, "order_ready_for_pickup", restaurant_zone_id=None)]
    return first, second


def _send(spark, topic, rows):
    messages = kafka.messages(sinks.iso_times(_orders(spark, rows)), ORDER_FEED)
    messages.coalesce(1).write.mode("append").parquet(topic)


def _run(session, folder, tables=None):
    raw = readers.stream_parquet(session, f"{folder}/topic", "key binary, value binary")
    query = fan_out.start_fan_out(raw, ORDER_FEED, f"{folder}/out", f"{folder}/checkpoint", tables=tables)
    finish(query)
    return query


def _assert_outputs(spark, folder, rows):
    once = _orders(spark, rows).dropDuplicates(["event_id"])
    out = fan_out.outputs(spark, f"{folder}/out")
    assert sorted(r.event_id for r in out["orders"].collect()) == sorted(r["event_id"] for r in rows)
    none = spark.createDataFrame([], COURIER_EVENTS)
    want = {
        "kpi_orders_5min_tumbling": windows.orders_tumbling_kpi(once),
        "kpi_orders_10min_hop5": windows.orders_hopping_kpi(once),
        "kpi_zone_health": windows.zone_health(once, none),
        "kpi_anomaly_zones": windows.anomaly_zones(once),
    }
    for name, expected in want.items():
        got = out[name].select(*expected.columns)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect())), name
    assert fan_out.closed(out["kpi_orders_5min_tumbling"], at(10)).agg(F.max("window_end")).first()[0] == at(10)


def test_fan_out_reads_once_and_survives_crashes(spark, tmp_path, order_rows):
    first, second = order_rows
    session = stream_session(spark, 2)
    _send(spark, f"{tmp_path}/topic", first)
    query = _run(session, tmp_path)
    assert sum(p["numInputRows"] for p in query.recentProgress) == len(first)  # one read for all tables
    _assert_outputs(spark, tmp_path, first)
    _send(spark, f"{tmp_path}/topic", second)

    def crash(rows):
        raise RuntimeError("between two tables")

    broken = dict(fan_out.PANES[ORDER_FEED]) | {"panes_waiting": crash}
    with pytest.raises(Exception, match="between two tables"):
        _run(session, tmp_path, broken)
    half = spark.read.parquet(f"{tmp_path}/out/panes_orders").filter("batch_id = 1").count()
    assert half > 0  # the crash came after one table and before the next
    _run(session, tmp_path)
    _run(session, tmp_path)  # nothing new: nothing is added
    _assert_outputs(spark, tmp_path, first + second)


def test_fan_out_keeps_a_batch_in_its_archive_alone(spark, tmp_path, order_rows, monkeypatch):
    seen, unseen = [], fan_out.unseen
    rows = _orders(spark, order_rows[0])

    def spy(kept, archive, batch_id):
        seen.append((rows.is_cached, kept.columns, kept._jdf.queryExecution().executedPlan().toString()))
        return unseen(kept, archive, batch_id)

    monkeypatch.setattr(fan_out, "unseen", spy)
    fan_out.batch_writer(ORDER_FEED, f"{tmp_path}/out")(rows, 0)
    _assert_outputs(spark, tmp_path, order_rows[0])
    own = []
    fan_out.batch_writer(ORDER_FEED, f"{tmp_path}/own", {"own": lambda fresh: own.append(fresh.columns) or fresh})(rows, 0)
    (cached, columns, plan), (_, every, _) = seen
    assert not cached and columns == fan_out.READ[ORDER_FEED] and "parquet" in plan and "courier_id" not in plan
    assert every == ORDER_EVENTS.names and sorted(own[0]) == sorted(every)
    fan_out.batch_writer(ORDER_FEED, f"{tmp_path}/none")(rows.limit(0), 0)
    assert fan_out.outputs(spark, f"{tmp_path}/none")["orders"].count() == 0


def test_payloads_that_are_all_json_cost_the_avro_decoder_nothing(monkeypatch):
    sizes, cursor = [], avro_wire._Cursor
    monkeypatch.setattr(avro_wire, "_Cursor", lambda payloads: sizes.append(len(payloads)) or cursor(payloads))
    missing = pa.array([None] * 5000, pa.binary())
    got, mixed = (avro_wire.decode_batch(payloads, ORDER_RECORD) for payloads in (missing, pa.array([None, b"?"], pa.binary())))
    assert sizes == [0, 2] and got.type == mixed.type and len(got) == 5000 and got.null_count == mixed.null_count == 0
    assert all(got.field(name).null_count == 5000 for name, _ in ORDER_RECORD)
    assert len(avro_wire.decode_batch(missing.slice(0, 0), ORDER_RECORD)) == 0


def test_fan_out_without_events(spark, tmp_path):
    assert {name: df.count() for name, df in fan_out.outputs(spark, str(tmp_path)).items()} == dict.fromkeys(
        ["orders", "couriers", "kpi_orders_5min_tumbling", "kpi_orders_10min_hop5", "kpi_zone_health", "kpi_anomaly_zones"], 0
    )
    assert fan_out.ARCHIVES[COURIER_FEED] == "couriers"


def test_panes_add_up(spark, order_rows):
    rows = _orders(spark, order_rows[0])
    parts = rows.randomSplit([0.3, 0.3, 0.4], 7)
    tables = [panes.order_panes(p) for p in parts]
    merged = tables[0].unionByName(tables[1]).unionByName(tables[2])
    for of_panes, of_events in ((panes.orders_hopping_kpi, windows.orders_hopping_kpi), (panes.anomaly_zones, windows.anomaly_zones)):
        expected = of_events(rows)
        assert sorted(map(repr, of_panes(merged).select(*expected.columns).collect())) == sorted(map(repr, expected.collect()))


def test_read_rows_are_kept_or_quarantined_also_after_a_crash(spark, tmp_path, monkeypatch):
    required, known = ("event_id", "order_id"), ("order_created", "order_delivered")
    values = [
        ("a", "o1", "order_created", 0, 1),
        ("b", None, "order_created", 0, 15),  # not late by a second
        ("c", "o1", "order_teleported", 0, 16),
        (None, None, None, None, 3),
        ("a", "o1", "order_created", 0, 1),  # a copy
        ("d", "o2", "order_delivered", 9, 3),  # arrives before it happens
    ]

    def frame(rows):
        full = [dict(event_id=i, order_id=o, event_type=k, event_time=t if t is None else at(t), ingestion_time=at(n)) for i, o, k, t, n in rows]
        return spark.createDataFrame([tuple(r.get(name) for name in ORDER_EVENTS.names) for r in full], ORDER_EVENTS)

    source, out, checkpoint = (f"{tmp_path}/{name}" for name in ("source", "out", "checkpoint"))
    session = stream_session(spark, 2)

    def run():
        events = readers.stream_parquet(session, source, ORDER_EVENTS)
        finish(quarantine.start_quarantine(events, out, checkpoint, required, known))

    def counted():
        rows = quarantine.counts(spark, out).groupBy("what").agg(F.sum("events").alias("n")).collect()
        return {r.what: r.n for r in rows}

    frame(values[:3]).write.mode("append").parquet(source)
    run()
    assert counted() == {"read": 3, "kept": 1, "quarantined": 2, "missing event_id": 0, "missing order_id": 1, "unknown event_type": 1, "late": 1}
    frame(values[3:]).write.mode("append").parquet(source)
    with monkeypatch.context() as patch:
        patch.setattr(quarantine, "Observation", lambda: _Breaks())
        with pytest.raises(Exception, match="before the counts"):
            run()
    run()
    run()  # nothing new: nothing is added
    assert counted() == {"read": 6, "kept": 3, "quarantined": 3, "missing event_id": 1, "missing order_id": 2, "unknown event_type": 1, "late": 1}
    good, bad = (part(spark, out, ORDER_EVENTS) for part in (quarantine.kept, quarantine.quarantined))
    assert good.columns == ORDER_EVENTS.names and sorted(r.event_id for r in good.collect()) == ["a", "a", "d"]
    assert sorted((r.event_id or "", r.reasons) for r in bad.collect()) == [
        ("", ["missing event_id", "missing order_id"]),
        ("b", ["missing order_id"]),
        ("c", ["late", "unknown event_type"]),
    ]
    plan = good._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(quarantined" in plan
    assert quarantine.kept(spark, f"{tmp_path}/none", ORDER_EVENTS).count() == 0


class _Breaks(Observation):
    """An observation that fails after the events are written and before their counts are."""

    @property
    def get(self):
        raise RuntimeError("before the counts")
