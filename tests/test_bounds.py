"""What a task holds and writes: plans without wide sorts, files in compact form."""

import datetime
import glob
import random

from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from ordertide.schemas import ORDER_EVENTS, ORDER_WIRE
from ordertide.session import run_folder
from ordertide.sources import readers, sinks
from ordertide.streaming import quarantine
from ordertide.streaming.transitions import _TYPES, OrderState, OrderStates, order_findings

NOON = datetime.datetime(2024, 3, 1, 12)


def at(minutes):
    return NOON + datetime.timedelta(minutes=minutes)


def _orders(spark, rows):
    return spark.createDataFrame([tuple(r.get(n) for n in ORDER_EVENTS.names) for r in rows], ORDER_EVENTS)


def test_quarantine_parts_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    rows = [dict(event_id=f"E{k}", event_type="order_created", event_time=at(k), ingestion_time=at(k)) for k in range(50)]
    rows = [r | {"order_id": "O" if k % 3 else None} for k, r in enumerate(rows)]
    name, seen, parquet = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet

    def spy(self, path, *args, **kwargs):
        seen.append((path.split("/")[-2], spark.conf.get(name)))
        return parquet(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", spy)
    before = spark.conf.get(name)
    write = quarantine.batch_writer(str(tmp_path), ["event_id", "order_id"], ["order_created"])
    write(_orders(spark, rows + rows).coalesce(1), 0)
    assert seen == [("events", "2"), ("counts", before)] and spark.conf.get(name) == before
    good, bad = (part(spark, str(tmp_path), ORDER_EVENTS) for part in (quarantine.kept, quarantine.quarantined))
    assert sorted(r.event_id for r in good.collect()) == sorted(2 * [r["event_id"] for r in rows if r["order_id"]])
    assert sorted(r.event_id for r in bad.collect()) == sorted(2 * [r["event_id"] for r in rows if not r["order_id"]])
    (broken,) = glob.glob(f"{tmp_path}/events/batch_id=0/quarantined=true/*.parquet")


def test_json_lines_are_written_compressed(spark):
    rows = [dict(event_id=f"E{k}", event_type="order_created", event_time=at(k), promo_applied="ñ\n" if k % 2 else None) for k in range(500)]
    events, sizes, found = _orders(spark, rows), {}, {}
    for kind in ("gzip", "none"):
        path = run_folder(spark, "ndjson")
        if kind == "none":
            sinks.write_ndjson(events, path, 100, compression=kind)
        else:
            sinks.write_ndjson(events, path, 100)
        files = glob.glob(f"{path.removeprefix('file:')}/part-*")
        assert all(f.endswith(".json.gz" if kind == "gzip" else ".json") for f in files) and len(files) >= 5
        sizes[kind] = sum(len(open(f, "rb").read()) for f in files)
        found[kind] = sorted(map(repr, readers.read_ndjson(spark, path, ORDER_WIRE).collect()))
    assert sizes["gzip"] * 5 < sizes["none"] and found["gzip"] == found["none"] and len(found["gzip"]) == 500


def _expected(events, minutes, quiet, keep):
    """Findings of one order by the state machine alone: (kind, minute, from, event, first minute, events, illegal)."""
    machine, state, out = OrderStates(minutes, quiet, keep), OrderState(), []
    ahead = sorted(set(events), key=lambda e: (e[0], _TYPES.index(e[1])))
    while True:
        due, kind = machine._next(state, ahead[0] if ahead else None)
        if due is None:
            return out
        if kind == "event":
            machine._take(state, *ahead.pop(0), out)
        elif kind == "forget":
            state = OrderState()
        elif kind == "stuck":
            state.stuck_done = True
            out.append(("stuck", due, None, "order_ready_for_pickup", state.first_us, None, None))
        else:
            state.quiet_done = True
            out.append(("quiet", due, None, state.last_type, state.first_us, state.events, state.illegal))


def test_batch_findings_need_one_shuffle_and_one_sort(spark):
    dice = random.Random(5)
    rows, want = [], []
    for k in range(300):
        events, minute = [], 0
        for _ in range(dice.randrange(1, 12)):
            minute += dice.choice([0, 0, 1, 4, 5, 6, 20, 21, 60, 61, 200])
            events.append((minute * 60_000_000, dice.choice(_TYPES)))
        copies = events * dice.choice([1, 1, 2, 40])
        rows += [(f"O{k}", kind, at(us // 60_000_000)) for us, kind in copies]
        want += [(f"O{k}", *f) for f in _expected(events, 5, 20, 60)]
    events = spark.createDataFrame(rows, "order_id string, event_type string, event_time timestamp")
    found = order_findings(events, 5, 20, 60)
    base = int(events.where("event_time IS NOT NULL").select(F.unix_micros(F.lit(NOON))).first()[0])
    rows = found.withColumns({"at": F.unix_micros("at") - base, "first_at": F.unix_micros("first_at") - base}).collect()
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, want))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1 and "Aggregate" not in plan
