"""Per-order state machine: illegal transitions, stuck orders and silences, alike in batch and on streams.

Findings of an order, by ``kind``:

* ``illegal``: an order event that may not follow the order's stage, at its time;
* ``stuck``: nothing took the order within some minutes of being ready, at that deadline;
* ``quiet``: nothing happened for some minutes, at the end of them, with what the order did so far.

Events count once for each order, time and type; of equal times the earlier stage of the life cycle
comes first. An order that is silent for longer than ``keep_minutes`` is forgotten: events
after that are those of a new order. This bounds the state of a stream.

On a stream events wait in the state until the watermark has passed them, so the order of arrival
does not matter; deadlines are event-time timers. Rows without order, time or type, and
types that are neither of orders nor assignments, are left out.
"""

from dataclasses import dataclass, fields
from operator import attrgetter

import pyarrow as pa
from pyspark.sql import Row, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ordertide.constants import ALL_CANCEL_TYPES, ORDER_EVENT_TYPES, TRANSITIONS
from ordertide.functions.columns import event_is
from ordertide.operators.windows import watermarked
from ordertide.streaming.buckets import PACKED, Waker, bucket_of, framed, pack, unpack, within_pandas

_TAKEN = ["courier_assigned_order", "order_delivered", *ALL_CANCEL_TYPES]
_READY = "order_ready_for_pickup"
#: Types that count, in the order in which events of equal times happen.
_TYPES = [*ORDER_EVENT_TYPES, "courier_assigned_order"]
_MINUTE_US = 60_000_000

FINDING = """order_id string, kind string, at timestamp, from_event string, event string,
    first_at timestamp, events bigint, illegal bigint"""
_STATE = """first_us bigint, last_us bigint, last_type string, stage string, ready_us bigint, taken boolean,
    events bigint, illegal bigint, stuck_done boolean, quiet_done boolean"""


def order_findings(events, minutes=15, quiet_minutes=240, keep_minutes=10_080, delay="15 minutes", buckets=None):
    """The findings of all orders of a batch or streaming feed (FINDING).

    With a number of ``buckets`` the orders of a bucket share one state of a stream.
    """
    if not minutes <= quiet_minutes <= keep_minutes:
        raise ValueError("an order is stuck before it is quiet, and quiet before it is forgotten")
    rows = events.select("order_id", "event_type", "event_time").filter(
        F.col("order_id").isNotNull() & F.col("event_time").isNotNull() & event_is(*_TYPES)
    )
    if not events.isStreaming:
        return _batch_findings(rows, minutes, quiet_minutes, keep_minutes)
    limits = (minutes, quiet_minutes, keep_minutes)
    if buckets:
        rows = rows.withColumns({"bucket": bucket_of("order_id", buckets), "rank": _rank(), "us": F.unix_micros("event_time")})
        if delay:
            rows = rows.withColumn("event_time", within_pandas(F.col("event_time")))
        rows = watermarked(rows.drop("event_type"), delay)
        found = rows.groupBy("bucket").transformWithStateInPandas(
            ManyOrderStates(*limits), _FOUND_SCHEMA, "append", "eventTime"
        )
    else:
        rows = watermarked(rows, delay).withColumn("us", F.unix_micros("event_time"))  # the other one has the watermark
        found = rows.groupBy("order_id").transformWithState(
            OrderStates(*limits), _FOUND_SCHEMA, "append", "eventTime"
        )
    return found.select(
        "order_id",
        "kind",
        F.timestamp_micros("at_us").alias("at"),
        "from_event",
        "event",
        F.timestamp_micros("first_us").alias("first_at"),
        "events",
        "illegal",
    )


_FOUND_SCHEMA = """order_id string, kind string, at_us bigint, from_event string, event string, first_us bigint,
    events bigint, illegal bigint"""


def _rank():
    """The place of an event's type in ``_TYPES``, from 1."""
    return F.array_position(F.array(*map(F.lit, _TYPES)), F.col("event_type")).cast("int")


def _without_copies(rows):
    """The rows less the copies that come in one Arrow batch, so that a pile of copies is few rows before it is moved."""

    def run(batches):
        for batch in batches:
            yield from pa.Table.from_batches([batch]).group_by(batch.schema.names).aggregate([]).to_batches()

    return rows.mapInArrow(run, rows.schema)


def _batch_findings(rows, minutes, quiet_minutes, keep_minutes):
    """One shuffle and one sort, by order and time, for all windows; what belongs to one life of an order is a running
    value that the life's number guards."""
    kinds = F.array(*map(F.lit, _TYPES))
    rows = _without_copies(rows.select("order_id", F.unix_micros("event_time").alias("us"), _rank().alias("rank")))
    by_order = Window.partitionBy("order_id").orderBy("us", "rank")
    before = by_order.rowsBetween(Window.unboundedPreceding, -1)
    upto = by_order.rowsBetween(Window.unboundedPreceding, 0)

    def among(types):
        return F.col("rank").isin([_TYPES.index(t) + 1 for t in types])

    copied = (F.lag("us").over(by_order) == F.col("us")) & (F.lag("rank").over(by_order) == F.col("rank"))
    rows = rows.withColumn("copied", F.coalesce(copied, F.lit(False))).filter("NOT copied").drop("copied")
    after = F.lead("us").over(by_order) - F.col("us")
    rows = rows.withColumns({"gap": F.col("us") - F.lag("us").over(by_order), "silence": after, "n": F.row_number().over(by_order)})
    rows = rows.withColumn("anew", F.col("gap").isNull() | (F.col("gap") > keep_minutes * _MINUTE_US))
    rows = rows.withColumns(
        {
            "life": F.sum(F.col("anew").cast("int")).over(upto),
            "first_us": F.max(F.when(F.col("anew"), F.col("us"))).over(upto),
            "first_n": F.max(F.when(F.col("anew"), F.col("n"))).over(upto),
        }
    )
    moves = among(ORDER_EVENT_TYPES)

    def earliest(types):  # of the last life that has any
        return F.max(F.when(among(types), F.struct("life", (-F.col("us")).alias("back")))).over(upto)

    moved = F.last(F.when(moves, F.struct("life", "rank")), ignorenulls=True).over(before)
    rows = rows.withColumns({"moved": moved, "ready": earliest([_READY]), "taken": earliest(_TAKEN)})

    def of_life(column, value):
        return F.when(F.col(f"{column}.life") == F.col("life"), value)

    rows = rows.withColumns(
        {
            "event": F.element_at(kinds, F.col("rank")),
            "stage": of_life("moved", F.element_at(kinds, F.col("moved.rank"))),
            "due": of_life("ready", -F.col("ready.back")) + minutes * _MINUTE_US,
            "taken_us": of_life("taken", -F.col("taken.back")),
        }
    )
    legal = [f"{stage or ''}>{event}" for stage, after in TRANSITIONS.items() for event in after]
    follows = F.concat_ws(">", F.coalesce("stage", F.lit("")), "event")
    rows = rows.withColumn("broken", F.when(moves & ~follows.isin(legal), 1).otherwise(0))
    rows = rows.withColumn("all_broken", F.sum("broken").over(upto))
    rows = rows.withColumn("old_broken", F.max(F.when(F.col("anew"), F.col("all_broken") - F.col("broken"))).over(upto))

    no_text, no_count = F.lit(None).cast("string"), F.lit(None).cast("bigint")

    def finding(found, kind, at, from_event, event, events=no_count, illegal=no_count):
        values = {"kind": F.lit(kind), "at": F.timestamp_micros(at), "from_event": from_event, "event": event}
        values |= {"first_at": F.timestamp_micros("first_us"), "events": events, "illegal": illegal}
        return F.when(found, F.struct(*[value.alias(name) for name, value in values.items()]))

    last = F.col("silence").isNull() | (F.col("silence") > keep_minutes * _MINUTE_US)
    silent = last | (F.col("silence") > quiet_minutes * _MINUTE_US)
    stuck = last & F.col("due").isNotNull() & (F.col("taken_us").isNull() | (F.col("taken_us") > F.col("due")))
    events = (F.col("n") - F.col("first_n") + 1).cast("bigint")
    illegal = F.col("all_broken") - F.col("old_broken")
    found = F.array(
        finding(F.col("broken") == 1, "illegal", F.col("us"), F.col("stage"), F.col("event")),
        finding(silent, "quiet", F.col("us") + quiet_minutes * _MINUTE_US, no_text, F.col("event"), events, illegal),
        finding(stuck, "stuck", F.col("due"), no_text, F.lit(_READY)),
    )
    return rows.select("order_id", F.inline(F.array_compact(found)))


@dataclass
class OrderState:
    """What is known of one order once the watermark has passed its events."""

    first_us: int = None
    last_us: int = None
    last_type: str = None
    stage: str = None
    ready_us: int = None
    taken: bool = False
    events: int = 0
    illegal: int = 0
    stuck_done: bool = False
    quiet_done: bool = False


_values = attrgetter(*(field.name for field in fields(OrderState)))
_FOUND_NAMES = ("order_id", "kind", "at_us", "from_event", "event", "first_us", "events", "illegal")
_ARROW = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_()}
#: Names and types of the state of each order, for ``buckets.states``.
ORDERS = f"order_id string, {' '.join(_STATE.split())}"
_ORDERS = pa.schema([(name, _ARROW[kind]) for name, kind in map(str.split, ORDERS.split(", "))])
_AHEAD = pa.schema([("order_id", pa.string()), ("us", pa.int64()), ("rank", pa.int32())])


class OrderStates(StatefulProcessor):
    """Keeps an ``OrderState`` and the events ahead of the watermark for each order."""

    def __init__(self, minutes, quiet_minutes, keep_minutes):
        self.limits = [m * _MINUTE_US for m in (minutes, quiet_minutes, keep_minutes)]

    def init(self, handle):
        self.handle = handle
        self.order = handle.getValueState("order", _STATE)
        self.ahead = handle.getListState("ahead", "us bigint, event_type string")

    def handleInputRows(self, key, rows, timerValues):
        new = [(r.us, r.event_type) for r in rows]
        self.ahead.appendList(new)
        # one timer is enough: it sets the next one
        self._wake(min(us for us, _ in new))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        until = timerValues.getCurrentWatermarkInMs() * 1000
        state = OrderState(*self.order.get()) if self.order.exists() else OrderState()
        ahead = sorted(set(map(tuple, self.ahead.get())), key=lambda e: (e[0], _TYPES.index(e[1])))
        state, left, due, out = self._advance(key[0], state, ahead, until)
        if len(left) < len(ahead):
            self.ahead.put(left) if left else self.ahead.clear()
        if state.events:
            self.order.update(_values(state))
        elif self.order.exists():
            self.order.clear()
        if due is not None:
            self._wake(due)
        return iter([Row(**dict(zip(_FOUND_NAMES, found, strict=True))) for found in out])

    def _advance(self, order_id, state, ahead, until):
        """What is known of an order after all that happens until then, the events left, the time of what is next, and the findings."""
        out, at = [], 0
        while True:
            due, kind = self._next(state, ahead[at] if at < len(ahead) else None)
            if due is None or due > until:
                return state, ahead[at:], due, [(order_id, *found) for found in out]
            if kind == "event":
                self._take(state, *ahead[at], out)
                at += 1
            elif kind == "forget":
                state = OrderState()
            elif kind == "stuck":
                state.stuck_done = True
                out.append(("stuck", due, None, _READY, state.first_us, None, None))
            else:
                state.quiet_done = True
                out.append(("quiet", due, None, state.last_type, state.first_us, state.events, state.illegal))

    def _wake(self, us):
        self.handle.registerTimer(-(-us // 1000))

    def _next(self, state, event):
        """Time and kind of what happens next to an order; events come before deadlines of their time."""
        stuck, quiet, forget = self.limits
        steps = [(event[0], 0, "event")] if event else []
        if state.events:
            if state.ready_us is not None and not state.taken and not state.stuck_done:
                steps.append((state.ready_us + stuck, 1, "stuck"))
            if not state.quiet_done:
                steps.append((state.last_us + quiet, 2, "quiet"))
            steps.append((state.last_us + forget, 3, "forget"))
        due, _, kind = min(steps, default=(None, None, None))
        return due, kind

    @staticmethod
    def _take(state, us, event, out):
        if state.first_us is None:
            state.first_us = us
        state.events += 1
        state.last_us, state.last_type, state.quiet_done = us, event, False
        if event in _TAKEN:
            state.taken = True
        if event == _READY and state.ready_us is None:
            state.ready_us = us
        if event in ORDER_EVENT_TYPES:
            if event not in TRANSITIONS[state.stage]:
                state.illegal += 1
                out.append(("illegal", us, state.stage, event, state.first_us, None, None))
            state.stage = event


class ManyOrderStates(OrderStates):
    """Does what ``OrderStates`` does, for all orders of a bucket at once."""

    def init(self, handle):
        self.waker = Waker(handle)
        self.orders = handle.getValueState("orders", PACKED)
        self.ahead = handle.getListState("ahead", "packed binary")

    def handleInputRows(self, key, rows, timerValues):
        first = None
        for frame in rows:
            self.ahead.appendValue((pack(frame[_AHEAD.names], _AHEAD),))
            us = int(frame["us"].min())
            first = us if first is None else min(first, us)
        packed, wake = self.orders.get() if self.orders.exists() else (None, None)
        if wake is None or first < wake * 1000:
            self.orders.update((packed, self.waker.move(wake, first)))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        until = timerValues.getCurrentWatermarkInMs() * 1000
        packed, wake = self.orders.get()
        states = {order_id: OrderState(*state) for order_id, *state in unpack(packed)} if packed else {}
        ahead = {order_id: [] for order_id in states}
        for (data,) in self.ahead.get():
            for order_id, us, rank in unpack(data):
                ahead.setdefault(order_id, []).append((us, rank))
        known, waiting, found, earliest = [], [], [], None
        for order_id, events in ahead.items():
            events = [(us, _TYPES[rank - 1]) for us, rank in sorted(set(events))]
            state, left, due, out = self._advance(order_id, states.get(order_id) or OrderState(), events, until)
            if state.events:
                known.append((order_id, *_values(state)))
            waiting.extend((order_id, us, _TYPES.index(event) + 1) for us, event in left)
            found.extend(out)
            if due is not None:
                earliest = due if earliest is None else min(earliest, due)
        self.ahead.put([(pack(framed(waiting, _AHEAD.names), _AHEAD),)]) if waiting else self.ahead.clear()
        if earliest is None:
            self.orders.clear()
        else:
            packed = pack(framed(known, _ORDERS.names), _ORDERS) if known else None
            self.orders.update((packed, self.waker.move(wake, earliest, fired=True)))
        return iter([framed(found, _FOUND_NAMES)] if found else ())
