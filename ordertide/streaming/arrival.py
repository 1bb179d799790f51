"""Events that come after a younger one of the same key, on a stream."""

import pyarrow as pa
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ordertide.functions.columns import minutes_between
from ordertide.streaming.buckets import PACKED, Waker, bucket_of, framed, pack, unpack, within_pandas

_FOUND = "event_id string, key string, event_type string, event_us bigint, before_us bigint"
_FOUND_NAMES = ("event_id", "key", "event_type", "event_us", "before_us")
_ROW_NAMES = ["key", "event_id", "event_type", "event_us", "arrival_us"]
_TIMES = pa.schema([("key", pa.string()), ("us", pa.int64()), ("arrival_us", pa.int64())])
#: Names and types of the state of each key, for ``buckets.states``.
TIMES = "key string, us bigint, arrival_us bigint"
_NEVER = -(2**63)


def _behind(rows, known):
    """The rows older than an earlier one of their key. ``known`` has the latest and the last arrival time of each key
    and is brought up to date."""
    for key, event_id, event_type, event_us, arrival_us in sorted(rows, key=lambda r: (r[4], r[1] is not None, r[1])):
        latest = known.get(key, (None, None))[0]
        if event_us is not None:
            if latest is not None and event_us < latest:
                yield event_id, key, event_type, event_us, latest
            else:
                latest = event_us
        known[key] = (latest, arrival_us)


class LatestTime(StatefulProcessor):
    """Keeps the latest event time of each key and reports what is older.

    A key is forgotten when the watermark of arrival times is ``keep_us`` past its last arrival.
    """

    def __init__(self, keep_us):
        self.keep_us = keep_us

    def init(self, handle):
        self.handle = handle
        self.latest = handle.getValueState("latest", "us bigint, arrival_us bigint")

    def handleInputRows(self, key, rows, timerValues):
        known = {key[0]: tuple(self.latest.get())} if self.latest.exists() else {}
        new = not known
        rows = [(key[0], r.event_id, r.event_type, r.event_us, r.arrival_us) for r in rows]
        out = [Row(**dict(zip(_FOUND_NAMES, found, strict=True))) for found in _behind(rows, known)]
        self.latest.update(known[key[0]])
        if new:  # a key has one timer, which is moved on as long as events come
            self._wake(known[key[0]][1] + self.keep_us)
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        until = self.latest.get()[1] + self.keep_us
        if until <= timerValues.getCurrentWatermarkInMs() * 1000:
            self.latest.clear()
        else:
            self._wake(until)
        return iter(())

    def _wake(self, us):
        self.handle.registerTimer(-(-us // 1000))


class LatestTimes(StatefulProcessor):
    """Does what ``LatestTime`` does, for all keys of a bucket at once."""

    def __init__(self, keep_us):
        self.keep_us = keep_us

    def init(self, handle):
        self.waker = Waker(handle)
        self.latest = handle.getValueState("latest_of_keys", PACKED)

    def handleInputRows(self, key, rows, timerValues):
        known, wake = self._known()
        new = []
        for frame in rows:
            frame = frame[_ROW_NAMES].astype(object)
            frame = frame.where(frame.notna(), None)
            new.extend(zip(*(frame[name].tolist() for name in _ROW_NAMES)))
        new = [(*row[:3], None if row[3] == _NEVER else row[3], row[4]) for row in new]
        found = list(_behind(new, known))
        self._keep(known, wake)
        return iter([framed(found, _FOUND_NAMES)] if found else ())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        until = timerValues.getCurrentWatermarkInMs() * 1000
        known, wake = self._known()
        self._keep({k: v for k, v in known.items() if v[1] + self.keep_us > until}, wake, fired=True)
        return iter(())

    def _known(self):
        if not self.latest.exists():
            return {}, None
        packed, wake = self.latest.get()
        return {key: times for key, *times in unpack(packed)}, wake

    def _keep(self, known, wake, fired=False):
        if not known:
            self.latest.clear()
            return
        earliest = min(arrival for _, arrival in known.values()) + self.keep_us
        wake = self.waker.move(wake, earliest, fired)
        rows = [(key, *times) for key, times in known.items()]
        self.latest.update((pack(framed(rows, _TIMES.names), _TIMES), wake))


def out_of_order_stream(events, key="order_id", keep_days=7, delay="15 minutes", buckets=None):
    """The rows of ``quality.out_of_order`` for a stream whose batches come in order of arrival.

    Inside a batch arrival time and event id decide; the state is one time for each key seen in ``keep_days``.
    Rows without key or arrival time, and such as arrive ``delay`` behind the others, are left out. With a number of
    ``buckets`` the times of all keys of a bucket are one value of the state.
    """
    rows = events.filter(F.col(key).isNotNull() & F.col("ingestion_time").isNotNull()).select(
        F.col(key).cast("string").alias("key"),
        "event_id",
        "event_type",
        F.unix_micros("event_time").alias("event_us"),
        F.unix_micros("ingestion_time").alias("arrival_us"),
        "ingestion_time",
    )
    keep_us = keep_days * 86_400_000_000
    if buckets:
        never = F.coalesce("event_us", F.lit(_NEVER))  # pandas has no nulls among whole numbers
        rows = rows.withColumns({"bucket": bucket_of("key", buckets), "event_us": never})
        rows = rows.withColumn("ingestion_time", within_pandas(F.col("ingestion_time")))
        found = rows.withWatermark("ingestion_time", delay).groupBy("bucket").transformWithStateInPandas(
            LatestTimes(keep_us), _FOUND, "append", "eventTime"
        )
    else:
        found = rows.withWatermark("ingestion_time", delay).groupBy("key").transformWithState(
            LatestTime(keep_us), _FOUND, "append", "eventTime"
        )
    at, before = F.timestamp_micros("event_us"), F.timestamp_micros("before_us")
    return found.select(
        "event_id",
        F.col("key").alias(key),
        "event_type",
        at.alias("event_time"),
        before.alias("latest_before"),
        minutes_between(at, before).alias("behind_min"),
    )
