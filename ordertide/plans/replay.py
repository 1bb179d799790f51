"""Bounded streaming runs over a feed kept in files.

A feed is written as Parquet together with a closing row per event type, dated far
ahead. The closing rows push the watermark past all real events, so that every
window of the feed is emitted; their own windows stay open and never appear.
"""

import datetime

from pyspark.sql import functions as F

from ordertide.constants import COURIER_EVENT_TYPES, ORDER_EVENT_TYPES
from ordertide.schemas import ORDER_FEED
from ordertide.session import run_folder, stream_session
from ordertide.sources.decode import FEEDS
from ordertide.sources.readers import stream_parquet
from ordertide.streaming.sinks import finish, start_parquet

CLOSING = "CLOSING"
_FAR = datetime.datetime(2100, 1, 1)


def closing_rows(spark, feed):
    schema = FEEDS[feed][1]
    types = ORDER_EVENT_TYPES if feed == ORDER_FEED else COURIER_EVENT_TYPES
    # Join keys are filled in: Spark drops rows with null keys before the watermark sees them.
    known = {"event_time": _FAR, "ingestion_time": _FAR, "order_id": f"{CLOSING}-{feed}", "courier_id": CLOSING}
    known.update(dict.fromkeys(("user_zone_id", "restaurant_zone_id", "courier_zone_id"), CLOSING))
    rows = [
        tuple({**known, "event_type": kind, "event_id": f"{CLOSING}-{kind}"}.get(name) for name in schema.names)
        for kind in types
    ]
    return spark.createDataFrame(rows, schema)


def without_closing(events):
    return events.filter(~F.col("event_id").startswith(CLOSING))


class Replay:
    """Feeds staged in files once per session and data folder."""

    _staged = {}

    def __init__(self, spark, name, feeds):
        self.spark = spark
        self.name = name
        self.feeds = feeds
        self.session = stream_session(spark)
        self.folder = run_folder(spark, "replay")

    def _stage(self, feed):
        key = (self.spark.sparkContext.applicationId, self.name, feed)
        if key not in self._staged:
            path = f"{run_folder(self.spark, 'staged')}/{feed}"
            self.feeds[feed].write.parquet(path)
            closing_rows(self.spark, feed).coalesce(1).write.mode("append").parquet(path)
            self._staged[key] = path
        return self._staged[key]

    def stream(self, feed, **options):
        """The whole feed with its closing rows as a stream."""
        return stream_parquet(self.session, self._stage(feed), FEEDS[feed][1], **options)

    def result(self, stream, sink="out"):
        """Run a stream to its end and read back what it wrote."""
        path = f"{self.folder}/{sink}"
        finish(start_parquet(stream, path, f"{self.folder}/checkpoint-{sink}"))
        return self.spark.read.schema(stream.schema).parquet(path)

    def in_slices(self, feed, slices, build, sink="out"):
        """Add a feed slice by slice and restart the same query after each.

        ``slices`` are frames in order of arrival. Each run resumes from the
        checkpoint of the run before.
        """
        source = f"{self.folder}/{feed}-arriving"
        path = f"{self.folder}/{sink}"
        queries = []
        for part in slices:
            part.write.mode("append").parquet(source)
            stream = build(stream_parquet(self.session, source, FEEDS[feed][1]))
            query = start_parquet(stream, path, f"{self.folder}/checkpoint-{sink}")
            finish(query)
            queries.append(query)
        return self.spark.read.schema(stream.schema).parquet(path), queries


def time_slices(events, column, parts):
    """The feed cut into equal spans of a time column, in order."""
    micros = F.unix_micros(column)
    low, high = events.agg(F.min(micros), F.max(micros)).first()
    edges = [low + (high - low) * i // parts for i in range(parts)] + [high + 1]
    return [events.filter((micros >= a) & (micros < b)) for a, b in zip(edges, edges[1:])]
