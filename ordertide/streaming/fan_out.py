"""One query per topic that feeds every output from a single decode.

A micro-batch of a topic is decoded once and written to an archive of all its rows. Of that the columns
needed are read again for one table of mergeable panes for each KPI. Every table has a folder for each
batch id that is overwritten as a whole, so a batch that is run again after a crash, wherever between two
tables it came, replaces what it wrote and adds nothing.

Panes count an event id once, however late a copy comes: ids that the archive holds from earlier batches are
left out by an anti-join, which opens only the dates and row groups of the batch's own event times.
There is no state to grow. A copy carries the event time of its original; one with another time
counts again.

The KPI tables are sums of panes (``operators.panes``), so they hold every event that has come,
late ones too. ``closed`` leaves out windows that a watermark would still keep open.
"""

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType

from ordertide.functions.columns import day_of
from ordertide.operators import panes
from ordertide.schemas import COURIER_FEED, ORDER_FEED
from ordertide.sources.decode import FEEDS, decode_feed
from ordertide.sources.readers import read_parquet_prefix

#: Pane tables of each feed, by name.
PANES = {
    ORDER_FEED: {"panes_orders": panes.order_panes, "panes_waiting": panes.waiting_panes},
    COURIER_FEED: {"panes_dispatch": panes.dispatch_panes},
}
#: What the functions of these tables read of an event.
READ = {
    ORDER_FEED: ["event_id", "event_time", "event_type", "user_zone_id", "restaurant_zone_id", "actual_delivery_time", "anomaly_flag"],
    COURIER_FEED: ["event_id", "event_time", "event_type", "courier_zone_id"],
}
#: Columns that folders add to an archive's rows.
_PLACE = "batch_id bigint, event_date date"
_DATE = StructField("event_date", DateType())
#: Archive of each feed.
ARCHIVES = {ORDER_FEED: "orders", COURIER_FEED: "couriers"}


def _folder(output, table, batch_id):
    return f"{output}/{table}/batch_id={batch_id}"


def unseen(rows, archive, batch_id):
    """One row for each event id that no earlier batch of the archive holds; rows without a time are left out."""
    timed = rows.filter(F.col("event_time").isNotNull())
    low, high = timed.agg(F.min("event_time"), F.max("event_time")).first()
    if low is None:
        return timed
    span = F.col("event_time").between(F.lit(low), F.lit(high))
    days = F.col("event_date").between(day_of(F.lit(low)), day_of(F.lit(high)))
    held = read_parquet_prefix(rows.sparkSession, archive, "event_id string, event_time timestamp, " + _PLACE)
    before = held.filter(F.col("batch_id") < batch_id).filter(days & span).select("event_id", "event_time").distinct()
    return timed.dropDuplicates(["event_id"]).join(before, ["event_id", "event_time"], "left_anti")


def batch_writer(feed, output, tables=None):
    """The function that writes one micro-batch of decoded events of a feed; own ``tables`` may read all columns."""
    read = READ[feed] if tables is None else [f.name for f in FEEDS[feed][1].fields]
    tables = PANES[feed] if tables is None else tables
    archive = ARCHIVES[feed]

    def write(rows, batch_id):
        folder = _folder(output, archive, batch_id)
        dated = rows.withColumn("event_date", day_of("event_time"))
        dated.write.mode("overwrite").partitionBy("event_date").parquet(folder)
        kept = read_parquet_prefix(rows.sparkSession, folder, StructType([*rows.schema.fields, _DATE])).select(*read)
        fresh = unseen(kept, f"{output}/{archive}", batch_id).persist()
        try:
            for name, build in tables.items():
                build(fresh).write.mode("overwrite").parquet(_folder(output, name, batch_id))
        finally:
            fresh.unpersist()

    return write


def start_fan_out(topic, feed, output, checkpoint, interval=None, tables=None):
    """Start the query of one topic; without an interval it takes what is there and ends."""
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    writer = decode_feed(topic, feed).writeStream.foreachBatch(batch_writer(feed, output, tables))
    return writer.queryName(f"fan-out-{ARCHIVES[feed]}").option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _archive(spark, output, feed):
    place = [StructField("batch_id", LongType()), _DATE]
    schema = StructType([*FEEDS[feed][1].fields, *place])
    return read_parquet_prefix(spark, f"{output}/{ARCHIVES[feed]}", schema).drop("batch_id")


def _panes(spark, output, feed, name):
    schema = PANES[feed][name](spark.createDataFrame([], FEEDS[feed][1])).schema
    return read_parquet_prefix(spark, f"{output}/{name}", schema)


def closed(windows, upto):
    """Windows that end at ``upto`` or before, usually the latest event time less the delay."""
    return windows.filter(F.col("window_end") <= F.lit(upto))


def outputs(spark, output):
    """The six outputs by name: two archives with every copy that came, and four KPI tables."""
    orders, waiting = (_panes(spark, output, ORDER_FEED, name) for name in PANES[ORDER_FEED])
    (dispatched,) = (_panes(spark, output, COURIER_FEED, name) for name in PANES[COURIER_FEED])
    archives = {name: _archive(spark, output, feed) for feed, name in ARCHIVES.items()}
    return archives | {
        "kpi_orders_5min_tumbling": panes.orders_tumbling_kpi(orders),
        "kpi_orders_10min_hop5": panes.orders_hopping_kpi(orders),
        "kpi_zone_health": panes.zone_health(waiting, dispatched),
        "kpi_anomaly_zones": panes.anomaly_zones(orders),
    }
