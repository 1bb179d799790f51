"""Row-level table operators: deduplication, union, order, shares, counts."""

from pyspark.sql import functions as F

from ordertide.constants import EVENT_LABELS
from ordertide.functions.columns import clock_text, day_of
from ordertide.schemas import COURIER_FEED, ORDER_FEED


def dedup_first(events, keys=("event_id",), order=("ingestion_time", "event_time")):
    """One row per key: the first by ``order``, then by the other columns.

    The minimum of a struct is combined map-side, so any number of copies of one
    key shrinks to one row per task before the shuffle. Rows without a key stay:
    each is a group of its own, under the number of its row, so the source is read once.
    """
    rest = [name for name in events.columns if name not in keys and name not in order]
    unkeyed = F.lit(False)
    for key in keys:
        unkeyed = unkeyed | F.col(key).isNull()
    own = F.when(unkeyed, F.monotonically_increasing_id()).alias("_own")
    first = events.select("*", own).groupBy(*keys, "_own").agg(F.min(F.struct(*order, *rest)).alias("_row"))
    return first.select(*keys, "_row.*").select(*events.columns)


def union_feeds(orders, couriers):
    """Both feeds in one frame, tagged by feed; columns of the other feed are null."""
    return orders.withColumn("feed", F.lit(ORDER_FEED)).unionByName(
        couriers.withColumn("feed", F.lit(COURIER_FEED)), allowMissingColumns=True
    )


def interleave_feeds(orders, couriers):
    """Both feeds in event-time order, events without a time first."""
    return union_feeds(orders, couriers).orderBy(F.asc_nulls_first("event_time"), "feed", "event_id")


def sort_by_event_time(events):
    return events.orderBy(F.asc_nulls_first("event_time"), "event_id")


def event_log(orders, couriers):
    """Compact log: date, time, label, order, courier and feed of every event, and the line."""
    labels = F.create_map(*[F.lit(text) for pair in EVENT_LABELS.items() for text in pair])
    label = F.coalesce(F.element_at(labels, F.col("event_type")), F.col("event_type"), F.lit("?"))

    def or_dash(column):
        return F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit("-"))

    fields = union_feeds(orders, couriers).select(
        "event_id",
        F.coalesce(day_of("event_time").cast("string"), F.lit("????-??-??")).alias("event_date"),
        F.coalesce(clock_text("event_time"), F.lit("??:??")).alias("event_clock"),
        label.alias("label"),
        or_dash("order_id").alias("order_ref"),
        or_dash("courier_id").alias("courier_ref"),
        F.when(F.col("feed") == ORDER_FEED, "Order").otherwise("Courier").alias("feed_name"),
    )

    def padded(column, width):
        # Pad to the width, but never cut a longer text.
        return F.rpad(F.col(column), F.greatest(F.length(column), F.lit(width)), F.lit(" "))

    line = F.concat(
        F.lit("  "),
        F.col("event_date"),
        F.lit("  "),
        F.col("event_clock"),
        F.lit("   "),
        padded("label", 20),
        F.lit("  "),
        padded("order_ref", 12),
        F.lit("   "),
        padded("courier_ref", 8),
        F.lit("  "),
        F.col("feed_name"),
    )
    return fields.withColumn("line", line)


def feed_counts(orders, couriers):
    """Number of events per feed."""
    return union_feeds(orders.select("event_id"), couriers.select("event_id")).groupBy("feed").agg(
        F.count("*").alias("events")
    )


def data_freshness(orders, couriers):
    """Row counts of both feeds and the time span of the order feed."""
    rows = union_feeds(orders.select("event_time"), couriers.select("event_time"))
    is_order = F.col("feed") == ORDER_FEED
    return rows.agg(
        F.count(F.when(is_order, 1)).alias("order_count"),
        F.count(F.when(~is_order, 1)).alias("courier_count"),
        F.max(F.when(is_order, F.col("event_time"))).alias("latest_event"),
        F.min(F.when(is_order, F.col("event_time"))).alias("earliest_event"),
    )


def share_of_total(df, column, name="share"):
    """Each row's share of the column total; the total is one scalar, not a window."""
    total = df.agg(F.sum(column).alias("total")).scalar()
    return df.withColumn(name, F.try_divide(F.col(column), total))
