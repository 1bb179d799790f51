"""Event-time window KPIs. Every function takes a batch or a streaming feed."""

from pyspark.sql import functions as F

from ordertide.constants import ANOMALY_RATE_THRESHOLD, SLA_MINUTES
from ordertide.functions.columns import count_if, event_is


def watermarked(df, delay):
    """Watermark on event time. Batch frames need none, and without a delay the stream has its own."""
    return df.withWatermark("event_time", delay) if df.isStreaming and delay else df


def _bounds(df, *columns):
    return df.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *columns
    )


_ORDER_COUNTS = ["event_count", "orders_created", "orders_delivered", "avg_delivery_time_min"]


def _order_counts():
    return [
        F.count("*").alias("event_count"),
        count_if(event_is("order_created")).alias("orders_created"),
        count_if(event_is("order_delivered")).alias("orders_delivered"),
        F.avg("actual_delivery_time").alias("avg_delivery_time_min"),
    ]


def orders_tumbling_kpi(orders, width="5 minutes", delay="15 minutes"):
    """Order throughput and mean delivery time per tumbling window."""
    windows = watermarked(orders, delay).groupBy(F.window("event_time", width)).agg(*_order_counts())
    return _bounds(windows, *_ORDER_COUNTS)


def orders_hopping_kpi(orders, width="10 minutes", slide="5 minutes", delay="20 minutes"):
    """The tumbling KPIs per user zone on overlapping windows.

    On a stream each row is copied into every window it falls in. In batch the
    rows are first reduced to one row per zone and slide, and those are copied.
    """
    if orders.isStreaming:
        windows = (
            watermarked(orders, delay)
            .groupBy(F.window("event_time", width, slide), F.col("user_zone_id").alias("zone_id"))
            .agg(*_order_counts())
        )
        return _bounds(windows, "zone_id", *_ORDER_COUNTS)
    panes = (
        orders.groupBy(F.window("event_time", slide).alias("pane"), F.col("user_zone_id").alias("zone_id"))
        .agg(
            F.count("*").alias("events"),
            count_if(event_is("order_created")).alias("created"),
            count_if(event_is("order_delivered")).alias("delivered"),
            F.sum("actual_delivery_time").alias("minutes"),
            F.count("actual_delivery_time").alias("timed"),
        )
        .withColumn("pane_start", F.col("pane.start"))
    )
    windows = panes.groupBy(F.window("pane_start", width, slide), "zone_id").agg(
        F.sum("events").alias("event_count"),
        F.sum("created").alias("orders_created"),
        F.sum("delivered").alias("orders_delivered"),
        F.try_divide(F.sum("minutes"), F.sum("timed")).alias("avg_delivery_time_min"),
    )
    return _bounds(windows, "zone_id", *_ORDER_COUNTS)


def _events_per_zone(df, event_type, zone, name, width, delay):
    return (
        watermarked(df.filter(event_is(event_type)), delay)
        .groupBy(F.window("event_time", width), F.col(zone).alias("zone_id"))
        .agg(F.count("*").alias(name))
    )


def orders_waiting(orders, width="5 minutes", delay="15 minutes"):
    """Orders that became ready for pickup, per window and restaurant zone."""
    windows = _events_per_zone(
        orders, "order_ready_for_pickup", "restaurant_zone_id", "orders_awaiting_pickup", width, delay
    )
    return _bounds(windows, "zone_id", "orders_awaiting_pickup")


def couriers_dispatched(couriers, width="5 minutes", delay="15 minutes"):
    """Courier assignments per window and courier zone."""
    windows = _events_per_zone(
        couriers, "courier_assigned_order", "courier_zone_id", "couriers_dispatched", width, delay
    )
    return _bounds(windows, "zone_id", "couriers_dispatched")


def zone_health(orders, couriers, width="5 minutes", delay="15 minutes"):
    """Waiting orders against dispatched couriers; a positive gap means stress."""
    demand = _events_per_zone(
        orders, "order_ready_for_pickup", "restaurant_zone_id", "orders_awaiting_pickup", width, delay
    ).alias("o")
    supply = _events_per_zone(
        couriers, "courier_assigned_order", "courier_zone_id", "couriers_dispatched", width, delay
    ).alias("c")
    same = (F.col("o.window") == F.col("c.window")) & (F.col("o.zone_id") == F.col("c.zone_id"))
    dispatched = F.coalesce(F.col("c.couriers_dispatched"), F.lit(0).cast("bigint"))
    return demand.join(supply, same, "left").select(
        F.col("o.window.start").alias("window_start"),
        F.col("o.window.end").alias("window_end"),
        F.col("o.zone_id").alias("zone_id"),
        F.col("o.orders_awaiting_pickup").alias("orders_awaiting_pickup"),
        dispatched.alias("couriers_dispatched"),
        (F.col("o.orders_awaiting_pickup") - dispatched).alias("supply_gap"),
    )


def anomaly_zones(
    orders, width="5 minutes", delay="15 minutes", sla=SLA_MINUTES, max_rate=ANOMALY_RATE_THRESHOLD
):
    """Zones per window with slow deliveries or many flagged events.

    ``zone_flagged`` is null when no delivery was timed and the rate is low.
    """
    windows = (
        watermarked(orders, delay)
        .groupBy(F.window("event_time", width), F.col("user_zone_id").alias("zone_id"))
        .agg(
            F.count("*").alias("total_events"),
            count_if(F.col("anomaly_flag")).alias("anomaly_count"),
            F.avg("actual_delivery_time").alias("avg_delivery_min"),
        )
    )
    rate = F.col("anomaly_count") / F.col("total_events")
    return _bounds(
        windows,
        "zone_id",
        "total_events",
        "anomaly_count",
        "avg_delivery_min",
        rate.alias("anomaly_rate"),
        ((F.col("avg_delivery_min") > F.lit(sla)) | (rate > F.lit(max_rate))).alias("zone_flagged"),
    )


def anomaly_alerts(orders, **options):
    """Only the flagged zone windows; an unknown flag is no alert."""
    return anomaly_zones(orders, **options).filter(F.coalesce("zone_flagged", F.lit(False)))


def orders_per_hour(orders, width="1 hour", delay="15 minutes"):
    """Throughput and cancellation rate per hour, over all cancellation types."""
    windows = (
        watermarked(orders, delay)
        .groupBy(F.window("event_time", width))
        .agg(
            count_if(event_is("order_created")).alias("orders_created"),
            count_if(event_is("order_delivered")).alias("orders_delivered"),
            count_if(F.col("event_type").startswith("order_cancelled")).alias("orders_cancelled"),
        )
    )
    created = F.greatest(F.col("orders_created"), F.lit(1))
    return _bounds(
        windows,
        "orders_created",
        "orders_delivered",
        "orders_cancelled",
        (F.col("orders_cancelled") / created * 100).alias("cancellation_rate_pct"),
    )
