"""Window KPIs kept as mergeable panes: partial aggregates per pane and zone that add up.

A pane table may hold several rows for one pane and zone, for example one for each batch that
brought events of it; the KPI functions add them. They return what the functions of the same
name in ``windows`` return for the events themselves.
"""

from pyspark.sql import functions as F

from ordertide.constants import ANOMALY_RATE_THRESHOLD, SLA_MINUTES
from ordertide.functions.columns import count_if, event_is, time_bucket

PANE_MINUTES = 5
_KEYS = ["pane_start", "zone_id"]
_COUNTS = ["event_count", "orders_created", "orders_delivered", "avg_delivery_time_min"]


def _per_pane(events, zone, *counts):
    events = events.filter(F.col("event_time").isNotNull())
    pane = time_bucket("event_time", PANE_MINUTES).alias("pane_start")
    return events.groupBy(pane, F.col(zone).alias("zone_id")).agg(*counts)


def order_panes(orders):
    """Events, creations, deliveries, timed minutes and flagged events per pane and user zone."""
    return _per_pane(
        orders,
        "user_zone_id",
        F.count("*").alias("events"),
        count_if(event_is("order_created")).alias("created"),
        count_if(event_is("order_delivered")).alias("delivered"),
        F.sum("actual_delivery_time").alias("minutes"),
        F.count("actual_delivery_time").alias("timed"),
        count_if(F.col("anomaly_flag")).alias("flagged"),
    )


def waiting_panes(orders):
    """Orders that became ready per pane and restaurant zone."""
    return _per_pane(orders.filter(event_is("order_ready_for_pickup")), "restaurant_zone_id", F.count("*").alias("waiting"))


def dispatch_panes(couriers):
    """Courier assignments per pane and courier zone."""
    return _per_pane(
        couriers.filter(event_is("courier_assigned_order")), "courier_zone_id", F.count("*").alias("dispatched")
    )


def _windows(panes, slides, keys, counts):
    """Sums of the panes of each window of ``slides`` panes; every pane counts in as many windows."""
    back = F.explode(F.array(*[F.lit(k * PANE_MINUTES * 60_000_000) for k in range(slides)])).alias("back")
    rows = panes.select("*", back) if slides > 1 else panes.withColumn("back", F.lit(0))
    start = F.timestamp_micros(F.unix_micros("pane_start") - F.col("back")).alias("window_start")
    out = rows.groupBy(start, *keys).agg(*[F.sum(c).alias(c) for c in counts])
    end = F.timestamp_micros(F.unix_micros("window_start") + slides * PANE_MINUTES * 60_000_000)
    return out.withColumn("window_end", end)


def _order_counts(windows, *keys):
    return windows.select(
        "window_start",
        "window_end",
        *keys,
        F.col("events").alias("event_count"),
        F.col("created").alias("orders_created"),
        F.col("delivered").alias("orders_delivered"),
        F.try_divide("minutes", "timed").alias("avg_delivery_time_min"),
    )


def orders_tumbling_kpi(panes):
    return _order_counts(_windows(panes, 1, [], ["events", "created", "delivered", "minutes", "timed"]))


def orders_hopping_kpi(panes, slides=2):
    merged = panes.groupBy(*_KEYS).agg(
        *[F.sum(c).alias(c) for c in ("events", "created", "delivered", "minutes", "timed")]
    )
    return _order_counts(
        _windows(merged, slides, ["zone_id"], ["events", "created", "delivered", "minutes", "timed"]), "zone_id"
    )


def anomaly_zones(panes, sla=SLA_MINUTES, max_rate=ANOMALY_RATE_THRESHOLD):
    windows = _windows(panes, 1, ["zone_id"], ["events", "flagged", "minutes", "timed"])
    mean = F.try_divide("minutes", "timed")
    rate = F.col("flagged") / F.col("events")
    return windows.select(
        "window_start",
        "window_end",
        "zone_id",
        F.col("events").alias("total_events"),
        F.col("flagged").alias("anomaly_count"),
        mean.alias("avg_delivery_min"),
        rate.alias("anomaly_rate"),
        ((mean > F.lit(sla)) | (rate > F.lit(max_rate))).alias("zone_flagged"),
    )


def zone_health(waiting, dispatched):
    demand = _windows(waiting, 1, ["zone_id"], ["waiting"])
    supply = _windows(dispatched, 1, ["zone_id"], ["dispatched"]).drop("window_end")
    sent = F.coalesce("dispatched", F.lit(0).cast("bigint"))
    return demand.join(supply, ["window_start", "zone_id"], "left").select(
        "window_start",
        "window_end",
        "zone_id",
        F.col("waiting").alias("orders_awaiting_pickup"),
        sent.alias("couriers_dispatched"),
        (F.col("waiting") - sent).alias("supply_gap"),
    )
