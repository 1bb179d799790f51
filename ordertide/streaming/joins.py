"""Joins of the two event streams."""

from pyspark.sql import functions as F

from ordertide.functions.columns import event_is, minutes_between
from ordertide.operators.windows import watermarked


def order_courier_interval(orders, couriers, minutes=30, delay="15 minutes"):
    """Ready orders with the courier assignments of the following minutes."""
    ready = watermarked(
        orders.filter(event_is("order_ready_for_pickup")).select(
            F.col("order_id"),
            F.col("restaurant_zone_id").alias("zone_id"),
            F.col("event_time"),
        ),
        delay,
    ).withColumnRenamed("event_time", "ready_at")
    assigned = watermarked(
        couriers.filter(event_is("courier_assigned_order")).select(
            F.col("order_id").alias("assigned_order_id"), "courier_id", "event_time"
        ),
        delay,
    ).withColumnRenamed("event_time", "assigned_at")
    limit = F.col("ready_at") + F.expr(f"interval {minutes} minutes")
    in_time = (
        (F.col("order_id") == F.col("assigned_order_id"))
        & (F.col("assigned_at") >= F.col("ready_at"))
        & (F.col("assigned_at") <= limit)
    )
    return ready.join(assigned, in_time, "inner").select(
        "order_id",
        "zone_id",
        "courier_id",
        "ready_at",
        "assigned_at",
        minutes_between(F.col("ready_at"), F.col("assigned_at")).alias("dispatch_min"),
    )
