"""Estimated and actual order value (GMV)."""

from pyspark.sql import functions as F

from ordertide.constants import AVG_ORDER_VALUE_EUR, BUCKET_MINUTES, DELIVERY_DAY_HOURS
from ordertide.functions.columns import event_is, time_bucket


def _delivered(orders):
    return orders.filter(event_is("order_delivered"))


def gmv(orders, order_value=AVG_ORDER_VALUE_EUR, day_hours=DELIVERY_DAY_HOURS):
    """Estimated GMV, hourly run rate and end-of-day projection."""
    totals = _delivered(orders).agg(
        F.count("*").alias("n"), F.min("event_time").alias("first"), F.max("event_time").alias("last")
    )
    value = F.col("n") * F.lit(order_value)
    seconds = (F.unix_micros("last") - F.unix_micros("first")) / F.lit(1e6)
    hours = F.greatest(seconds / F.lit(3600.0), F.lit(0.1))
    rate = F.when(F.col("n") > 0, value / hours).otherwise(F.lit(0.0))
    return totals.select(
        value.alias("estimated_gmv_eur"),
        rate.alias("hourly_run_rate_eur"),
        (rate * F.lit(day_hours)).alias("eod_projection_eur"),
    )


def gmv_by_zone(orders, order_value=AVG_ORDER_VALUE_EUR):
    """Delivered orders and estimated GMV per user zone, largest first."""
    return (
        _delivered(orders)
        .filter(F.col("user_zone_id").isNotNull())
        .groupBy(F.col("user_zone_id").alias("zone_id"))
        .agg(F.count("order_id").alias("delivered_orders"))
        .withColumn("estimated_gmv_eur", F.col("delivered_orders") * F.lit(order_value))
        .orderBy(F.desc("estimated_gmv_eur"), "zone_id")
    )


def gmv_over_time(orders, order_value=AVG_ORDER_VALUE_EUR, minutes=BUCKET_MINUTES):
    """Delivered orders and estimated GMV per bucket."""
    return (
        _delivered(orders)
        .filter(F.col("event_time").isNotNull())
        .groupBy(time_bucket("event_time", minutes).alias("bucket"))
        .agg(F.count("order_id").alias("delivered_orders"))
        .withColumn("estimated_gmv_eur", F.col("delivered_orders") * F.lit(order_value))
    )


def gmv_actual(orders, order_values):
    """GMV per zone from the value of each order instead of an assumed mean.

    Deliveries are counted per order first, so repeated deliveries join once.
    """
    per_order = (
        _delivered(orders)
        .filter(F.col("user_zone_id").isNotNull())
        .groupBy("order_id", F.col("user_zone_id").alias("zone_id"))
        .agg(F.count("order_id").alias("n"))
    )
    valued = per_order.join(order_values, "order_id", "left")
    return valued.groupBy("zone_id").agg(
        F.sum("n").alias("delivered_orders"),
        F.coalesce(F.sum(F.col("n") * F.col("value_cents")), F.lit(0)).alias("gmv_cents"),
    )


def top_zones(by_zone, labels, n=10):
    """The ``n`` zones with the largest GMV, with their labels."""
    top = by_zone.orderBy(F.desc("estimated_gmv_eur"), "zone_id").limit(n)
    return top.join(labels, "zone_id", "left").select(
        "zone_id", F.coalesce("zone_label", "zone_id").alias("zone_label"), "delivered_orders", "estimated_gmv_eur"
    )
