"""Joins of two life-cycle stages of the same order.

An order whose event was ingested more than once pairs every copy with every copy
of the other stage. Copies are counted before the join, so a pile of copies is one
row with a weight (``pairs``) instead of a product of rows.
"""

from pyspark.sql import functions as F

from ordertide.functions.columns import event_is, minutes_between


def stage_times_of(events, event_type, name, *keep):
    """Distinct times of one event type per order, with the number of copies."""
    return (
        events.filter(event_is(event_type) & F.col("order_id").isNotNull() & F.col("event_time").isNotNull())
        .groupBy("order_id", F.col("event_time").alias(name), *keep)
        .agg(F.count("*").alias(f"{name}_copies"))
    )


def stage_pairs(first, first_type, second, second_type, names, keep_first=(), keep_second=()):
    """Every pairing of two event types per order with its weight."""
    a, b = names
    left = stage_times_of(first, first_type, a, *keep_first)
    right = stage_times_of(second, second_type, b, *keep_second)
    return left.join(right, "order_id").select(
        "order_id",
        a,
        b,
        *keep_first,
        *keep_second,
        minutes_between(F.col(a), F.col(b)).alias("gap_min"),
        (F.col(f"{a}_copies") * F.col(f"{b}_copies")).alias("pairs"),
    )


def created_delivered(orders):
    """Created and delivered time per order; only deliveries after the creation."""
    both = stage_pairs(
        orders, "order_created", orders, "order_delivered", ("created_at", "delivered_at"), ("user_zone_id",)
    )
    return both.withColumnRenamed("gap_min", "full_delivery_min").filter(F.col("full_delivery_min") > 0)


def stage_gap(orders, first_type, second_type):
    """Minutes between two event types of an order, negative gaps left out."""
    return stage_pairs(orders, first_type, orders, second_type, ("t_a", "t_b")).filter(F.col("gap_min") >= 0)


def weighted_mean(value, weight="pairs"):
    """Mean over pairings; null when there are none."""
    return F.try_divide(F.sum(F.col(value) * F.col(weight)), F.sum(weight))
