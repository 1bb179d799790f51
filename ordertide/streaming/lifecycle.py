"""Per-order state: the last stage of each order and orders stuck without a courier.

Both operators keep their state in Spark's own aggregation and join state, so no
order passes through Python.
"""

from pyspark.sql import functions as F

from ordertide.constants import ALL_CANCEL_TYPES
from ordertide.functions.columns import event_is, minutes_between
from ordertide.operators.windows import watermarked

_TAKEN = ["courier_assigned_order", "order_delivered", *ALL_CANCEL_TYPES]


def order_lifecycle(events, minutes=15, quiet_minutes=240, delay="15 minutes"):
    """Last stage, elapsed time and alert of each order, from both feeds.

    ``stuck`` tells that nothing took a ready order within the given minutes. On a
    stream an order is reported when it has been quiet for ``quiet_minutes``; events
    after that open it anew. In batch there is one row per order.
    """
    rows = watermarked(events.select("order_id", "event_type", "event_time"), delay).filter(
        F.col("order_id").isNotNull() & F.col("event_time").isNotNull()
    )
    quiet = [F.session_window("event_time", f"{quiet_minutes} minutes")] if events.isStreaming else []
    # Ties in time are settled by name, so that the order of arrival does not matter.
    stages = rows.groupBy(*quiet, "order_id").agg(
        F.min("event_time").alias("first_at"),
        F.max(F.struct("event_time", "event_type")).alias("last"),
        F.min(F.when(event_is("order_ready_for_pickup"), F.col("event_time"))).alias("ready_at"),
        F.min(F.when(event_is(*_TAKEN), F.col("event_time"))).alias("taken_at"),
    )
    late = minutes_between(F.col("ready_at"), F.col("taken_at")) > F.lit(float(minutes))
    return stages.select(
        "order_id",
        "first_at",
        F.col("last.event_time").alias("last_at"),
        F.col("last.event_type").alias("last_event"),
        minutes_between(F.col("first_at"), F.col("last.event_time")).alias("elapsed_min"),
        "ready_at",
        (F.col("ready_at").isNotNull() & (F.col("taken_at").isNull() | late)).alias("stuck"),
    )


def stuck_orders(events, minutes=15, look_back_minutes=240, delay="15 minutes"):
    """Ready orders that nothing took in time, reported as soon as the deadline has passed.

    An outer join of the feeds with themselves: a ready order waits in the join state
    until its deadline and comes out if nothing took it by then.
    """
    rows = events.select("order_id", "event_type", "event_time")

    def side(name, *types):
        kept = watermarked(rows.filter(event_is(*types)), delay)
        return kept.select(F.col("order_id").alias(f"{name}_id"), F.col("event_time").alias(f"{name}_at"))

    ready, taken = side("ready", "order_ready_for_pickup"), side("taken", *_TAKEN)
    due = F.col("ready_at") + F.expr(f"interval {minutes} minutes")
    since = F.col("ready_at") - F.expr(f"interval {look_back_minutes} minutes")
    same = (F.col("ready_id") == F.col("taken_id")) & F.col("taken_at").between(since, due)
    return (
        ready.join(taken, same, "left")
        .filter(F.col("taken_id").isNull())
        .select(F.col("ready_id").alias("order_id"), "ready_at", due.alias("due_at"))
    )
