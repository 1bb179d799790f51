"""Courier sessions: runs of courier events with no long gap."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ordertide.functions.columns import count_if, event_is, positive, time_bucket
from ordertide.operators.windows import watermarked

_GAP_MINUTES = 30


def _moving(name="actual_travel_time"):
    return F.when(event_is("courier_delivery_completed"), positive(name))


def _finish(sessions):
    span = (F.unix_micros("last_event") - F.unix_micros("first_event")) / F.lit(6e7)
    return sessions.select(
        "courier_id",
        "first_event",
        "last_event",
        "events",
        "deliveries",
        "zones",
        span.alias("span_min"),
        F.greatest(span - F.col("moving_min"), F.lit(0.0)).alias("idle_min"),
    )


def stream_courier_sessions(couriers, gap_minutes=_GAP_MINUTES, delay="15 minutes"):
    """Sessions on a stream: events, deliveries, zones, span and idle time."""
    sessions = (
        watermarked(couriers.filter(F.col("courier_id").isNotNull()), delay)
        .groupBy(F.session_window("event_time", f"{gap_minutes} minutes"), "courier_id")
        .agg(
            F.min("event_time").alias("first_event"),
            F.max("event_time").alias("last_event"),
            F.count("*").alias("events"),
            count_if(event_is("courier_delivery_completed")).alias("deliveries"),
            F.size(F.collect_set("courier_zone_id")).cast("bigint").alias("zones"),
            F.coalesce(F.sum(_moving()), F.lit(0.0)).alias("moving_min"),
        )
    )
    return _finish(sessions)


def courier_sessions(couriers, gap_minutes=_GAP_MINUTES, slice_minutes=30):
    """The same sessions in batch, without one task per courier.

    Events are first grouped into runs inside slices of time, which spreads a busy
    courier over many tasks. The few runs per slice are then joined into sessions.
    """
    gap = F.lit(gap_minutes * 60_000_000)
    events = couriers.filter(F.col("courier_id").isNotNull() & F.col("event_time").isNotNull()).select(
        "courier_id",
        "event_time",
        "courier_zone_id",
        time_bucket("event_time", slice_minutes).alias("slice"),
        F.when(event_is("courier_delivery_completed"), 1).alias("delivered"),
        _moving().alias("moving"),
    )

    def starts_anew(previous_end, start):
        far = F.unix_micros(start) - F.unix_micros(previous_end) > gap
        return F.when(previous_end.isNull() | far, 1).otherwise(0)

    in_slice = Window.partitionBy("courier_id", "slice").orderBy("event_time")
    marked = events.withColumn("new", starts_anew(F.lag("event_time").over(in_slice), F.col("event_time")))
    upto = in_slice.rowsBetween(Window.unboundedPreceding, 0)
    run_keys = ["courier_id", "slice", "run"]
    numbered = marked.withColumn("run", F.sum("new").over(upto))
    # One row per run and zone; the zone count of a session needs no list of zones.
    by_zone = numbered.groupBy(*run_keys, "courier_zone_id").agg(
        F.min("event_time").alias("start"),
        F.max("event_time").alias("end"),
        F.count("*").alias("events"),
        F.count("delivered").alias("deliveries"),
        F.coalesce(F.sum("moving"), F.lit(0.0)).alias("moving"),
    )
    runs = by_zone.groupBy(*run_keys).agg(F.min("start").alias("start"), F.max("end").alias("end"))
    per_courier = Window.partitionBy("courier_id").orderBy("start")
    sessions_of_runs = runs.withColumn("new", starts_anew(F.lag("end").over(per_courier), F.col("start"))).select(
        *run_keys, F.sum("new").over(per_courier.rowsBetween(Window.unboundedPreceding, 0)).alias("session")
    )
    sessions = (
        by_zone.join(sessions_of_runs, run_keys)
        .groupBy("courier_id", "session", "courier_zone_id")
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.sum("events").alias("events"),
            F.sum("deliveries").alias("deliveries"),
            F.sum("moving").alias("moving"),
        )
        .groupBy("courier_id", "session")
        .agg(
            F.min("start").alias("first_event"),
            F.max("end").alias("last_event"),
            F.sum("events").alias("events"),
            F.sum("deliveries").alias("deliveries"),
            F.count("courier_zone_id").alias("zones"),
            F.sum("moving").alias("moving_min"),
        )
    )
    return _finish(sessions)
