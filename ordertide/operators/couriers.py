"""Courier KPIs and demand-supply tables."""

from pyspark.sql import functions as F

from ordertide.constants import BUCKET_MINUTES
from ordertide.functions.columns import any_of, clock_text, count_if, day_start, event_is, or_zero, time_bucket


def courier_kpis(couriers):
    """Active and online couriers, deliveries and deliveries per active courier.

    When no courier reported online, every courier seen counts as online.
    """
    per_courier = (
        couriers.filter(F.col("courier_id").isNotNull())
        .groupBy("courier_id")
        .agg(
            any_of(event_is("courier_assigned_order")).alias("active"),
            any_of(event_is("courier_online")).alias("online"),
            count_if(event_is("courier_delivery_completed")).alias("deliveries"),
        )
    )
    totals = per_courier.agg(
        or_zero(F.sum("active")).alias("active_couriers"),
        F.coalesce(F.nullif(F.sum("online"), F.lit(0)), F.count("*")).alias("online_couriers"),
        or_zero(F.sum("deliveries")).alias("deliveries_completed"),
    )
    return totals.withColumn(
        "utilization_rate", F.try_divide(F.col("deliveries_completed"), F.col("active_couriers"))
    )


def courier_activity(couriers, minutes=BUCKET_MINUTES):
    """Distinct active and online couriers per bucket, without filling gaps."""
    seen = (
        couriers.filter(event_is("courier_assigned_order", "courier_online") & F.col("event_time").isNotNull())
        .groupBy(time_bucket("event_time", minutes).alias("bucket"), "courier_id")
        .agg(
            any_of(event_is("courier_assigned_order")).alias("active"),
            any_of(event_is("courier_online")).alias("online"),
        )
    )
    named = F.col("courier_id").isNotNull()
    return seen.groupBy("bucket").agg(
        or_zero(F.sum(F.when(named, F.col("active")))).alias("active_couriers"),
        or_zero(F.sum(F.when(named, F.col("online")))).alias("online_couriers"),
    )


def courier_activity_approx(couriers, minutes=BUCKET_MINUTES, rsd=0.01, delay="15 minutes"):
    """Courier activity with approximate distinct counts, for streams."""
    rows = couriers.filter(event_is("courier_assigned_order", "courier_online"))
    if couriers.isStreaming:
        rows = rows.withWatermark("event_time", delay)

    def distinct(kind):
        return F.approx_count_distinct(F.when(event_is(kind), F.col("courier_id")), rsd)

    windows = rows.groupBy(F.window("event_time", f"{minutes} minutes")).agg(
        distinct("courier_assigned_order").alias("active_couriers"),
        distinct("courier_online").alias("online_couriers"),
    )
    return windows.select(F.col("window.start").alias("bucket"), "active_couriers", "online_couriers")


def _distinct_couriers(couriers, event_type, name, minutes, *keys):
    pairs = couriers.filter(
        event_is(event_type) & F.col("courier_id").isNotNull() & F.col("event_time").isNotNull()
    ).select(time_bucket("event_time", minutes).alias("bucket"), *keys, "courier_id")
    names = [key for key in pairs.columns if key != "courier_id"]
    return pairs.distinct().groupBy(*names).agg(F.count("*").alias(name))


def series_align(couriers, minutes=BUCKET_MINUTES):
    """Active and online series joined on all buckets of either, absent as zero."""
    active = _distinct_couriers(couriers, "courier_assigned_order", "active_couriers", minutes)
    online = _distinct_couriers(couriers, "courier_online", "online_couriers", minutes)
    return active.join(online, "bucket", "full").fillna(0)


def bucket_union(orders, couriers, minutes=BUCKET_MINUTES):
    """Buckets in which either feed has an event."""

    def buckets(df):
        return df.filter(F.col("event_time").isNotNull()).select(time_bucket("event_time", minutes).alias("bucket"))

    return buckets(orders).distinct().union(buckets(couriers).distinct()).distinct()


def zone_demand(orders, minutes=BUCKET_MINUTES):
    """Created orders per bucket and user zone."""
    created = orders.filter(
        event_is("order_created") & F.col("user_zone_id").isNotNull() & F.col("event_time").isNotNull()
    )
    return created.groupBy(
        time_bucket("event_time", minutes).alias("bucket"), F.col("user_zone_id").alias("zone_id")
    ).agg(F.count("order_id").alias("orders"))


def zone_demand_supply(orders, couriers, minutes=BUCKET_MINUTES):
    """Orders per courier by bucket and zone, wherever there is demand or supply."""
    supply = _distinct_couriers(
        couriers.filter(F.col("courier_zone_id").isNotNull()),
        "courier_assigned_order",
        "couriers",
        minutes,
        F.col("courier_zone_id").alias("zone_id"),
    )
    merged = zone_demand(orders, minutes).join(supply, ["bucket", "zone_id"], "full")
    return merged.select(
        "bucket",
        "zone_id",
        or_zero("orders").alias("orders"),
        or_zero("couriers").alias("couriers"),
        (or_zero("orders") / F.greatest(or_zero("couriers").cast("double"), F.lit(0.1))).alias("demand_courier_ratio"),
    )


def supply_demand_gap(orders, couriers, minutes=BUCKET_MINUTES):
    """New orders against active couriers on one time axis."""
    created = (
        orders.filter(event_is("order_created") & F.col("event_time").isNotNull())
        .groupBy(time_bucket("event_time", minutes).alias("bucket"))
        .agg(F.count("order_id").alias("orders_created"))
    )
    active = _distinct_couriers(couriers, "courier_assigned_order", "active_couriers", minutes)
    return created.join(active, "bucket", "full").select(
        "bucket",
        or_zero("orders_created").alias("orders_created"),
        or_zero("active_couriers").alias("active_couriers"),
        (or_zero("orders_created") - or_zero("active_couriers")).alias("supply_gap"),
    )


def day_slots(minutes=BUCKET_MINUTES):
    """Names of the buckets of one day: ``t0000``, ``t0015``, ..."""
    return [f"t{m // 60:02d}{m % 60:02d}" for m in range(0, 24 * 60, minutes)]


def zone_stress_pivot(ratios, labels, minutes=BUCKET_MINUTES):
    """Zone and day by time of day, holding the mean demand ratio, 0 where absent.

    A day has a fixed number of buckets, so the columns stay bounded however long
    the feed is.
    """
    named = ratios.join(labels, "zone_id", "left").select(
        F.coalesce("zone_label", "zone_id").alias("zone_label"),
        day_start("bucket").alias("day"),
        F.concat(F.lit("t"), clock_text("bucket", "")).alias("slot"),
        "demand_courier_ratio",
    )
    return (
        named.groupBy("zone_label", "day")
        .pivot("slot", day_slots(minutes))
        .agg(F.avg("demand_courier_ratio"))
        .fillna(0.0)
    )
