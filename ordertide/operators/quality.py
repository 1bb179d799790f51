"""Data-quality detectors and service analytics over the two feeds."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ordertide.functions.columns import (
    any_of,
    count_if,
    event_is,
    hour_of_day,
    minutes_between,
    or_zero,
    positive,
    time_bucket,
    to_time,
)
from ordertide.functions.quantiles import exact_quantiles
from ordertide.operators.enrich import backfill_category, route_lookup
from ordertide.operators.pairs import stage_pairs, weighted_mean
from ordertide.operators.tables import union_feeds
from ordertide.schemas import COURIER_FEED, ORDER_FEED

# Fields every order event must carry.
REQUIRED_ORDER_FIELDS = [
    "event_id",
    "event_type",
    "event_version",
    "event_time",
    "ingestion_time",
    "order_id",
    "user_id",
    "restaurant_id",
    "user_zone_id",
    "restaurant_zone_id",
    "restaurant_category",
    "match_day_flag",
    "holiday_flag",
    "anomaly_flag",
]

REQUIRED_BEFORE_DELIVERY = [
    "order_created",
    "order_confirmed",
    "order_preparing",
    "order_ready_for_pickup",
    "order_picked_up",
]


def with_violations(events, required, known_types):
    """Events in wire form with the names of the schema rules they break."""
    checks = [(F.col(name).isNull(), f"missing {name}") for name in required]
    checks.append((F.col("event_type").isNotNull() & ~F.col("event_type").isin(*known_types), "unknown event_type"))
    for name in ("event_time", "ingestion_time"):
        checks.append((F.col(name).isNotNull() & to_time(name).isNull(), f"unreadable {name}"))
    names = F.array_compact(F.array(*[F.when(broken, F.lit(rule)) for broken, rule in checks]))
    return events.withColumn("violations", names)


def schema_violations(events, required, known_types):
    """Number of events that break each schema rule."""
    broken = with_violations(events, required, known_types)
    return broken.select(F.explode("violations").alias("rule")).groupBy("rule").agg(F.count("*").alias("events"))


def late_events(orders, couriers, minutes=60):
    """Share and delay percentiles of late events per feed and bucket."""
    rows = union_feeds(
        orders.select("event_time", "is_late_event", "event_delay_seconds"),
        couriers.select("event_time", "is_late_event", "event_delay_seconds"),
    ).filter(F.col("event_time").isNotNull())
    rows = rows.withColumn("bucket", time_bucket("event_time", minutes))
    counts = rows.groupBy("feed", "bucket").agg(
        F.count("*").alias("events"), count_if(F.col("is_late_event")).alias("late_events")
    )
    delays = exact_quantiles(
        rows.filter(F.col("is_late_event")),
        ["feed", "bucket"],
        "event_delay_seconds",
        {"p50_delay_s": 0.5, "p95_delay_s": 0.95},
    ).drop("n")
    share = F.col("late_events") / F.col("events")
    return counts.join(delays, ["feed", "bucket"], "left").select(
        "feed", "bucket", "events", "late_events", share.alias("late_share"), "p50_delay_s", "p95_delay_s"
    )


def duplicate_events(orders):
    """Logical events present more than once: copies and distinct event ids."""
    return (
        orders.groupBy("order_id", "event_type", "event_time")
        .agg(F.count("*").alias("copies"), F.countDistinct("event_id").alias("event_ids"))
        .filter(F.col("copies") > 1)
    )


def out_of_order(events, key="order_id", slice_minutes=60):
    """Events older than one that arrived before them for the same key.

    The running maximum is taken inside slices of arrival time and carried from
    slice to slice, so a key with very many events is spread over its slices.
    """
    # Only the order of arrival matters inside a slice; event_id breaks ties.
    sliced = events.filter(F.col(key).isNotNull() & F.col("ingestion_time").isNotNull()).select(
        key,
        "event_id",
        "event_type",
        "event_time",
        "ingestion_time",
        time_bucket("ingestion_time", slice_minutes).alias("_slice"),
    )
    earlier_slices = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        sliced.groupBy(key, "_slice")
        .agg(F.max("event_time").alias("_latest"))
        .select(key, "_slice", F.max("_latest").over(earlier_slices).alias("_carried"))
    )
    in_slice = (
        Window.partitionBy(key, "_slice")
        .orderBy("ingestion_time", "event_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    latest = F.greatest("_carried", F.max("event_time").over(in_slice))
    return (
        sliced.join(carried, [key, "_slice"])
        .withColumn("latest_before", latest)
        .filter(F.col("event_time") < F.col("latest_before"))
        .select(
            "event_id",
            key,
            "event_type",
            "event_time",
            "latest_before",
            minutes_between(F.col("event_time"), F.col("latest_before")).alias("behind_min"),
        )
    )


def missing_steps(orders, end="order_delivered", required=REQUIRED_BEFORE_DELIVERY):
    """Steps that an order which reached its end never reported."""
    seen = orders.groupBy("order_id").agg(
        any_of(event_is(end)).alias("ended"), *[any_of(event_is(step)).alias(step) for step in required]
    )
    absent = F.array_compact(F.array(*[F.when(F.col(step) == 0, F.lit(step)) for step in required]))
    return seen.filter(F.col("ended") == 1).select("order_id", F.explode(absent).alias("missing_step"))


def _negative(events, feed, fields, flagged):
    values = F.filter(
        F.array(*[F.struct(F.lit(name).alias("field"), F.col(name).alias("value")) for name in fields]),
        lambda item: item["value"] < 0,
    )
    return events.select(
        F.lit(feed).alias("feed"), "event_id", "order_id", flagged.alias("flagged"), F.explode(values).alias("v")
    ).select("feed", "event_id", "order_id", "v.field", "v.value", "flagged")


def impossible_durations(orders, couriers):
    """Negative durations in either feed and whether the event was flagged as anomalous."""
    order_fields = ["estimated_prep_time", "actual_prep_time", "estimated_delivery_time", "actual_delivery_time"]
    flagged = F.coalesce("anomaly_flag", F.lit(False))
    return _negative(orders, ORDER_FEED, order_fields, flagged).unionByName(
        _negative(couriers, COURIER_FEED, ["estimated_travel_time", "actual_travel_time"], F.lit(False))
    )


def unflagged_durations(orders, couriers):
    return impossible_durations(orders, couriers).filter(~F.col("flagged"))


def offline_mid_delivery(couriers):
    """Deliveries whose courier went offline: what followed and how long it took."""

    def first(event_type):
        return F.min(F.when(event_is(event_type), F.col("event_time")))

    per_order = (
        couriers.filter(
            F.col("order_id").isNotNull()
            & event_is(
                "courier_offline_mid_delivery",
                "courier_abandoned_delivery",
                "courier_reassigned",
                "courier_delivery_completed",
            )
        )
        .groupBy("order_id")
        .agg(
            first("courier_offline_mid_delivery").alias("offline_at"),
            first("courier_abandoned_delivery").alias("abandoned_at"),
            first("courier_reassigned").alias("reassigned_at"),
            F.max(F.when(event_is("courier_delivery_completed"), F.col("event_time"))).alias("completed_at"),
        )
    )
    completed = F.when(F.col("completed_at") >= F.col("offline_at"), F.col("completed_at"))
    return per_order.filter(F.col("offline_at").isNotNull()).select(
        "order_id",
        "offline_at",
        "abandoned_at",
        "reassigned_at",
        completed.alias("completed_at"),
        completed.isNotNull().alias("recovered"),
        minutes_between(F.col("offline_at"), completed).alias("minutes_to_recovery"),
    )


def outlier_prep_times(orders, whisker=1.5):
    """Delivered orders whose preparation time lies outside the whiskers of its category."""
    timed = (
        backfill_category(orders)
        .filter(event_is("order_delivered") & F.col("restaurant_category").isNotNull())
        .select("event_id", "order_id", F.col("restaurant_category").alias("category"), "actual_prep_time")
    )
    quartiles = exact_quantiles(timed, ["category"], "actual_prep_time", {"q1": 0.25, "q3": 0.75})
    spread = (F.col("q3") - F.col("q1")) * F.lit(whisker)
    bounds = quartiles.select(
        "category", (F.col("q1") - spread).alias("lower"), (F.col("q3") + spread).alias("upper")
    )
    value = F.col("actual_prep_time")
    return timed.join(bounds, "category").filter((value < F.col("lower")) | (value > F.col("upper")))


def _assignments(couriers):
    return couriers.filter(event_is("courier_assigned_order")).select(
        "order_id", F.col("event_time").alias("assigned_at")
    )


def unassigned_orders(orders, couriers, minutes=15):
    """Ready orders without a courier assignment up to the given time after; an earlier one counts."""
    ready = (
        orders.filter(event_is("order_ready_for_pickup") & F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(F.min("event_time").alias("ready_at"), F.max("restaurant_zone_id").alias("zone_id"))
    )
    assigned = _assignments(couriers)
    waited = minutes_between(ready["ready_at"], assigned["assigned_at"])
    in_time = (ready["order_id"] == assigned["order_id"]) & (waited <= F.lit(float(minutes)))
    return ready.join(assigned, in_time, "left_anti")


def prep_sla(orders):
    """On-time rate and percentiles of preparation per restaurant and category."""
    keys = ["restaurant_id", "category"]
    prep = (
        backfill_category(orders)
        .filter(event_is("order_ready_for_pickup"))
        .select(
            "restaurant_id",
            F.col("restaurant_category").alias("category"),
            positive("actual_prep_time").alias("prep"),
            F.col("estimated_prep_time").alias("promised"),
        )
        .filter(F.col("prep").isNotNull() & F.col("restaurant_id").isNotNull() & F.col("category").isNotNull())
    )
    in_time = F.when(F.col("prep") <= F.col("promised"), 1.0).when(F.col("promised").isNotNull(), 0.0)
    rates = prep.groupBy(*keys).agg((F.avg(in_time) * 100).alias("on_time_rate_pct"))
    tails = exact_quantiles(prep, keys, "prep", {"p50_prep_min": 0.5, "p95_prep_min": 0.95})
    return rates.join(tails.withColumnRenamed("n", "orders"), keys)


def dispatch_latency(orders, couriers):
    """Mean minutes from ready to assigned per restaurant zone and hour of the day."""
    gaps = stage_pairs(
        orders,
        "order_ready_for_pickup",
        couriers,
        "courier_assigned_order",
        ("ready_at", "assigned_at"),
        keep_first=("restaurant_zone_id",),
    ).filter((F.col("gap_min") >= 0) & F.col("restaurant_zone_id").isNotNull())
    return gaps.groupBy(
        F.col("restaurant_zone_id").alias("zone_id"), hour_of_day("ready_at").cast("bigint").alias("hour")
    ).agg(F.sum("pairs").alias("dispatches"), weighted_mean("gap_min").alias("avg_dispatch_min"))


def courier_availability(couriers):
    """Distinct couriers that came online per zone and hour."""
    online = couriers.filter(
        event_is("courier_online") & F.col("courier_zone_id").isNotNull() & F.col("event_time").isNotNull()
    )
    return (
        online.select(time_bucket("event_time", 60).alias("hour_start"), "courier_zone_id", "courier_id")
        .filter(F.col("courier_id").isNotNull())
        .distinct()
        .groupBy("hour_start", F.col("courier_zone_id").alias("zone_id"))
        .agg(F.count("*").alias("online_couriers"))
    )


def shift_coverage(couriers):
    """First and last event, span, events and deliveries of each shift."""
    return (
        couriers.filter(F.col("shift_id").isNotNull())
        .groupBy("shift_id")
        .agg(
            F.min("event_time").alias("first_event"),
            F.max("event_time").alias("last_event"),
            F.count("*").alias("events"),
            count_if(event_is("courier_delivery_completed")).alias("deliveries"),
        )
        .withColumn("span_min", minutes_between(F.col("first_event"), F.col("last_event")))
    )


def route_performance(couriers, matrix):
    """Travel time per leg and zone pair against the travel matrix."""

    def leg(name, event_type, origin, destination):
        return couriers.filter(event_is(event_type)).select(
            F.lit(name).alias("leg"),
            F.col(origin).alias("zone_from"),
            F.col(destination).alias("zone_to"),
            positive("actual_travel_time").alias("minutes"),
        )

    legs = leg("to_restaurant", "courier_arrived_restaurant", "courier_zone_id", "restaurant_zone_id").unionByName(
        leg("to_customer", "courier_delivery_completed", "restaurant_zone_id", "user_zone_id")
    )
    actual = (
        legs.filter(F.col("minutes").isNotNull() & F.col("zone_from").isNotNull() & F.col("zone_to").isNotNull())
        .groupBy("leg", "zone_from", "zone_to")
        .agg(F.count("*").alias("trips"), F.avg("minutes").alias("avg_actual_min"))
    )
    # The matrix is read after the aggregation: one lookup per pair, not per trip.
    pairs = actual.withColumnsRenamed({"zone_from": "origin", "zone_to": "destination"})
    return route_lookup(pairs, matrix, "origin", "destination").select(
        "leg",
        F.col("origin").alias("zone_from"),
        F.col("destination").alias("zone_to"),
        "trips",
        "avg_actual_min",
        "mean_time_min",
        (F.col("avg_actual_min") - F.col("mean_time_min")).alias("over_mean_min"),
    )


def zone_congestion(orders, couriers):
    """Mean pickup delay and share of abandoned assignments per restaurant zone."""
    delay = (
        stage_pairs(
            orders,
            "order_ready_for_pickup",
            orders,
            "order_picked_up",
            ("t_a", "t_b"),
            keep_first=("restaurant_zone_id",),
        )
        .filter((F.col("gap_min") >= 0) & F.col("restaurant_zone_id").isNotNull())
        .groupBy(F.col("restaurant_zone_id").alias("zone_id"))
        .agg(weighted_mean("gap_min").alias("avg_pickup_delay_min"), F.sum("pairs").alias("pickups"))
    )
    load = (
        couriers.filter(
            event_is("courier_assigned_order", "courier_abandoned_delivery") & F.col("restaurant_zone_id").isNotNull()
        )
        .groupBy(F.col("restaurant_zone_id").alias("zone_id"))
        .agg(
            count_if(event_is("courier_assigned_order")).alias("assigned"),
            count_if(event_is("courier_abandoned_delivery")).alias("abandoned"),
        )
    )
    return delay.join(load, "zone_id", "full").select(
        "zone_id",
        "avg_pickup_delay_min",
        or_zero("pickups").alias("pickups"),
        or_zero("assigned").alias("assigned"),
        or_zero("abandoned").alias("abandoned"),
        F.try_divide(F.col("abandoned"), F.col("assigned")).alias("abandonment_rate"),
    )


