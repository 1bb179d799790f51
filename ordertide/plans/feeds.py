"""Order and courier feeds, and reference tables, derived from the given tables.

One row of ``events`` becomes one order with up to six life-cycle events, plus the
courier events that serve it. Only integer arithmetic is used, so the same rules
can be written in any SQL dialect.
"""

from pyspark.sql import functions as F

from ordertide.schemas import COURIER_EVENTS, ORDER_EVENTS

CATEGORIES = ["burger", "pizza", "mexican", "sushi", "fast_food", "healthy", "dessert"]
ZONE_COUNT = 25

# (variant, step, event type): a variant is one way a row can emit an event.
_ORDER_STEPS = [
    ("created", 0, "order_created"),
    ("confirmed", 1, "order_confirmed"),
    ("preparing", 2, "order_preparing"),
    ("cancel_user", 3, "order_cancelled_user"),
    ("cancel_restaurant", 3, "order_cancelled_restaurant"),
    ("ready", 3, "order_ready_for_pickup"),
    ("cancel_system", 4, "order_cancelled_system"),
    ("picked", 4, "order_picked_up"),
    ("delivered", 5, "order_delivered"),
    ("logical_copy", 0, "order_created"),
    ("exact_copy", 0, "order_created"),
]
_COURIER_STEPS = [
    (0, "courier_online"),
    (1, "courier_assigned_order"),
    (2, "courier_arrived_restaurant"),
    (3, "courier_pickup_completed"),
    (4, "courier_offline_mid_delivery"),
    (5, "courier_abandoned_delivery"),
    (6, "courier_reassigned"),
    (7, "courier_arrived_customer_zone"),
    (8, "courier_delivery_completed"),
]


def _base(events):
    e = F.col("event_id")
    return events.select(
        e.alias("e"),
        F.col("user_id").alias("u"),
        F.col("event_type").alias("k"),
        F.col("ts").cast("timestamp").alias("ts"),
        (F.lit(5) + (e * 13) % 25).alias("prep"),
        (F.lit(3) + (e * 17) % 50).alias("trav"),
        F.col("event_type").isin("click", "signup", "purchase").alias("done"),
    )


def _zone(number):
    return F.concat(F.lit("Z"), F.lpad(number.cast("string"), 2, "0"))


def _category(number):
    index = (number % len(CATEGORIES)).cast("int") + 1
    return F.element_at(F.array(*[F.lit(c) for c in CATEGORIES]), index)


def _shift_minutes(ts, minutes):
    return F.timestamp_micros(F.unix_micros(ts) + minutes * F.lit(60_000_000))


def _late(e):
    """Every fiftieth row arrives late; others have no delay."""
    late = (e % 50) == 0
    delay = F.when(late, (F.lit(10) + e % 291).cast("double"))
    return late, delay


def order_feed(events):
    e, u, k = F.col("e"), F.col("u"), F.col("k")
    variant, step = F.col("s.variant"), F.col("s.step")
    prep, trav, done = F.col("prep"), F.col("trav"), F.col("done")
    failed = k == "error"
    emitted = (
        F.when(variant == "created", True)
        .when(variant.isin("confirmed", "preparing"), ~(failed & (e % 3 == 0)))
        .when(variant == "cancel_user", failed & (e % 3 == 0))
        .when(variant == "cancel_restaurant", failed & (e % 3 == 1))
        .when(variant == "ready", ~failed | (e % 3 == 2))
        .when(variant == "cancel_system", failed & (e % 3 == 2))
        .when(variant == "picked", done & (e % 100 != 1))
        .when(variant == "delivered", done)
        .when(variant == "logical_copy", e % 200 == 0)
        .when(variant == "exact_copy", e % 150 == 0)
    )
    offset = (
        F.when(variant.isin("confirmed", "preparing"), 1)
        .when(variant.isin("ready", "cancel_restaurant"), prep)
        .when(variant == "cancel_system", prep + 60)
        .when(variant == "picked", prep + 2)
        .when(variant == "delivered", prep + 2 + trav)
        .otherwise(0)
    )
    steps = F.array(
        *[
            F.struct(F.lit(v).alias("variant"), F.lit(n).alias("step"), F.lit(t).alias("event_type"))
            for v, n, t in _ORDER_STEPS
        ]
    )
    rows = (
        _base(events)
        .select("*", F.explode(steps).alias("s"))
        .filter(emitted)
        .select("*", _shift_minutes(F.col("ts"), offset).alias("event_time"))
    )
    created = step == 0
    delivered = variant == "delivered"
    handed_over = variant.isin("picked", "delivered")
    odd = e % 97 == 0
    late, delay = _late(e)
    plain_id = F.concat(F.lit("E"), e.cast("string"), F.lit("-"), step.cast("string"))
    columns = {
        "event_id": F.when(variant == "logical_copy", F.concat(F.lit("EVT"), e.cast("string"))).otherwise(plain_id),
        "event_type": F.col("s.event_type"),
        "event_version": F.lit("1.0"),
        "event_time": F.col("event_time"),
        "ingestion_time": F.timestamp_micros(
            F.unix_micros("event_time") + F.coalesce(delay, F.lit(0.0)).cast("bigint") * 1_000_000
        ),
        "order_id": F.concat(F.lit("ORD"), F.lpad(e.cast("string"), 8, "0")),
        "user_id": F.concat(F.lit("U"), F.lpad(u.cast("string"), 6, "0")),
        "restaurant_id": F.concat(F.lit("R"), (e % 10).cast("string")),
        "courier_id": F.when(handed_over, F.concat(F.lit("C"), F.lpad(((e * 7) % 40).cast("string"), 5, "0"))),
        "user_zone_id": _zone(u % ZONE_COUNT),
        "restaurant_zone_id": _zone((e * 5 + u) % ZONE_COUNT),
        "estimated_prep_time": (F.lit(5) + (e * 11) % 25).cast("double"),
        "actual_prep_time": F.when(delivered & odd, -3.0).otherwise(prep.cast("double")),
        "estimated_delivery_time": (prep + trav + 5).cast("double"),
        "actual_delivery_time": F.when(delivered, F.when(odd, -7.0).otherwise(trav.cast("double"))),
        "promo_applied": F.lit(None).cast("string"),
        "restaurant_category": F.when(created, _category(e)),
        "match_day_flag": e % 7 == 3,
        "holiday_flag": (F.month("ts") * 100 + F.dayofmonth("ts")).isin(101, 106),
        "anomaly_flag": delivered & odd,
        "is_late_event": late,
        "event_delay_seconds": delay,
    }
    return rows.select(*[columns[name].alias(name) for name in ORDER_EVENTS.names])


def courier_feed(events):
    e, u, k = F.col("e"), F.col("u"), F.col("k")
    step, prep, trav, done = F.col("s.step"), F.col("prep"), F.col("trav"), F.col("done")
    lost = done & (e % 100 == 2)
    emitted = (
        F.when(step == 0, k == "signup")
        .when(step.isin(1, 2, 3), done)
        .when(step.isin(4, 5), lost)
        .when(step == 6, done & (e % 200 == 2))
        .when(step.isin(7, 8), done & (e % 200 != 102))
    )
    offset = (
        F.when(step == 0, 0)
        .when(step == 1, prep)
        .when(step == 2, prep + 1)
        .when(step == 3, prep + 2)
        .when(step.isin(4, 5, 6), prep + 3)
        .when(step == 7, prep + 1 + trav)
        .when(step == 8, prep + 2 + trav)
    )
    steps = F.array(
        *[F.struct(F.lit(n).alias("step"), F.lit(t).alias("event_type")) for n, t in _COURIER_STEPS]
    )
    rows = (
        _base(events)
        .select("*", F.explode(steps).alias("s"))
        .filter(emitted)
        .select("*", _shift_minutes(F.col("ts"), offset).alias("event_time"))
    )
    late, delay = _late(e)
    busy = step != 0
    courier_no = (e * 7) % 40
    hops = ((e * 5) % 6).cast("double")
    columns = {
        "event_id": F.concat(F.lit("K"), e.cast("string"), F.lit("-"), step.cast("string")),
        "event_type": F.col("s.event_type"),
        "event_version": F.lit("1.0"),
        "event_time": F.col("event_time"),
        "ingestion_time": F.timestamp_micros(
            F.unix_micros("event_time") + F.coalesce(delay, F.lit(0.0)).cast("bigint") * 1_000_000
        ),
        "courier_id": F.concat(F.lit("C"), F.lpad(courier_no.cast("string"), 5, "0")),
        "courier_zone_id": _zone((e * 11) % ZONE_COUNT),
        "order_id": F.when(busy, F.concat(F.lit("ORD"), F.lpad(e.cast("string"), 8, "0"))),
        "restaurant_id": F.when(busy, F.concat(F.lit("R"), (e % 10).cast("string"))),
        "restaurant_zone_id": F.when(busy, _zone((e * 5 + u) % ZONE_COUNT)),
        "user_zone_id": F.when(busy, _zone(u % ZONE_COUNT)),
        "shift_id": F.concat(F.lit("S"), courier_no.cast("string"), F.lit("-"), F.dayofmonth("ts").cast("string")),
        "courier_status": F.when(step == 0, "online").when(step.isin(4, 5), "offline").otherwise("busy"),
        "zone_hops_to_restaurant": F.when(step == 1, hops),
        "zone_hops_to_user": F.when(busy, ((e * 3) % 6).cast("double")),
        "estimated_travel_time": F.when(step == 1, (trav + 2).cast("double")),
        "actual_travel_time": F.when(step == 2, (F.lit(1) + e % 15).cast("double")).when(
            step == 8, F.when(e % 499 == 0, -5.0).otherwise(trav.cast("double"))
        ),
        "offline_reason": F.when(step == 4, "technical_issue").when(step == 5, "courier_offline_mid_delivery"),
        "is_late_event": late,
        "event_delay_seconds": delay,
    }
    return rows.select(*[columns[name].alias(name) for name in COURIER_EVENTS.names])


def harder(feed):
    """A feed with silences, orders that come back after weeks, swapped times, and nulls, by order number."""
    e, kind = F.substring("order_id", 4, 8).cast("bigint"), F.col("event_type")
    minutes = (
        F.when((kind == "order_delivered") & (e % 61 == 0), 21_600)
        .when((kind == "order_delivered") & (e % 53 == 0), 300)
        .when((kind == "order_picked_up") & (e % 59 == 0), 240)
        .otherwise(0)
    )
    moved = _shift_minutes(F.col("event_time"), F.coalesce(minutes, F.lit(0)).cast("bigint"))
    return feed.withColumns(
        {
            "event_time": F.when(F.coalesce(e % 71 != 0, F.lit(True)), moved),
            "order_id": F.when(e % 67 != 0, F.col("order_id")),
        }
    )


def order_values(events):
    """Value of each order in cents."""
    return events.select(
        F.concat(F.lit("ORD"), F.lpad(F.col("event_id").cast("string"), 8, "0")).alias("order_id"),
        F.floor(F.col("value") * 100).cast("bigint").alias("value_cents"),
    )


def zones(nation):
    k = F.col("n_nationkey").cast("bigint")
    return nation.select(
        _zone(k).alias("zone_id"),
        F.col("n_name").alias("district"),
        (F.lit(100000) + k * 1000).cast("int").alias("population"),
        ((k + 1).cast("double") / 256.0).alias("spawn_probability"),
        (k % 5).cast("double").alias("centroid_x"),
        F.floor(k / 5).cast("double").alias("centroid_y"),
        (F.lit(1.0) - k.cast("double") / 100.0).alias("centrality_weight"),
    )


def restaurants(supplier, nation):
    s = F.col("s_suppkey")
    named = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return named.select(
        F.concat(F.lit("R"), s.cast("string")).alias("restaurant_id"),
        F.col("s_name").alias("name"),
        _zone(F.col("s_nationkey")).alias("zone_id"),
        F.col("n_name").alias("district"),
        _category(s).alias("category"),
        (F.lit(1) + s % 3).cast("int").alias("price_level"),
        (F.lit(8) + s % 20).cast("double").alias("base_prep_time_mean_min"),
        (F.lit(2) + s % 4).cast("double").alias("base_prep_time_std_min"),
        F.when(s % 2 == 0, "large").otherwise("small").alias("capacity_tier"),
        F.element_at(F.array(*map(F.lit, [" True", "yes", "1", "no", "false"])), (s % 5).cast("int") + 1).alias(
            "has_consistent_promo"
        ),
        F.when(s % 4 == 0, "weekly").otherwise("none").alias("promo_pattern"),
        F.element_at(F.array(*map(F.lit, ["high", "medium", "low"])), (s % 3).cast("int") + 1).alias(
            "matchday_sensitivity"
        ),
        ((F.lit(80) + s % 50).cast("double") / 100.0).alias("latency_pressure_factor"),
    )


def travel_matrix(nation):
    """Zone pairs, with some pairs left out so that lookups can miss."""
    a, b = F.col("a"), F.col("b")
    pairs = nation.select(
        F.col("n_nationkey").cast("bigint").alias("a"),
        F.col("n_name").alias("district_from"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(ZONE_COUNT - 1).cast("bigint"))).alias("b"),
    ).filter((a * 7 + b) % 23 != 0)
    named = pairs.join(
        nation.select(F.col("n_nationkey").cast("bigint").alias("b"), F.col("n_name").alias("district_to")), "b"
    )
    hops = F.least(F.abs(a - b), F.lit(ZONE_COUNT) - F.abs(a - b))
    return named.select(
        _zone(a).alias("zone_from"),
        _zone(b).alias("zone_to"),
        "district_from",
        "district_to",
        hops.cast("int").alias("hop_count"),
        (hops * 5 / 4.0).alias("distance_index"),
        (F.lit(8) + hops * 6).cast("double").alias("mean_time_min"),
        ((F.lit(4) + hops) / 2.0).alias("std_dev_min"),
        ((F.lit(6) + hops) / 100.0).alias("base_delay_probability"),
        ((F.lit(4) + hops) / 4.0).alias("pickup_cancel_factor"),
        ((F.lit(9) + hops) / 10.0).alias("user_cancel_sensitivity"),
        F.when(a == b, "true").otherwise("false").alias("same_zone"),
    )


def match_effects(nation):
    k = F.col("n_nationkey").cast("bigint")
    away = nation.select(((k + ZONE_COUNT - 1) % ZONE_COUNT).alias("home_key"), F.col("n_name").alias("away_name"))
    return nation.join(away, k == F.col("home_key")).select(
        F.lit("match_day").alias("event_type"),
        F.concat(F.lit("Team "), F.col("n_regionkey").cast("string")).alias("home_team"),
        F.col("n_name").alias("primary_district"),
        F.col("away_name").alias("secondary_district"),
        _category(F.floor(k / 2)).alias("category"),
        ((F.lit(11) + k % 8) / 10.0).alias("demand_multiplier"),
    )


def promotions(nation):
    """Promotions of a category with a time of validity, some of them at the same time."""
    k = F.col("n_nationkey").cast("bigint")
    start = F.unix_micros(F.lit("2024-01-01 00:00:00+00:00").cast("timestamp")) + (k * 7 % 100) * F.lit(3_600_000_000)
    return nation.select(
        _category(k).alias("category"),
        F.timestamp_micros(start).alias("valid_from"),
        F.timestamp_micros(start + (k + 6) * F.lit(3_600_000_000)).alias("valid_to"),
        ((F.lit(11) + k % 9) / 10.0).alias("multiplier"),
    )


def match_schedule(nation):
    """Every fifth zone hosts a weekly match; the next zone feels it too."""
    k = F.col("n_nationkey").cast("bigint")
    return nation.filter(k % 5 == 0).select(
        _zone(k).alias("primary_zone"),
        _zone((k + 1) % ZONE_COUNT).alias("secondary_zone"),
        (k % 7).cast("int").alias("day_of_week"),
        (F.lit(1320) + k * 4).cast("int").alias("start_minute"),
        F.lit(120).alias("duration_minutes"),
    )


def adjacency(nation):
    k = F.col("n_nationkey").cast("bigint")
    edges = nation.select(
        F.col("n_name").alias("district"), F.explode(F.array((k + 1) % ZONE_COUNT, (k + 5) % ZONE_COUNT)).alias("other")
    )
    names = nation.select(k.alias("other"), F.col("n_name").alias("adjacent_district"))
    return edges.join(names, "other").select("district", "adjacent_district")


# Promotions (name, weekdays with Monday 0, start hour, end hour, categories).
PROMOS = [
    ("Taco Tuesday 2x1", [1], 0, 24, ["mexican"]),
    ("Weekend Burger Deal", [5], 0, 24, ["burger"]),
    ("Weekend Evening", [5, 6], 18, 23, ["burger", "pizza"]),
]

# Holiday calendar.
HOLIDAYS = [
    (1, 1),
    (1, 6),
    (4, 18),
    (5, 1),
    (8, 15),
    (10, 12),
    (12, 6),
    (12, 25),
]
