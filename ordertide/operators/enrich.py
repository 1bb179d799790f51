"""Enrichment from route, restaurant, promotion, match and calendar tables.

Time ranges of the reference tables are spelled out into their hours or minutes,
so every lookup is an equality join. A spelled-out table is broadcast once its size
has been checked, which leaves the events where they are; a larger one is shuffled.
"""

import datetime

from pyspark.sql import functions as F

from ordertide.constants import (
    BASE_ORDERS_PER_MINUTE,
    DEFAULT_ROUTE,
    DINNER_MULTIPLIER,
    DINNER_PEAK_MINUTE,
    HOLIDAY_MULTIPLIER,
    LUNCH_MULTIPLIER,
    LUNCH_PEAK_MINUTE,
    PEAK_SIGMA_MINUTES,
    PROMO_WEIGHT,
    SECONDARY_MATCH_FACTOR,
    SENSITIVITY_WEIGHT,
    SPAWN_CAP,
    SPAWN_SCALE,
    WEEKEND_MULTIPLIER,
)
from ordertide.functions.columns import (
    event_is,
    hour_of_day,
    is_holiday,
    is_weekend,
    meal_period,
    minute_of_day,
    weekday_of,
)


def route_lookup(events, matrix, origin, destination):
    """Route columns of each event's zone pair; unknown pairs get the default route."""
    routes = matrix.select(
        F.col("zone_from").alias(origin), F.col("zone_to").alias(destination), *DEFAULT_ROUTE
    )
    joined = events.join(routes, [origin, destination], "left")
    return joined.withColumns(
        {name: F.coalesce(F.col(name), F.lit(value)) for name, value in DEFAULT_ROUTE.items()}
    )


def expected_eta(mean_minutes, delay_probability):
    """Travel time with the expected delay: 20 to 50 % with the given probability."""
    return mean_minutes * (F.lit(1.0) + delay_probability * F.lit(0.35))


def user_cancel_risk(wait, eta, sensitivity):
    return F.least(F.lit(0.3), F.lit(0.002) * wait * sensitivity + F.lit(0.0015) * eta * sensitivity)


def courier_cancel_risk(hops, travel, factor):
    return F.least(
        F.lit(0.25), F.lit(0.001) + F.lit(0.02) * hops * factor + F.lit(0.008) * travel * factor
    )


def restaurant_cancel_risk(age):
    return F.least(F.lit(0.05), F.lit(0.005) + F.lit(0.001) * age)


def _bump(minute, peak):
    distance = (minute - F.lit(peak)) / F.lit(PEAK_SIGMA_MINUTES)
    return F.exp(F.lit(-0.5) * distance * distance)


def demand_factor(ts, holidays, base=BASE_ORDERS_PER_MINUTE):
    """Expected demand multiplier of a time: meal peaks, weekend, holiday, base rate."""
    minute = minute_of_day(ts)
    peak = (
        F.lit(1.0)
        + F.lit(LUNCH_MULTIPLIER - 1.0) * _bump(minute, LUNCH_PEAK_MINUTE)
        + F.lit(DINNER_MULTIPLIER - 1.0) * _bump(minute, DINNER_PEAK_MINUTE)
    )
    weekend = F.when(is_weekend(ts), F.lit(WEEKEND_MULTIPLIER)).otherwise(1.0)
    holiday = F.when(is_holiday(ts, holidays), F.lit(HOLIDAY_MULTIPLIER)).otherwise(1.0)
    return peak * weekend * holiday * F.lit(base / 2.0)


def step_demand_factor(ts, holidays, base=BASE_ORDERS_PER_MINUTE):
    """The same with a flat multiplier inside each meal period."""
    period = meal_period(ts)
    peak = F.when(period == "lunch", LUNCH_MULTIPLIER).when(period == "dinner", DINNER_MULTIPLIER).otherwise(1.0)
    weekend = F.when(is_weekend(ts), F.lit(WEEKEND_MULTIPLIER)).otherwise(1.0)
    holiday = F.when(is_holiday(ts, holidays), F.lit(HOLIDAY_MULTIPLIER)).otherwise(1.0)
    return peak * weekend * holiday * F.lit(base / 2.0)


def zone_demand_share(zones, day, holidays):
    """Chance of an order per zone and hour of a day, capped."""
    hours = zones.select("zone_id", "spawn_probability", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))
    midnight = (datetime.date(day.year, day.month, day.day) - datetime.date(1970, 1, 1)).days * 86_400_000_000
    at = F.timestamp_micros(F.lit(midnight) + F.col("hour").cast("bigint") * F.lit(3_600_000_000))
    factor = demand_factor(at, holidays)
    return hours.select(
        "zone_id",
        "hour",
        F.least(F.lit(SPAWN_CAP), F.col("spawn_probability") * factor * F.lit(SPAWN_SCALE)).alias("spawn_share"),
    )


def backfill_category(orders):
    """The category of an order's creation on all of its events."""
    known = (
        orders.filter(event_is("order_created") & F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(F.max("restaurant_category").alias("_category"))
    )
    own = F.nullif(F.col("restaurant_category"), F.lit(""))
    return (
        orders.join(known, "order_id", "left")
        .withColumn("restaurant_category", F.coalesce(own, F.col("_category")))
        .select(*orders.columns)
    )


def match_multipliers(effects, zones):
    """Demand multiplier per zone and category: primary in full, secondary reduced, at least 1."""
    sides = effects.select(
        "category",
        F.explode(
            F.array(
                F.struct(F.col("primary_district").alias("district"), F.col("demand_multiplier").alias("m")),
                F.struct(
                    F.col("secondary_district").alias("district"),
                    (F.col("demand_multiplier") * F.lit(SECONDARY_MATCH_FACTOR)).alias("m"),
                ),
            )
        ).alias("side"),
    )
    return (
        sides.select("category", "side.district", "side.m")
        .join(zones.select("zone_id", "district"), "district")
        .groupBy("zone_id", "category")
        .agg(F.greatest(F.lit(1.0), F.max("m")).alias("multiplier"))
    )


def match_multiplier(orders, multipliers):
    """Created orders with the match multiplier of their zone and category, 1 if none."""
    keyed = multipliers.select(
        F.col("zone_id").alias("user_zone_id"), F.col("category").alias("restaurant_category"), "multiplier"
    )
    created = orders.filter(event_is("order_created"))
    return created.join(keyed, ["user_zone_id", "restaurant_category"], "left").select(
        "event_id",
        "order_id",
        "user_zone_id",
        "restaurant_category",
        F.coalesce("multiplier", F.lit(1.0)).alias("multiplier"),
    )


def promo_hours(spark, promos):
    """First active promotion per weekday, hour and category.

    ``promos`` holds (name, weekdays, start hour, end hour, categories) in order of
    precedence; no weekdays means every day.
    """
    rows = [
        (number, name, list(days) or list(range(7)), start, end, list(categories))
        for number, (name, days, start, end, categories) in enumerate(promos)
        if end > start
    ]
    table = spark.createDataFrame(
        rows, "promo_no int, promo string, days array<int>, start int, end int, categories array<string>"
    )
    spelled = (
        table.select("promo_no", "promo", "start", "end", "categories", F.explode("days").alias("weekday"))
        .select("*", F.explode(F.sequence("start", F.col("end") - 1)).alias("hour"))
        .select("*", F.explode("categories").alias("category"))
    )
    return spelled.groupBy("weekday", "hour", "category").agg(F.min_by("promo", "promo_no").alias("promo"))


def promo_match(orders, hours):
    """Created orders with the promotion active at their time for their category."""
    created = orders.filter(event_is("order_created")).select(
        "event_id",
        "order_id",
        "event_time",
        F.col("restaurant_category").alias("category"),
        weekday_of("event_time").alias("weekday"),
        hour_of_day("event_time").alias("hour"),
    )
    return created.join(hours, ["weekday", "hour", "category"], "left").select(
        "event_id", "order_id", "event_time", "category", "promo"
    )


def match_minutes(schedule):
    """Every zone, weekday and minute of a match with the stronger role of the zone.

    A match that runs past midnight continues on the next weekday.
    """
    sides = F.array(
        F.struct(F.col("primary_zone").alias("zone_id"), F.lit("primary").alias("role")),
        F.struct(F.col("secondary_zone").alias("zone_id"), F.lit("secondary").alias("role")),
    )
    last = F.col("start_minute") + F.col("duration_minutes") - 1
    roles = schedule.select(
        "day_of_week", sides.alias("sides"), F.explode(F.sequence(F.col("start_minute"), last)).alias("m")
    ).select("day_of_week", "m", F.explode("sides").alias("side"))
    return roles.groupBy(
        F.col("side.zone_id").alias("zone_id"),
        ((F.col("day_of_week") + F.floor(F.col("m") / 1440)) % 7).cast("int").alias("weekday"),
        (F.col("m") % 1440).alias("minute"),
    ).agg(F.min("side.role").alias("match_role"))


def match_day_tag(orders, minutes, zone="user_zone_id"):
    """Whether each order event falls inside a match of its zone, and in which role."""
    keyed = orders.select(
        "event_id",
        "order_id",
        "event_type",
        "event_time",
        F.col(zone).alias("zone_id"),
        weekday_of("event_time").alias("weekday"),
        minute_of_day(F.col("event_time")).alias("minute"),
    )
    tagged = keyed.join(minutes, ["zone_id", "weekday", "minute"], "left")
    return tagged.select(
        "event_id",
        "order_id",
        "event_type",
        "event_time",
        "zone_id",
        F.coalesce("match_role", F.lit("none")).alias("match_role"),
    )


def restaurant_weights(restaurants, multipliers, promo_categories, match_day=True):
    """Weight of each restaurant in its zone and its share of the zone's weight."""
    keyed = multipliers.select("zone_id", "category", F.col("multiplier").alias("_match"))
    promo = F.when(F.col("category").isin(*promo_categories), F.lit(PROMO_WEIGHT)).otherwise(1.0)
    weight = promo
    if match_day:
        sensitivity = F.lower("matchday_sensitivity")
        by_sensitivity = F.lit(1.0)
        for word, factor in SENSITIVITY_WEIGHT.items():
            by_sensitivity = F.when(sensitivity == word, F.lit(factor)).otherwise(by_sensitivity)
        weight = F.coalesce("_match", F.lit(1.0)) * promo * by_sensitivity
    weighted = restaurants.join(keyed, ["zone_id", "category"], "left").select(
        "restaurant_id", "zone_id", "category", F.greatest(F.lit(0.01), weight).alias("weight")
    )
    totals = weighted.groupBy("zone_id").agg(F.sum("weight").alias("_total"))
    return weighted.join(totals, "zone_id").select(
        "restaurant_id", "zone_id", "category", "weight", (F.col("weight") / F.col("_total")).alias("zone_share")
    )


def promotion_hours(promotions):
    """Multiplier of each category and hour from promotions with a time of validity.

    ``promotions``: category, valid_from, valid_to (excluded), multiplier. A promotion holds in every
    hour whose start it covers; where several do, the one that began last counts, of those the greater
    multiplier. Spelled out into hours, the interval is an equality join. Rows with nulls or without
    duration are left out.
    """
    hour = 3_600_000_000
    first = F.ceil(F.unix_micros("valid_from") / hour).cast("bigint")
    last = F.ceil(F.unix_micros("valid_to") / hour).cast("bigint") - 1
    known = promotions.dropna(subset=["category", "valid_from", "valid_to", "multiplier"]).filter(last >= first)
    spelled = known.select("category", "valid_from", "multiplier", F.explode(F.sequence(first, last)).alias("hour"))
    best = spelled.groupBy("category", "hour").agg(F.max(F.struct("valid_from", "multiplier")).alias("best"))
    return best.select("category", "hour", F.col("best.multiplier").alias("promo"))


def restaurant_weights_at(restaurants, multipliers, hours, at, match_day=True):
    """``restaurant_weights`` at each time of ``at`` (column ``at``), with the promotions that hold then.

    ``hours`` comes from ``promotion_hours``; without a promotion the factor is 1. Shares of a zone
    add up to 1 at each time. Times of one hour have equal weights, so they are computed once.
    """
    hour = F.floor(F.unix_micros("at") / 3_600_000_000).cast("bigint").alias("hour")
    wanted = at.filter(F.col("at").isNotNull()).select("at", hour)
    named = wanted.select("hour").distinct().agg(F.sort_array(F.collect_set("hour")).alias("hours")).scalar()
    rows = restaurants.select("restaurant_id", "zone_id", "category", "matchday_sensitivity", F.explode(named).alias("hour"))
    rows = rows.join(hours, ["category", "hour"], "left")
    rows = rows.join(multipliers.select("zone_id", "category", "multiplier"), ["zone_id", "category"], "left")
    weight = F.coalesce("promo", F.lit(1.0))
    if match_day:
        factor = F.lit(1.0)
        for word, value in SENSITIVITY_WEIGHT.items():
            factor = F.when(F.lower("matchday_sensitivity") == word, F.lit(value)).otherwise(factor)
        weight = F.coalesce("multiplier", F.lit(1.0)) * weight * factor
    rows = rows.select("restaurant_id", "zone_id", "category", "hour", F.greatest(F.lit(0.01), weight).alias("weight"))
    totals = rows.groupBy("zone_id", "hour").agg(F.sum("weight").alias("total"))
    rows = rows.join(totals, ["zone_id", "hour"]).join(wanted, "hour")
    return rows.select("at", "restaurant_id", "zone_id", "category", "weight", (F.col("weight") / F.col("total")).alias("zone_share"))


def prep_pressure(orders, restaurants):
    """Expected actual and estimated preparation time of created orders, and their gap.

    An order of an unknown restaurant keeps its row, with the shortest time and no pressure.
    """
    prep = restaurants.select("restaurant_id", "base_prep_time_mean_min", "latency_pressure_factor")
    pressure = F.coalesce("latency_pressure_factor", F.lit(1.0))
    expected = F.greatest(F.lit(5.0), F.col("base_prep_time_mean_min") * pressure)
    estimate = F.greatest(F.lit(5.0), F.col("base_prep_time_mean_min"))
    return orders.filter(event_is("order_created")).join(prep, "restaurant_id", "left").select(
        "event_id",
        "order_id",
        "restaurant_id",
        expected.alias("expected_prep_min"),
        estimate.alias("estimated_prep_min"),
        (expected - estimate).alias("prep_gap_min"),
    )


def calendar_tags(events, holidays):
    """Weekend, holiday, meal period and hour of each event."""
    ts = F.col("event_time")
    return events.select(
        "event_id",
        "event_time",
        is_weekend(ts).alias("is_weekend"),
        is_holiday(ts, holidays).alias("is_holiday"),
        meal_period(ts).alias("meal_period"),
        hour_of_day(ts).alias("hour"),
    )


def restaurants_by(restaurants, zones, key):
    """Candidate restaurants per zone or category with the size of their group."""
    known = restaurants.join(zones.select("zone_id"), "zone_id", "left_semi")
    sizes = known.groupBy(key).agg(F.count("*").alias("candidates"))
    return known.join(sizes, key).select(key, "restaurant_id", "candidates")
