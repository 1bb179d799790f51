"""Order KPIs, trends and lists computed from the order feed."""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from ordertide.constants import BUCKET_MINUTES, CANCEL_TYPES, ON_TIME_TARGET_PCT, SLA_MINUTES
from ordertide.functions.columns import (
    any_of,
    count_orders,
    day_of,
    event_is,
    minutes_between,
    or_zero,
    positive,
    time_bucket,
)
from ordertide.functions.quantiles import exact_quantiles
from ordertide.operators.pairs import created_delivered, stage_gap, weighted_mean


def _one_row(*frames):
    """Columns of several one-row frames in one row."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return merged.agg(*[F.max(name).alias(name) for name in merged.columns])


def _snapshot(orders):
    """Events up to the latest created order, and that time.

    Without a created order every event counts and the latest event sets the time.
    """
    latest = orders.agg(
        F.struct(
            F.max(F.when(event_is("order_created"), F.col("event_time"))).alias("created"),
            F.max("event_time").alias("any"),
        ).alias("latest")
    ).scalar()
    created, anything = latest.getField("created"), latest.getField("any")
    events = orders.filter(created.isNull() | (F.col("event_time") <= created))
    return events, F.coalesce(created, anything)


def order_kpis(orders, cancel_types=CANCEL_TYPES, sla=SLA_MINUTES):
    """One row of order KPIs at the time of the latest created order."""
    events, now = _snapshot(orders)
    today = day_of("event_time") == day_of(now)
    created, delivered = event_is("order_created"), event_is("order_delivered")
    cancelled = event_is(*cancel_types)
    prep = F.when(delivered, positive("actual_prep_time"))
    travel = F.when(delivered, positive("actual_delivery_time"))

    # One pass per order gives every distinct count, however often events repeat.
    per_order = events.groupBy("order_id").agg(
        any_of(created).alias("created"),
        any_of(delivered).alias("delivered"),
        any_of(cancelled).alias("cancelled"),
        any_of(created & today).alias("created_today"),
        any_of(delivered & today).alias("delivered_today"),
        F.sum(prep).alias("prep_sum"),
        F.count(prep).alias("prep_n"),
        F.sum(travel).alias("travel_sum"),
        F.count(travel).alias("travel_n"),
    )
    named = F.col("order_id").isNotNull()
    terminal = (F.col("delivered") == 1) | (F.col("cancelled") == 1)

    def total(condition):
        return or_zero(F.sum(F.when(condition, 1).otherwise(0)))

    counts = per_order.agg(
        total(F.col("created") == 1).alias("total_created"),
        total((F.col("delivered") == 1) & named).alias("total_delivered"),
        total((F.col("created_today") == 1) & named).alias("created_today"),
        total((F.col("delivered_today") == 1) & named).alias("delivered_today"),
        total(F.col("cancelled") == 1).alias("total_cancelled"),
        total((F.col("created") == 1) & ~terminal).alias("orders_in_flight"),
        F.try_divide(F.sum("prep_sum"), F.sum("prep_n")).alias("avg_prep_time_min"),
        F.try_divide(F.sum("travel_sum"), F.sum("travel_n")).alias("avg_travel_time_min"),
    )
    counts = counts.withColumn(
        "cancellation_rate_pct",
        F.coalesce(F.try_divide(F.col("total_cancelled"), F.col("total_created")) * 100, F.lit(0.0)),
    )

    full = created_delivered(events)
    on_time = F.sum(F.when(F.col("full_delivery_min") <= F.lit(sla), F.col("pairs")).otherwise(0))
    means = full.agg(
        weighted_mean("full_delivery_min").alias("avg_full_delivery_min"),
        (F.try_divide(on_time, F.sum("pairs")) * 100).alias("on_time_rate_pct"),
    )

    timed = events.filter(delivered).select(
        F.explode(
            F.array(
                F.struct(F.lit("prep").alias("metric"), positive("actual_prep_time").alias("minutes")),
                F.struct(F.lit("travel").alias("metric"), positive("actual_delivery_time").alias("minutes")),
            )
        ).alias("m")
    )
    samples = timed.select("m.metric", "m.minutes", F.lit(1).cast("bigint").alias("pairs")).unionByName(
        full.select(F.lit("full").alias("metric"), F.col("full_delivery_min").alias("minutes"), "pairs")
    )
    p95 = exact_quantiles(samples, ["metric"], "minutes", {"p95": 0.95}, weight="pairs")

    def of(metric):
        return F.max(F.when(F.col("metric") == metric, F.col("p95")))

    tails = p95.agg(
        of("prep").alias("p95_prep_time_min"),
        of("travel").alias("p95_travel_time_min"),
        of("full").alias("p95_delivery_min"),
    )
    return _one_row(counts, means, tails).select(
        "total_created",
        "total_delivered",
        "created_today",
        "delivered_today",
        "total_cancelled",
        "cancellation_rate_pct",
        "orders_in_flight",
        "avg_prep_time_min",
        "p95_prep_time_min",
        "avg_travel_time_min",
        "p95_travel_time_min",
        "avg_full_delivery_min",
        "p95_delivery_min",
        "on_time_rate_pct",
    )


def order_outcomes(orders, cancel_types=CANCEL_TYPES):
    """Delivered, cancelled and in-flight orders with their share of the sum."""
    kpis = order_counts(orders, cancel_types)
    total = F.col("total_delivered") + F.col("total_cancelled") + F.col("orders_in_flight")
    outcomes = F.array(
        *[
            F.struct(F.lit(label).alias("outcome"), F.col(name).alias("orders"))
            for label, name in [
                ("Delivered", "total_delivered"),
                ("Cancelled", "total_cancelled"),
                ("In-Flight", "orders_in_flight"),
            ]
        ]
    )
    rows = kpis.select(total.alias("total"), F.explode(outcomes).alias("o")).filter(F.col("total") > 0)
    return rows.select("o.outcome", "o.orders", (F.col("o.orders") / F.col("total")).alias("share"))


def order_counts(orders, cancel_types=CANCEL_TYPES):
    """The distinct-order counts of the KPI row alone."""
    events, _ = _snapshot(orders)
    flags = events.groupBy("order_id").agg(
        any_of(event_is("order_created")).alias("created"),
        any_of(event_is("order_delivered")).alias("delivered"),
        any_of(event_is(*cancel_types)).alias("cancelled"),
    )
    named = F.col("order_id").isNotNull()
    open_ = (F.col("created") == 1) & (F.col("delivered") == 0) & (F.col("cancelled") == 0)
    return flags.agg(
        or_zero(F.sum(F.when(named, F.col("delivered")))).alias("total_delivered"),
        or_zero(F.sum("cancelled")).alias("total_cancelled"),
        or_zero(F.sum(open_.cast("int"))).alias("orders_in_flight"),
    )


def sla_gauge(orders, target=ON_TIME_TARGET_PCT, sla=SLA_MINUTES):
    """On-time rate against the target, with a red, amber or green band."""
    events, _ = _snapshot(orders)
    full = created_delivered(events)
    hits = F.sum(F.when(F.col("full_delivery_min") <= F.lit(sla), F.col("pairs")).otherwise(0))
    value = full.agg(or_zero(F.try_divide(hits, F.sum("pairs")) * 100).cast("double").alias("value"))
    band = (
        F.when(F.col("value") < F.lit(target * 0.7), "red")
        .when(F.col("value") < F.lit(target), "amber")
        .otherwise("green")
    )
    return value.select(
        "value",
        F.lit(target).alias("target"),
        (F.col("value") - F.lit(target)).alias("delta"),
        band.alias("band"),
    )


def _spine(series, minutes):
    """Every bucket between the first and the last one, in stretches of a day's worth of them.

    The stretches (``day``, numbered from the first bucket) are dealt out before their buckets are made.
    """
    step = minutes * 60_000_000
    per_day = max(1, 1440 // minutes)
    us = F.unix_micros("bucket")
    ends = series.agg(F.min(us).alias("first"), F.max(us).alias("last"))
    days = ends.select("first", "last", F.explode(F.expr(f"sequence(0L, (last - first) div {step * per_day}L)")).alias("day"))
    start = F.col("first") + F.col("day") * (step * per_day)
    end = F.least(F.col("last"), start + step * (per_day - 1))
    bucket = F.explode(F.sequence(start, end, F.lit(step).cast("bigint"))).alias("us")
    return days.repartition("day").select("day", bucket).select("day", F.timestamp_micros("us").alias("bucket"))


def orders_on_spine(orders, minutes=BUCKET_MINUTES, since=None, until=None):
    """Created and delivered orders on every bucket from the first to the last creation.

    ``since`` and ``until`` (before it) bound the times that count, so that one stray
    time of a feed does not stretch the buckets over decades.
    """
    bucket = time_bucket("event_time", minutes).alias("bucket")
    if since is not None:
        orders = orders.filter(F.col("event_time") >= F.lit(since))
    if until is not None:
        orders = orders.filter(F.col("event_time") < F.lit(until))
    series = (
        orders.filter(event_is("order_created", "order_delivered") & F.col("event_time").isNotNull())
        .groupBy(bucket)
        .agg(
            count_orders("order_created").alias("orders_created"),
            count_orders("order_delivered").alias("orders_delivered"),
            any_of(event_is("order_created")).alias("has_created"),
        )
    )
    spine = _spine(series.filter(F.col("has_created") == 1), minutes)
    return spine.join(series, "bucket", "left").select(
        "day",
        "bucket",
        or_zero("orders_created").alias("orders_created"),
        or_zero("orders_delivered").alias("orders_delivered"),
    )


def orders_over_time(orders, minutes=BUCKET_MINUTES, since=None, until=None):
    """Created, delivered and active orders per bucket, within bounds as in ``orders_on_spine``.

    Active is the running sum of created minus delivered, shown as zero when
    negative. The running sum is taken within each day, on top of the sum of the
    days before, so that no task sees more than one day or one row per day.
    """
    series = orders_on_spine(orders, minutes, since, until).withColumn(
        "change", F.col("orders_created") - F.col("orders_delivered")
    )
    before = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        series.groupBy("day")
        .agg(F.sum("change").alias("day_change"))
        .select("day", or_zero(F.sum("day_change").over(before)).alias("carried"))
    )
    in_day = Window.partitionBy("day").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    active = F.col("carried") + F.sum("change").over(in_day)
    return series.join(carried, "day").select(
        "bucket", "orders_created", "orders_delivered", F.greatest(active, F.lit(0)).alias("active_orders")
    )


def on_time_trend(orders, sla=SLA_MINUTES, minutes=BUCKET_MINUTES):
    """Share of deliveries within the service level per delivery bucket."""
    hits = F.sum(F.when(F.col("full_delivery_min") <= F.lit(sla), F.col("pairs")).otherwise(0))
    return (
        created_delivered(orders)
        .groupBy(time_bucket("delivered_at", minutes).alias("bucket"))
        .agg((hits / F.sum("pairs") * 100).alias("on_time_rate_pct"))
    )


def delivery_percentiles(orders, minutes=BUCKET_MINUTES, accuracy=None):
    """Median and 95th percentile of the full delivery time per delivery bucket.

    Exact unless ``accuracy`` asks for values rounded to that many steps per minute, which one
    weighted aggregation finds without ranking.
    """
    full = created_delivered(orders).withColumn("bucket", time_bucket("delivered_at", minutes))
    if accuracy:
        value = F.round(F.col("full_delivery_min") * accuracy) / accuracy
        tails = F.percentile(value, [0.5, 0.95], F.col("pairs"))
        return full.groupBy("bucket").agg(tails.alias("p")).select(
            "bucket", F.col("p")[0].alias("p50"), F.col("p")[1].alias("p95")
        )
    probs = {"p50": 0.5, "p95": 0.95}
    return exact_quantiles(full, ["bucket"], "full_delivery_min", probs, weight="pairs").drop("n")


def cancellation_mix(orders, cancel_types=CANCEL_TYPES, minutes=BUCKET_MINUTES):
    """Cancellations per bucket, one column per type."""
    return (
        orders.filter(event_is(*cancel_types) & F.col("event_time").isNotNull())
        .groupBy(time_bucket("event_time", minutes).alias("bucket"))
        .agg(*[count_orders(kind).alias(kind) for kind in cancel_types])
    )


def zone_metrics(orders, cancel_types=CANCEL_TYPES):
    """Created, delivered and cancelled orders per user zone with the cancel rate."""
    counted = event_is("order_created", "order_delivered", *cancel_types)
    counts = (
        orders.filter(counted & F.col("user_zone_id").isNotNull())
        .groupBy(F.col("user_zone_id").alias("zone_id"))
        .agg(
            count_orders("order_created").alias("total_orders"),
            count_orders("order_delivered").alias("delivered_orders"),
            count_orders(*cancel_types).alias("cancelled_orders"),
        )
    )
    return counts.withColumn("cancellation_rate", _cancel_rate())


def _cancel_rate():
    return F.col("cancelled_orders") / F.greatest(F.col("total_orders"), F.lit(1)) * 100


def zone_counts_outer(orders, cancel_types=CANCEL_TYPES):
    """The zone counts as a full outer join of three small per-zone tables."""

    def per_zone(name, *types):
        return (
            orders.filter(event_is(*types) & F.col("user_zone_id").isNotNull())
            .groupBy(F.col("user_zone_id").alias("zone_id"))
            .agg(F.count("order_id").alias(name))
        )

    joined = (
        per_zone("total_orders", "order_created")
        .join(per_zone("delivered_orders", "order_delivered"), "zone_id", "full")
        .join(per_zone("cancelled_orders", *cancel_types), "zone_id", "full")
    )
    filled = joined.fillna(0, ["total_orders", "delivered_orders", "cancelled_orders"])
    return filled.withColumn("cancellation_rate", _cancel_rate())


def full_delivery_by_zone(orders):
    """Mean created-to-delivered minutes per user zone, slowest first."""
    return (
        created_delivered(orders)
        .filter(F.col("user_zone_id").isNotNull())
        .groupBy(F.col("user_zone_id").alias("zone_id"))
        .agg(weighted_mean("full_delivery_min").alias("avg_full_delivery_min"))
        .orderBy(F.desc("avg_full_delivery_min"), "zone_id")
    )


def stage_times(orders):
    """Mean minutes of the four delivery stages and their total; absent stages left out."""

    def gap(number, label, first, second):
        mean = stage_gap(orders, first, second).agg(weighted_mean("gap_min").alias("avg_min"))
        return mean.select(F.lit(number).alias("stage_no"), F.lit(label).alias("stage"), "avg_min")

    delivered = orders.filter(event_is("order_delivered")).agg(
        F.avg(positive("actual_prep_time")).alias("prep"), F.avg(positive("actual_delivery_time")).alias("travel")
    )
    durations = delivered.select(
        F.explode(
            F.array(
                F.struct(F.lit(2).alias("stage_no"), F.lit("Prep").alias("stage"), F.col("prep").alias("avg_min")),
                F.struct(F.lit(4).alias("stage_no"), F.lit("Travel").alias("stage"), F.col("travel").alias("avg_min")),
            )
        ).alias("s")
    ).select("s.*")
    stages = (
        gap(1, "Wait – Confirm", "order_created", "order_confirmed")
        .unionByName(gap(3, "Wait – Courier", "order_ready_for_pickup", "order_picked_up"))
        .unionByName(durations)
        .filter(F.col("avg_min").isNotNull())
    )
    # At most four rows reach this point, so the total is a roll-up of them.
    rolled = stages.rollup("stage_no", "stage").agg(F.sum("avg_min").alias("avg_min"), F.grouping_id().alias("level"))
    return rolled.filter(F.col("level").isin(0, 3) & F.col("avg_min").isNotNull()).select(
        F.coalesce("stage_no", F.lit(5)).alias("stage_no"), F.coalesce("stage", F.lit("Total")).alias("stage"), "avg_min"
    )


def in_flight_orders(orders, cancel_types=CANCEL_TYPES):
    """Created orders without a terminal event."""
    terminal = orders.filter(event_is("order_delivered", *cancel_types)).select("order_id")
    created = orders.filter(event_is("order_created")).select(
        "order_id", F.col("event_time").alias("created_at"), F.col("user_zone_id").alias("zone")
    )
    return created.join(terminal, "order_id", "left_anti")


def at_risk_orders(orders, cancel_types=CANCEL_TYPES):
    """Orders in flight for at least the median time, longest first."""
    now = orders.agg(F.max("event_time").alias("now")).scalar()
    waiting = in_flight_orders(orders, cancel_types).withColumn(
        "elapsed_min", minutes_between(F.col("created_at"), now)
    )
    median = exact_quantiles(waiting, [], "elapsed_min", {"median": 0.5}).select("median").scalar()
    return (
        waiting.filter(F.col("elapsed_min") >= median)
        .select("order_id", "zone", "elapsed_min", F.lit("In-Flight").alias("status"))
        .orderBy(F.desc("elapsed_min"), "order_id")
    )


def open_order_ids(orders, cancel_types=CANCEL_TYPES):
    """Distinct ids of created orders minus ids with a terminal event, in one pass."""
    flags = orders.groupBy("order_id").agg(
        any_of(event_is("order_created")).alias("created"),
        any_of(event_is("order_delivered", *cancel_types)).alias("ended"),
    )
    return flags.filter((F.col("created") == 1) & (F.col("ended") == 0)).select("order_id")


def latest_day_flags(orders):
    """Whether each event lies on the day of the latest created order."""
    _, now = _snapshot(orders)
    return orders.select(
        "event_id",
        "order_id",
        "event_type",
        "event_time",
        (day_of("event_time") == day_of(now)).alias("on_latest_day"),
    )
