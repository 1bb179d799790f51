"""KPIs from a table of order facts that is kept up by merging.

A fact is a distinct event of an order with what the KPIs need of it, and the number of its copies.
Facts of different days or batches add up (``merge_facts``), so a KPI row over all history
needs the stored facts and the facts of what is new, not the events again. Stored by
``save_facts`` they are bucketed by order: per-order aggregates and joins of an order's stages
move no rows.

The functions return what those of the same name in ``orders`` return for the events.
"""

from pyspark.sql import functions as F

from ordertide.constants import CANCEL_TYPES, SLA_MINUTES
from ordertide.functions.columns import any_of, day_of, event_is, minutes_between, or_zero, positive
from ordertide.functions.refined import refined_quantiles
from ordertide.session import run_folder

KEYS = ["order_id", "event_type", "event_time", "user_zone_id", "prep_min", "travel_min"]
_US = 6e7


def order_facts(orders):
    """One row per distinct event with its copies, in one scan and one shuffle."""
    delivered = event_is("order_delivered")
    rows = orders.select(
        *KEYS[:4],
        F.when(delivered, positive("actual_prep_time")).alias("prep_min"),
        F.when(delivered, positive("actual_delivery_time")).alias("travel_min"),
    )
    return rows.groupBy(*KEYS).agg(F.count("*").alias("copies"))


def merge_facts(*parts):
    """Facts of several sets of events as facts of all of them."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged.groupBy(*KEYS).agg(F.sum("copies").alias("copies"))


def save_facts(facts, table, path, buckets):
    """Facts as a table of ``buckets`` files by order under ``path``; returns them read from there."""
    facts = facts.repartition(buckets, "order_id")
    writer = facts.write.bucketBy(buckets, "order_id").sortBy("order_id").option("path", path)
    writer.format("parquet").mode("overwrite").saveAsTable(table)
    return facts.sparkSession.table(table)


def _kept(df, name):
    """A table of counts written to the shared folder, since several rounds read it."""
    path = run_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _snapshot(facts):
    """Facts up to the latest created order, and that time, as in ``orders``."""
    latest = facts.agg(
        F.struct(
            F.max(F.when(event_is("order_created"), F.col("event_time"))).alias("created"),
            F.max("event_time").alias("any"),
        ).alias("latest")
    ).scalar()
    created, anything = latest.getField("created"), latest.getField("any")
    return facts.filter(created.isNull() | (F.col("event_time") <= created)), F.coalesce(created, anything)


def _stage(facts, kind, name, *keep):
    """Distinct times of one stage per order with their copies."""
    rows = facts.filter(event_is(kind) & F.col("order_id").isNotNull() & F.col("event_time").isNotNull())
    return rows.groupBy("order_id", F.col("event_time").alias(name), *keep).agg(F.sum("copies").alias(f"{name}_copies"))


def _pairs(facts, first, second, *keep):
    """Microseconds between two stages of an order, and how often."""
    left, right = _stage(facts, first, "a", *keep), _stage(facts, second, "b")
    gap = F.unix_micros("b") - F.unix_micros("a")
    return left.join(right, "order_id").select(gap.alias("us"), (F.col("a_copies") * F.col("b_copies")).alias("weight"))


def _durations(facts):
    """(metric, us, weight): prep, travel and created-to-delivered times as counts of distinct values."""
    delivered = facts.filter(event_is("order_delivered"))
    named = F.array(
        *[
            F.struct(F.lit(name).alias("metric"), F.round(F.col(f"{name}_min") * _US).cast("bigint").alias("us"))
            for name in ("prep", "travel")
        ]
    )
    timed = delivered.select(F.inline(named), F.col("copies").alias("weight")).filter("us IS NOT NULL")
    full = _pairs(facts, "order_created", "order_delivered", "user_zone_id").filter("us > 0")
    rows = timed.unionByName(full.select(F.lit("full").alias("metric"), "us", "weight"))
    return rows.groupBy("metric", "us").agg(F.sum("weight").alias("weight"))


def order_kpis(facts, cancel_types=CANCEL_TYPES, sla=SLA_MINUTES):
    """One row of order KPIs at the time of the latest created order.

    Durations count in whole microseconds, so that means and percentiles come from one table of counts.
    """
    events, now = _snapshot(facts)
    today = day_of("event_time") == day_of(now)
    created, delivered = event_is("order_created"), event_is("order_delivered")
    per_order = events.groupBy("order_id").agg(
        any_of(created).alias("created"),
        any_of(delivered).alias("delivered"),
        any_of(event_is(*cancel_types)).alias("cancelled"),
        any_of(created & today).alias("created_today"),
        any_of(delivered & today).alias("delivered_today"),
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
    )
    durations = _kept(_durations(events), "durations")
    p95 = refined_quantiles(durations, ["metric"], "us", {"p95": 0.95}, weight="weight").drop("n")
    in_time = F.when(F.col("us") <= F.lit(int(sla * _US)), F.col("weight")).otherwise(0)
    means = durations.groupBy("metric").agg(
        (F.try_divide(F.sum(F.col("us") / _US * F.col("weight")), F.sum("weight"))).alias("mean"),
        (F.try_divide(F.sum(in_time), F.sum("weight")) * 100).alias("on_time"),
    )
    stats = means.join(p95, "metric")

    def of(metric, name):
        return F.max(F.when(F.col("metric") == metric, F.col(name)))

    stats = stats.agg(
        of("prep", "mean").alias("avg_prep_time_min"),
        (of("prep", "p95") / _US).alias("p95_prep_time_min"),
        of("travel", "mean").alias("avg_travel_time_min"),
        (of("travel", "p95") / _US).alias("p95_travel_time_min"),
        of("full", "mean").alias("avg_full_delivery_min"),
        (of("full", "p95") / _US).alias("p95_delivery_min"),
        of("full", "on_time").alias("on_time_rate_pct"),
    )
    rate = F.coalesce(F.try_divide(F.col("total_cancelled"), F.col("total_created")) * 100, F.lit(0.0))
    one = counts.withColumn("one", F.lit(1)).join(stats.withColumn("one", F.lit(1)), "one")
    return one.select(
        "total_created",
        "total_delivered",
        "created_today",
        "delivered_today",
        "total_cancelled",
        rate.alias("cancellation_rate_pct"),
        "orders_in_flight",
        "avg_prep_time_min",
        "p95_prep_time_min",
        "avg_travel_time_min",
        "p95_travel_time_min",
        "avg_full_delivery_min",
        "p95_delivery_min",
        "on_time_rate_pct",
    )


def stage_times(facts):
    """Mean minutes of the four delivery stages and their total; absent stages left out."""
    wait = _pairs(facts, "order_created", "order_confirmed").select(F.lit(1).alias("stage_no"), "us", "weight")
    pickup = _pairs(facts, "order_ready_for_pickup", "order_picked_up").select(F.lit(3).alias("stage_no"), "us", "weight")
    named = F.array(
        *[
            F.struct(F.lit(number).alias("stage_no"), F.round(F.col(name) * _US).cast("bigint").alias("us"))
            for number, name in ((2, "prep_min"), (4, "travel_min"))
        ]
    )
    timed = facts.filter(event_is("order_delivered")).select(F.inline(named), F.col("copies").alias("weight"))
    rows = wait.unionByName(pickup).unionByName(timed).filter("us >= 0")
    means = rows.groupBy("stage_no").agg(F.try_divide(F.sum(F.col("us") / _US * F.col("weight")), F.sum("weight")).alias("avg_min"))
    # At most four rows reach this point, so the total is a roll-up of them.
    rolled = means.rollup("stage_no").agg(F.sum("avg_min").alias("avg_min"))
    labels = F.array(*map(F.lit, ["Wait – Confirm", "Prep", "Wait – Courier", "Travel", "Total"]))
    number = F.coalesce("stage_no", F.lit(5))
    return rolled.filter("avg_min IS NOT NULL").select(
        number.alias("stage_no"), F.element_at(labels, number).alias("stage"), "avg_min"
    )


def at_risk_orders(facts, cancel_types=CANCEL_TYPES):
    """Orders in flight for at least the median time, longest first."""
    now = facts.agg(F.max("event_time").alias("now")).scalar()
    ended = event_is("order_delivered", *cancel_types)
    open_orders = facts.groupBy("order_id").agg(any_of(ended).alias("ended")).filter("ended = 0").select("order_id")
    created = facts.filter(event_is("order_created") & F.col("order_id").isNotNull())
    waiting = created.join(open_orders, "order_id").select(
        "order_id",
        F.col("user_zone_id").alias("zone"),
        "copies",
        (F.unix_micros(now) - F.unix_micros("event_time")).alias("us"),
        minutes_between(F.col("event_time"), now).alias("elapsed_min"),
    )
    times = _kept(waiting.groupBy("us").agg(F.sum("copies").alias("copies")), "waiting-times")
    median = refined_quantiles(times, [], "us", {"median": 0.5}, weight="copies").select("median").scalar()
    late = waiting.filter(F.col("us") >= median).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return late.select("order_id", "zone", "elapsed_min", F.lit("In-Flight").alias("status")).orderBy(
        F.desc("elapsed_min"), "order_id"
    )
