"""Tables that put per-zone results next to the zone reference table."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ordertide.functions.columns import or_zero, zone_label


def zone_labels(zones):
    return zones.select("zone_id", zone_label("zone_id", "district").alias("zone_label"))


def label_events(events, zones, zone="user_zone_id"):
    """Events with the label of their zone; unknown zones keep their id."""
    names = zones.select(F.col("zone_id").alias(zone), F.col("district").alias("_district"))
    return events.join(names, zone, "left").withColumn(
        "zone_label", F.when(F.col(zone).isNotNull(), zone_label(zone, "_district"))
    ).drop("_district")


def zone_map(zones, metrics, delivery):
    """Every zone with its orders, delivery time and a bubble size, zero when unknown."""
    joined = zones.join(metrics, "zone_id", "left").join(delivery, "zone_id", "left")
    orders = or_zero("total_orders")
    return joined.select(
        "zone_id",
        "district",
        F.col("centroid_x"),
        F.col("centroid_y"),
        orders.alias("total_orders"),
        F.coalesce("avg_full_delivery_min", F.lit(0.0)).alias("avg_delivery_min"),
        F.coalesce("cancellation_rate", F.lit(0.0)).alias("cancellation_rate"),
        F.greatest(orders, F.lit(1)).cast("double").alias("size_val"),
    )


def zone_rankings(metrics, delivery, revenue, zones):
    """Zones by number of orders with delivery time, cancel rate and GMV."""
    names = zones.select("zone_id", F.col("district").alias("_district"))
    return (
        metrics.join(delivery, "zone_id", "left")
        .join(revenue.select("zone_id", "estimated_gmv_eur"), "zone_id", "left")
        .join(names, "zone_id", "left")
        .select(
            "zone_id",
            F.coalesce("_district", "zone_id").alias("district"),
            "total_orders",
            "avg_full_delivery_min",
            "cancellation_rate",
            F.coalesce("estimated_gmv_eur", F.lit(0.0)).alias("estimated_gmv_eur"),
        )
        .orderBy(F.desc("total_orders"), "zone_id")
    )


def rank_zones(rankings):
    """Rank of each zone by orders, delivery time and GMV (one row per zone)."""

    def rank(column):
        return F.rank().over(Window.orderBy(F.desc_nulls_last(column)))

    return rankings.select(
        "zone_id",
        rank("total_orders").cast("bigint").alias("orders_rank"),
        rank("avg_full_delivery_min").cast("bigint").alias("delivery_rank"),
        rank("estimated_gmv_eur").cast("bigint").alias("gmv_rank"),
    )


def district_zones(events, zones, zone="user_zone_id"):
    """Zone id to district name and back, per event; the first zone id of a district with several."""
    names = zones.select(F.col("zone_id").alias(zone), "district")
    ids = zones.groupBy("district").agg(F.min("zone_id").alias("zone_of_district"))
    return events.select("event_id", zone).join(names, zone, "left").join(ids, "district", "left")


def zone_set_filter(events, zones, zone="user_zone_id"):
    """Events whose zone is in a set of zones."""
    return events.join(zones.select(F.col("zone_id").alias(zone)), zone, "left_semi")
