"""Mergeable sketches as stored roll-ups: distinct couriers and delivery-time percentiles.

A sketch table has one row per bucket, or several where batches brought parts of it. Roll-ups to
wider buckets merge sketches instead of reading events again, and a stream can keep the table up. Distinct
counts are exact up to a few hundred ids and then off by about 1.04 / sqrt(2**LOG2_K) (one standard
deviation); a percentile's rank is exact up to ``QUANTILE_K`` values and then off by about 1.7 / QUANTILE_K.
"""

from pyspark.sql import functions as F

from ordertide.constants import BUCKET_MINUTES
from ordertide.functions.columns import event_is, time_bucket
from ordertide.operators.pairs import created_delivered
from ordertide.operators.windows import watermarked

LOG2_K, QUANTILE_K = 12, 200


def courier_sketches(couriers, minutes=BUCKET_MINUTES, delay="15 minutes"):
    """Sketches of the active and of the online couriers per bucket, from a batch or a stream."""
    rows = couriers.filter(event_is("courier_assigned_order", "courier_online") & F.col("event_time").isNotNull())

    def ids(kind):
        return F.hll_sketch_agg(F.when(event_is(kind), F.col("courier_id")), F.lit(LOG2_K))

    windows = watermarked(rows, delay).groupBy(F.window("event_time", f"{minutes} minutes")).agg(
        ids("courier_assigned_order").alias("active"), ids("courier_online").alias("online")
    )
    return windows.select(F.col("window.start").alias("bucket"), "active", "online")


def merged_couriers(sketches, minutes):
    """The sketches of wider buckets, or of parts of one bucket."""
    bucket = time_bucket("bucket", minutes).alias("bucket")
    return sketches.groupBy(bucket).agg(*[F.hll_union_agg(c).alias(c) for c in ("active", "online")])


def courier_counts(sketches):
    """Distinct active and online couriers of each bucket."""
    return sketches.select(
        "bucket",
        F.hll_sketch_estimate("active").alias("active_couriers"),
        F.hll_sketch_estimate("online").alias("online_couriers"),
    )


def delivery_sketches(orders, minutes=BUCKET_MINUTES):
    """A sketch of the created-to-delivered minutes per delivery bucket; each pairing of copies counts."""
    full = created_delivered(orders).withColumn("bucket", time_bucket("delivered_at", minutes))
    each = full.select("bucket", "full_delivery_min", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("pairs"))))
    return each.groupBy("bucket").agg(F.kll_sketch_agg_double("full_delivery_min", F.lit(QUANTILE_K)).alias("times"))


def merged_deliveries(sketches, minutes):
    bucket = time_bucket("bucket", minutes).alias("bucket")
    return sketches.groupBy(bucket).agg(F.kll_merge_agg_double("times", F.lit(QUANTILE_K)).alias("times"))


def delivery_percentiles(sketches):
    """Number of deliveries, median and 95th percentile (values that occur) of each bucket."""

    def at(rank):
        return F.kll_sketch_get_quantile_double("times", F.lit(rank))

    return sketches.select("bucket", F.kll_sketch_get_n_double("times").alias("n"), at(0.5).alias("p50"), at(0.95).alias("p95"))
