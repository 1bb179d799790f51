"""Sketch roll-ups, arrival order on a stream, and promotions by validity."""

import datetime

import numpy as np
from pyspark.sql import functions as F

from ordertide.operators import enrich, quality, sketches
from ordertide.plans.registry import Tables
from ordertide.session import stream_session
from ordertide.sources import readers
from ordertide.streaming.arrival import out_of_order_stream
from ordertide.streaming.sinks import finish, start_parquet

NOON = datetime.datetime(2024, 3, 1, 12)


def at(minutes):
    return NOON + datetime.timedelta(minutes=minutes)


def test_sketches_stay_within_their_error_and_merge(spark):
    ids = F.concat(F.lit("C"), (F.col("id") % 20_000).cast("string"))
    start = F.lit(NOON).cast("timestamp")
    rows = spark.range(60_000).select(
        F.timestamp_micros(F.unix_micros(start) + F.col("id") * 50_000).alias("event_time"),
        ids.alias("courier_id"),
        F.when(F.col("id") % 3 == 0, "courier_online").otherwise("courier_assigned_order").alias("event_type"),
    )
    parts = [sketches.courier_sketches(rows.filter(F.col("courier_id").endswith(d))) for d in ("1", "2")]
    both = sketches.merged_couriers(parts[0].unionByName(parts[1]), 1440)
    direct = sketches.courier_sketches(rows.filter(F.substring("courier_id", -1, 1).isin("1", "2")), 1440)
    got, want = (sketches.courier_counts(s).collect() for s in (both, direct))
    assert sorted(got) == sorted(want)
    error = 4 * 1.04 / 2 ** (sketches.LOG2_K / 2)
    assert all(abs(r.active_couriers - 4000) <= 4000 * error for r in got)


def test_percentile_sketches_count_copies_and_keep_their_rank_error(spark):
    created = [(f"O{k}", "order_created", at(0), "Z1") for k in range(3000)]
    done = [(f"O{k}", "order_delivered", at(1 + (k * 37) % 3000 / 100), "Z1") for k in range(3000)]
    done += done[:500] * 3  # copies
    schema = "order_id string, event_type string, event_time timestamp, user_zone_id string"
    orders = spark.createDataFrame(created + done, schema)
    merged = sketches.merged_deliveries(sketches.delivery_sketches(orders, 5), 1440)
    row = sketches.delivery_percentiles(merged).collect()[0]
    exact = np.sort([(d[2] - NOON).total_seconds() / 60 for d in done])
    assert row.n == len(exact)
    for p, value in ((0.5, row.p50), (0.95, row.p95)):
        rank = np.searchsorted(exact, value, "right") / len(exact)
        assert abs(rank - p) < 4 * 1.7 / sketches.QUANTILE_K


def test_arrival_order_on_a_stream(spark, tmp_path):
    session = stream_session(spark, 2)
    schema = "order_id string, event_id string, event_type string, event_time timestamp, ingestion_time timestamp"
    rows = [("a", f"e{k}", "x", None if k == 4 else at(m), at(k)) for k, m in enumerate([0, 5, 3, 5, 1, 9, 8, 2])]
    rows += [(None, "n", "x", at(0), at(1)), ("b", "b1", "x", at(3), at(2)), ("b", "b2", "x", at(2), at(2))]
    rows += [("b", "b3", "x", at(1), None), ("c", "c1", "x", at(60 * 24 * 20), at(60 * 24 * 20))]
    rows.sort(key=lambda r: r[4] or at(0))
    for part in (rows[:4], rows[4:8], rows[8:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = readers.stream_parquet(session, f"{tmp_path}/in", spark.createDataFrame([], schema).schema)
        finish(start_parquet(out_of_order_stream(stream), f"{tmp_path}/out", f"{tmp_path}/checkpoint"))
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    want = quality.out_of_order(spark.createDataFrame(rows, schema))
    assert sorted(map(repr, got)) == sorted(map(repr, want.collect())) and len(got) > 3
    state = session.read.format("statestore").option("stateVarName", "latest").load(f"{tmp_path}/checkpoint")
    assert {r.key.key for r in state.collect()} == {"c"}  # the others were forgotten


def test_weights_follow_the_promotions_that_hold(spark):
    names = "restaurant_id string, zone_id string, category string, matchday_sensitivity string"
    restaurants = spark.createDataFrame(
        [("r1", "Z1", "pizza", "low"), ("r2", "Z1", "sushi", None), ("r3", "Z2", "pizza", "high"), ("r4", None, None, None)], names
    )
    none = spark.createDataFrame([], "zone_id string, category string, multiplier double")
    promotions = spark.createDataFrame(
        [
            ("pizza", at(0), at(120), 2.0),
            ("pizza", at(60), at(120), 3.0),  # begins later, so it counts
            ("pizza", at(60), at(120), 2.5),
            ("sushi", at(30), at(31), 9.0),  # covers no start of an hour
            ("sushi", at(60), at(0), 9.0),
            ("sushi", at(60), None, 9.0),
        ],
        "category string, valid_from timestamp, valid_to timestamp, multiplier double",
    )
    times = spark.createDataFrame([(at(10),), (at(70),), (at(130),), (None,)], "at timestamp")
    hours = enrich.promotion_hours(promotions)
    got = enrich.restaurant_weights_at(restaurants, none, hours, times, match_day=False).collect()
    weights = {(r.at, r.restaurant_id): r.weight for r in got}
    assert [weights[at(m), "r1"] for m in (10, 70, 130)] == [2.0, 3.0, 1.0]
    assert {weights[at(m), "r2"] for m in (10, 70, 130)} == {1.0}
    sums = {}
    for r in got:
        if r.zone_id:
            sums[r.at, r.zone_id] = sums.get((r.at, r.zone_id), 0) + r.zone_share
    assert len(sums) == 6 and np.allclose(list(sums.values()), 1)
    assert enrich.restaurant_weights_at(restaurants, none, hours, times.limit(0)).count() == 0


def test_harder_feed_has_what_it_says(spark):
    from ordertide.plans import feeds

    orders = feeds.harder(Tables(spark, "/root/testdata/sf0.001").orders)
    assert orders.filter("order_id IS NULL").count() and orders.filter("event_time IS NULL").count()
    assert quality.out_of_order(orders).count() > 0
