"""Small hand-made feeds for the corners of the operators."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from ordertide.functions import columns as X
from ordertide.functions.quantiles import exact_quantiles
from ordertide.operators import couriers as cour
from ordertide.operators import enrich, facts, pairs, quality, revenue, tables, windows
from ordertide.operators import orders as ords
from ordertide.plans.registry import Tables
from ordertide.schemas import COURIER_EVENTS, ORDER_EVENTS, ORDER_FEED, ORDER_RECORD, ORDER_WIRE
from ordertide.session import run_folder, stream_session
from ordertide.sources import decode, kafka, readers, reference, sinks
from ordertide.streaming import dedup, lifecycle, sessions
from ordertide.streaming.pipeline import start_pipeline, stop_all
from ordertide.streaming.sinks import dropped_late_rows, finish, start_parquet

T0 = dt.datetime(2024, 3, 4, 12, 0)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def make(spark, schema, rows):
    base = {"event_version": "1.0", "is_late_event": False, "match_day_flag": False, "holiday_flag": False, "anomaly_flag": False}
    full = []
    for number, row in enumerate(rows):
        row = {**base, "event_id": f"X{number}", **row}
        row.setdefault("ingestion_time", row.get("event_time"))
        full.append(tuple(row.get(name) for name in schema.names))
    return spark.createDataFrame(full, schema)


def orders(spark, rows):
    named = ("order_id", "event_type", "event_time")
    return make(spark, ORDER_EVENTS, [dict(zip(named, r[:3])) | (r[3] if len(r) > 3 else {}) for r in rows])


def couriers(spark, rows):
    named = ("courier_id", "event_type", "event_time")
    return make(spark, COURIER_EVENTS, [dict(zip(named, r[:3])) | (r[3] if len(r) > 3 else {}) for r in rows])


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


# KPIs


def test_kpis_of_an_empty_feed(spark):
    row = one(ords.order_kpis(orders(spark, [])))
    assert row["total_created"] == row["orders_in_flight"] == row["total_cancelled"] == 0
    assert row["cancellation_rate_pct"] == 0.0
    assert row["p95_delivery_min"] is None and row["avg_prep_time_min"] is None and row["on_time_rate_pct"] is None
    assert one(revenue.gmv(orders(spark, []))) == {
        "estimated_gmv_eur": 0.0,
        "hourly_run_rate_eur": 0.0,
        "eod_projection_eur": 0.0,
    }
    assert one(cour.courier_kpis(couriers(spark, []))) == {
        "active_couriers": 0,
        "online_couriers": 0,
        "deliveries_completed": 0,
        "utilization_rate": None,
    }
    for empty in (ords.orders_over_time, ords.delivery_percentiles, ords.stage_times, ords.at_risk_orders, ords.order_outcomes):
        assert empty(orders(spark, [])).count() == 0


def test_kpis_stop_at_the_last_created_order(spark):
    feed = orders(
        spark,
        [
            ("A", "order_created", at(0)),
            ("A", "order_delivered", at(30), {"actual_prep_time": 10.0, "actual_delivery_time": -7.0}),
            ("B", "order_created", at(40)),
            ("B", "order_delivered", at(70)),
            ("C", "order_created", at(-24 * 60)),
            ("C", "order_cancelled_system", at(-23 * 60)),
        ],
    )
    row = one(ords.order_kpis(feed))
    assert (row["total_created"], row["total_delivered"], row["created_today"]) == (3, 1, 2)
    # B is delivered after the snapshot and C's system cancellation does not count.
    assert row["orders_in_flight"] == 2
    assert row["avg_prep_time_min"] == 10.0 and row["avg_travel_time_min"] is None
    assert row["avg_full_delivery_min"] == 30.0 and row["on_time_rate_pct"] == 100.0
    assert one(ords.order_kpis(feed, ["order_cancelled_system"]))["total_cancelled"] == 1


def test_delivery_before_creation_is_left_out_and_copies_weigh(spark):
    feed = orders(
        spark,
        [
            ("A", "order_created", at(10)),
            ("A", "order_delivered", at(5)),
            ("B", "order_created", at(0)),
            ("B", "order_created", at(0)),
            ("B", "order_delivered", at(20)),
            ("B", "order_delivered", at(20)),
            ("B", "order_delivered", at(50)),
            ("N", "order_delivered", at(50)),
        ],
    )
    joined = {(r.order_id, r.full_delivery_min): r.pairs for r in pairs.created_delivered(feed).collect()}
    assert joined == {("B", 20.0): 4, ("B", 50.0): 2}
    assert one(ords.full_delivery_by_zone(feed.withColumn("user_zone_id", F.lit("Z1"))))["avg_full_delivery_min"] == 30.0


def test_active_orders_clip_without_feeding_back(spark):
    feed = orders(
        spark,
        [
            ("A", "order_created", at(0)),
            ("B", "order_delivered", at(1)),
            ("C", "order_delivered", at(2)),
            ("D", "order_created", at(40)),
            ("E", "order_delivered", at(24 * 60)),
            ("F", "order_created", at(24 * 60 + 30)),
            ("Z", "order_delivered", at(24 * 60 + 200)),
        ],
    )
    rows = ords.orders_over_time(feed).orderBy("bucket").collect()
    assert [r.active_orders for r in rows[:3]] == [0, 0, 0]
    # The last creation bounds the axis; the late delivery beyond it vanishes.
    assert len(rows) == 24 * 4 + 3 and sum(r.orders_delivered for r in rows) == 3
    running, expected = 0, []
    for r in rows:
        running += r.orders_created - r.orders_delivered
        expected.append(max(running, 0))
    assert [r.active_orders for r in rows] == expected


def test_zone_flag_has_three_values(spark):
    z = lambda zone, **more: {"user_zone_id": zone, **more}
    feed = orders(
        spark,
        [
            ("A", "order_created", at(0), z("quiet")),
            ("B", "order_delivered", at(0), z("slow", actual_delivery_time=46.0)),
            ("C", "order_delivered", at(0), z("fine", actual_delivery_time=45.0)),
            ("D", "order_created", at(0), z("odd", anomaly_flag=True)),
        ],
    )
    flags = {r.zone_id: r.zone_flagged for r in windows.anomaly_zones(feed).collect()}
    assert flags == {"quiet": None, "slow": True, "fine": False, "odd": True}
    assert {r.zone_id for r in windows.anomaly_alerts(feed).collect()} == {"slow", "odd"}


def test_online_couriers_fall_back_to_everyone_seen(spark):
    feed = [("C1", "courier_assigned_order", at(0)), ("C2", "courier_delivery_completed", at(1))]
    assert one(cour.courier_kpis(couriers(spark, feed)))["online_couriers"] == 2
    feed.append(("C3", "courier_online", at(2)))
    assert one(cour.courier_kpis(couriers(spark, feed)))["online_couriers"] == 1


def test_demand_without_supply_and_the_reverse(spark):
    demand = orders(spark, [("A", "order_created", at(0), {"user_zone_id": "Z1"}), ("B", "order_created", at(0))])
    supply = couriers(spark, [("C1", "courier_assigned_order", at(0), {"courier_zone_id": "Z2"})])
    rows = {r.zone_id: (r.orders, r.couriers, r.demand_courier_ratio) for r in cour.zone_demand_supply(demand, supply).collect()}
    assert rows == {"Z1": (1, 0, 10.0), "Z2": (0, 1, 0.0)}


def test_at_risk_orders_start_at_the_median(spark):
    feed = orders(spark, [(f"O{i}", "order_created", at(i)) for i in range(5)] + [("O0", "order_delivered", at(9))])
    rows = ords.at_risk_orders(feed).collect()
    assert [(r.order_id, r.elapsed_min) for r in rows] == [("O1", 8.0), ("O2", 7.0)]


def test_hopping_windows_count_every_row_twice(spark):
    feed = orders(spark, [(f"O{i}", "order_created", at(i * 1.7), {"user_zone_id": f"Z{i % 3}"}) for i in range(40)])
    assert windows.orders_hopping_kpi(feed).agg(F.sum("event_count")).first()[0] == 80


# Quantiles


@pytest.mark.parametrize("width", [0.5, 1.0, 1000.0])
def test_quantiles_match_brute_force_with_a_hot_group(spark, width):
    random.seed(7)
    rows = [("hot", random.choice([1.0, 2.5, 2.5, 90.0, -4.25])) for _ in range(900)]
    rows += [(random.choice(["a", "b", None]), random.uniform(-50, 50)) for _ in range(300)] + [("solo", 3.0), ("a", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: (r.low, r.mid, r.n) for r in exact_quantiles(df, ["g"], "x", {"low": 0.05, "mid": 0.5}, bin_width=width).collect()}
    for group in {g for g, _ in rows}:
        values = sorted(x for g, x in rows if g == group and x is not None)
        position = (len(values) - 1) * 0.05
        low = values[int(position)]
        high = values[min(int(position) + 1, len(values) - 1)]
        assert got[group][0] == pytest.approx(low + (high - low) * (position - int(position)))
        assert got[group][1] == pytest.approx(statistics.median(values))
        assert got[group][2] == len(values)


def test_quantile_weights_stand_for_rows(spark):
    df = spark.createDataFrame([(1.0, 3), (10.0, 1)], "x double, w bigint")
    assert one(exact_quantiles(df, [], "x", {"p": 0.95}, weight="w"))["p"] == pytest.approx(1 + 9 * 0.85)


# Tables and quality


def test_first_row_per_key_keeps_rows_without_key(spark):
    rows = [("k", 2, "b"), ("k", 1, "z"), ("k", 1, "a"), (None, 5, "x"), (None, 5, "x")]
    df = spark.createDataFrame(rows, "event_id string, ingestion_time int, v string")
    kept = sorted(map(str, tables.dedup_first(df, order=("ingestion_time",)).collect()))
    assert len(kept) == 3 and any("v='a'" in k for k in kept)


def test_first_row_per_key_reads_its_source_once(spark):
    path = run_folder(spark, "feed")
    spark.createDataFrame([("k", 2), (None, 1)], "event_id string, ingestion_time int").write.parquet(path)
    df = tables.dedup_first(spark.read.parquet(path), order=("ingestion_time",))
    assert df.count() == 2
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_bounds_keep_a_stray_time_off_the_spine(spark):
    feed = orders(spark, [("A", "order_created", at(0)), ("B", "order_created", at(30))])
    stray = feed.limit(1).withColumn("event_time", F.lit("1970-01-02").cast("timestamp"))
    bounded = ords.orders_over_time(feed.unionByName(stray), since=at(0), until=at(60))
    assert sorted(bounded.collect()) == sorted(ords.orders_over_time(feed).collect())


def test_out_of_order_matches_brute_force(spark):
    random.seed(3)
    rows = []
    for i in range(400):
        event = at(random.uniform(0, 600))
        rows.append((f"O{i % 3 if i % 2 else 0}", "order_created", event, {"event_id": f"X{i:04d}", "ingestion_time": event + dt.timedelta(minutes=random.uniform(0, 90))}))
    got = {r.event_id for r in quality.out_of_order(orders(spark, rows), slice_minutes=30).collect()}
    expected, latest = set(), {}
    for order, _, event, more in sorted(rows, key=lambda r: (r[3]["ingestion_time"], r[3]["event_id"])):
        if order in latest and event < latest[order]:
            expected.add(more["event_id"])
        latest[order] = max(event, latest.get(order, event))
    assert got == expected and expected


def test_missing_steps_and_violations(spark):
    feed = orders(spark, [("A", "order_created", at(0)), ("A", "order_delivered", at(9)), ("B", "order_created", at(0))])
    missing = {r.missing_step for r in quality.missing_steps(feed).collect()}
    assert missing == {"order_confirmed", "order_preparing", "order_ready_for_pickup", "order_picked_up"}
    wire = spark.createDataFrame([("1", "order_created", "2024-13-99"), (None, "teleported", "2024-01-01T00:00:00Z")], "event_id string, event_type string, event_time string")
    wire = wire.withColumn("ingestion_time", F.col("event_time"))
    counts = {r.rule: r.events for r in quality.schema_violations(wire, ["event_id"], ["order_created"]).collect()}
    assert counts == {"missing event_id": 1, "unknown event_type": 1, "unreadable event_time": 1, "unreadable ingestion_time": 1}


def test_scalar_columns(spark):
    df = spark.createDataFrame([("3.5", " YES "), ("-1", "no"), ("NaN", "1"), ("x", None)], "n string, f string")
    rows = df.select(X.positive("n").alias("p"), X.flag("f").alias("f")).collect()
    assert [r.p for r in rows] == [3.5, None, None, None]
    assert [r.f for r in rows] == [True, False, True, False]
    clock = spark.createDataFrame([(dt.datetime(2024, 3, 9, 14, 30),), (dt.datetime(2024, 3, 9, 14, 30, 1),)], "t timestamp")
    assert [r[0] for r in clock.select(X.meal_period(F.col("t"))).collect()] == ["lunch", None]


def test_event_log_never_cuts_long_text(spark):
    feed = orders(spark, [("ORDER-WITH-A-LONG-NAME", "order_created", at(0)), (None, "something_rather_long_here", None)])
    lines = [r.line for r in tables.event_log(feed, couriers(spark, [])).orderBy("event_id").collect()]
    assert lines[0] == "  2024-03-04  12:00   Created               ORDER-WITH-A-LONG-NAME   -         Order"
    assert lines[1].startswith("  ????-??-??  ??:??   something_rather_long_here  -")


# Enrichment


def test_promotions_by_precedence_and_hour(spark):
    hours = enrich.promo_hours(spark, [("first", [0], 10, 13, ["pizza"]), ("second", [], 0, 24, ["pizza"]), ("never", [0], 5, 5, ["pizza"])])
    feed = orders(
        spark,
        [("A", "order_created", at(0), {"restaurant_category": "pizza"}), ("B", "order_created", at(60), {"restaurant_category": "pizza"}), ("C", "order_created", at(0), {"restaurant_category": "sushi"})],
    )
    assert {r.order_id: r.promo for r in enrich.promo_match(feed, hours).collect()} == {"A": "first", "B": "second", "C": None}


def test_match_past_midnight_goes_into_the_next_weekday(spark):
    schedule = spark.createDataFrame([("Z1", "Z2", 6, 1430, 20)], "primary_zone string, secondary_zone string, day_of_week int, start_minute int, duration_minutes int")
    monday = dt.datetime(2024, 3, 4, 0, 9)
    feed = orders(spark, [("A", "order_created", monday, {"user_zone_id": "Z1"}), ("B", "order_created", monday, {"user_zone_id": "Z2"}), ("C", "order_created", monday + dt.timedelta(minutes=1), {"user_zone_id": "Z1"})])
    tags = {r.order_id: r.match_role for r in enrich.match_day_tag(feed, enrich.match_minutes(schedule)).collect()}
    assert tags == {"A": "primary", "B": "secondary", "C": "none"}


def test_reference_tables_are_checked(spark):
    def csv(rows, columns):
        path = run_folder(spark, "csv")
        spark.createDataFrame(rows, columns).coalesce(1).write.option("header", True).csv(path)
        return path

    zones = reference.read_zones(spark, csv([(" Z1 ", "One", 10, 0.5), ("Z2", "Two", 20, 0.75)], "zone_id string, district string, population int, spawn_probability double"))
    assert {r.zone_id: r.spawn_probability for r in zones.collect()} == {"Z1": 0.4, "Z2": 0.6}
    bad = reference.read_zones(spark, csv([("Z1", "One", 10, 1.5)], "zone_id string, district string, population int, spawn_probability double"))
    with pytest.raises(Exception, match="invalid spawn probability"):
        bad.collect()
    header = "zone_from string, zone_to string, district_from string, district_to string, hop_count int, distance_index double, mean_time_min double, std_dev_min double, base_delay_probability double, pickup_cancel_factor double, user_cancel_sensitivity double, same_zone string"
    routes = csv([("A", "B", "a", "b", 1, 1.0, m, 1.0, 0.1, 1.0, 1.0, "Yes") for m in (10.0, 12.0)], header)
    row = one(reference.read_travel_matrix(spark, routes))
    assert row["mean_time_min"] == 12.0 and row["same_zone"] is True


# Sources


def test_avro_round_trip_and_malformed_payloads(spark):
    feed = orders(
        spark,
        [
            ("A", "order_created", at(0), {"restaurant_category": "sushi ñ", "actual_prep_time": -3.0, "estimated_prep_time": 2.5}),
            ("B", "order_delivered", at(1), {"courier_id": "C" * 300, "is_late_event": True, "event_delay_seconds": 2147483647.0}),
        ],
    )
    good = kafka.messages(feed, ORDER_FEED, "avro")
    junk = spark.createDataFrame([(None, bytearray(b)) for b in (b"", b"\x02", b"{}", b"\xff" * 40, b"\x04\xff\xfe" + b"\x00" * 30)], "key binary, value binary")
    cut = good.select("key", F.expr("substring(value, 1, length(value) - 1)").alias("value"))
    rows = decode.decode_avro_rows(good.union(junk).union(cut), ORDER_RECORD).orderBy("order_id").collect()
    assert [(r.order_id, r.event_type, r.event_time) for r in rows] == [("A", "order_created", at(0)), ("B", "order_delivered", at(1))]
    assert rows[0].restaurant_category == "sushi ñ" and rows[0].actual_prep_time == -3 and rows[0].estimated_prep_time == 2
    assert rows[1].courier_id == "C" * 300 and rows[1].event_delay_seconds == 2147483647 and rows[1].is_late_event


def test_json_feed_skips_what_cannot_be_read(spark):
    path = run_folder(spark, "ndjson")
    lines = ['{"event_id": "1", "event_time": "2024-01-01T00:00:00Z"}', "", "not json", '{"event_id": "2", "actual_prep_time": "x"}']
    spark.createDataFrame([(line,) for line in lines], "line string").write.text(path)
    rows = readers.read_ndjson(spark, path, ORDER_WIRE)
    assert {r.event_id for r in rows.collect()} == {"1", "2"}
    raw = spark.createDataFrame([(line,) for line in lines], "line string").select(F.col("line").cast("binary").alias("value"))
    assert decode.decode_json(raw, ORDER_WIRE).count() == 2
    times = {r.event_id: r.event_time for r in decode.finalise_events(rows).collect()}
    assert times == {"1": dt.datetime(2024, 1, 1), "2": None}


def test_unreadable_parquet_files_are_skipped(spark, tmp_path):
    folder = str(tmp_path / "feed")
    spark.range(3).write.parquet(folder)
    (tmp_path / "feed" / "broken.parquet").write_bytes(b"this is not parquet at all")
    spark.range(2).withColumn("more", F.lit(1)).write.mode("append").parquet(folder)
    assert readers.read_parquet_prefix(spark, folder, "id long", skip_corrupt=True).count() == 5
    with pytest.raises(Exception, match="broken.parquet"):
        readers.read_parquet_prefix(spark, folder, "id long").count()


def test_absent_and_partitioned_folders(spark, tmp_path):
    assert readers.read_parquet_prefix(spark, str(tmp_path / "none"), "id long").columns == ["id"]
    assert readers.read_ndjson(spark, str(tmp_path / "none"), "id long").count() == 0
    (tmp_path / "empty").mkdir()
    full = spark.range(2)
    empty = readers.read_parquet_prefix(spark, str(tmp_path / "empty"), "id long")
    assert readers.load_with_fallback(empty, full) is full
    folder = str(tmp_path / "days")
    spark.range(4).withColumn("day", F.col("id") % 2).write.partitionBy("day").parquet(folder)
    one = readers.read_parquet_prefix(spark, folder, "id long, day long").where("day = 1")
    assert one.count() == 2
    assert "PartitionFilters: [isnotnull(day" in one._jdf.queryExecution().executedPlan().toString()


def test_written_times_do_not_follow_the_session_zone(spark, tmp_path):
    feed = orders(spark, [("A", "order_created", at(0))])
    want = sinks.iso_times(feed).first().event_time
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert sinks.iso_times(feed).first().event_time == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_archive_keeps_late_events(spark):
    session = stream_session(spark, partitions=2)
    out, topic = run_folder(spark, "late"), run_folder(spark, "topic")
    empty = couriers(spark, [("C", "courier_online", at(0))])
    other = run_folder(spark, "topic")
    kafka.messages(sinks.iso_times(empty), "courier_operations").write.parquet(other)
    for number, minute in ((1, 0), (2, 300), (3, 90)):
        row = orders(spark, [(f"O{number}", "order_created", at(minute))]).withColumn("event_id", F.lit(f"e{number}"))
        kafka.messages(sinks.iso_times(row), ORDER_FEED).write.mode("append").parquet(topic)
        topics = [readers.stream_parquet(session, p, "key binary, value binary") for p in (topic, other)]
        for query in start_pipeline(*topics, out, out + "-checkpoints", interval=None).values():
            finish(query, 240)
    assert spark.read.parquet(f"{out}/orders").count() == 3


def test_fallback_source(spark):
    full = spark.range(2)
    assert readers.load_with_fallback(None, full) is full
    assert readers.load_with_fallback(spark.range(0), full) is full
    assert readers.load_with_fallback(full, None) is full


def test_broker_options():
    options = kafka.source_options("host:9093", "orders", "me", "secret", max_offsets=1000)
    assert options["startingOffsets"] == "earliest" and options["failOnDataLoss"] == "false"
    assert options["kafka.sasl.mechanism"] == "PLAIN" and 'password="secret"' in options["kafka.sasl.jaas.config"]
    assert options["maxOffsetsPerTrigger"] == "1000"
    assert "kafka.sasl.mechanism" not in kafka.sink_options("host:9092", "orders")


# Streams


def _append(spark, feed, path):
    feed.coalesce(1).write.mode("append").parquet(path)


def test_late_rows_are_dropped_and_counted(spark):
    source, out = run_folder(spark, "late"), run_folder(spark, "late-out")
    session = stream_session(spark, partitions=2)

    def run(rows):
        _append(spark, orders(spark, rows), source)
        stream = windows.orders_tumbling_kpi(readers.stream_parquet(session, source, ORDER_EVENTS))
        query = start_parquet(stream, out, out + "-checkpoint")
        finish(query, 120)
        return query

    run([("A", "order_created", at(0)), ("B", "order_created", at(60))])
    query = run([("C", "order_created", at(1)), ("D", "order_created", at(50)), ("E", "order_created", at(300))])
    assert dropped_late_rows(query) == 1
    counts = {r.window_start: r.event_count for r in spark.read.parquet(out).collect()}
    assert counts == {at(0): 1, at(50): 1, at(60): 1}


def test_watermarked_dedup_over_restarts(spark):
    source, out = run_folder(spark, "dup"), run_folder(spark, "dup-out")
    session = stream_session(spark, partitions=2)
    for rows in ([("A", "order_created", at(0), {"event_id": "1"})], [("A", "order_created", at(0), {"event_id": "1"}), ("A", "order_created", at(0), {"event_id": "2"})]):
        _append(spark, orders(spark, rows), source)
        finish(start_parquet(dedup.dedup_watermark(readers.stream_parquet(session, source, ORDER_EVENTS)), out, out + "-checkpoint"), 120)
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == ["1", "2"]


def test_sessions_match_brute_force(spark):
    random.seed(11)
    rows = []
    for courier in ("hot", "c1", "c2"):
        clock = 0.0
        for _ in range(300 if courier == "hot" else 20):
            clock += random.choice([1, 5, 29, 30, 31, 400])
            rows.append((courier, random.choice(["courier_delivery_completed", "courier_online"]), at(clock), {"courier_zone_id": random.choice(["Z1", "Z2"]), "actual_travel_time": 4.0}))
    got = {(r.courier_id, r.first_event): (r.last_event, r.events, r.deliveries, r.zones) for r in sessions.courier_sessions(couriers(spark, rows), slice_minutes=60).collect()}
    expected = {}
    for courier in ("hot", "c1", "c2"):
        run = []
        for row in sorted((r for r in rows if r[0] == courier), key=lambda r: r[2]) + [None]:
            if run and (row is None or row[2] - run[-1][2] > dt.timedelta(minutes=30)):
                zones = {r[3]["courier_zone_id"] for r in run}
                done = sum(r[1] == "courier_delivery_completed" for r in run)
                expected[(courier, run[0][2])] = (run[-1][2], len(run), done, len(zones))
                run = []
            if row:
                run.append(row)
    assert got == expected


def test_stuck_orders(spark):
    feed = orders(
        spark,
        [
            ("A", "order_ready_for_pickup", at(0)),
            ("B", "order_ready_for_pickup", at(0)),
            ("B", "courier_assigned_order", at(15)),
            ("C", "order_ready_for_pickup", at(0)),
            ("C", "courier_assigned_order", at(16)),
            ("D", "order_ready_for_pickup", at(0)),
            ("D", "order_cancelled_restaurant", at(1)),
        ],
    )
    assert {r.order_id for r in lifecycle.stuck_orders(feed).collect()} == {"A", "C"}
    states = {r.order_id: (r.last_event, r.stuck) for r in lifecycle.order_lifecycle(feed).collect()}
    assert states["C"] == ("courier_assigned_order", True) and states["D"] == ("order_cancelled_restaurant", False)


def test_the_six_queries_start_and_stop(spark):
    session = stream_session(spark, partitions=2)
    topics = []
    for feed, rows in ((ORDER_FEED, orders(spark, [("A", "order_created", at(0))])), ("courier_operations", couriers(spark, [("C", "courier_online", at(0))]))):
        path = run_folder(spark, "topic")
        kafka.messages(sinks.iso_times(rows), feed).write.parquet(path)
        topics.append(readers.stream_parquet(session, path, "key binary, value binary"))
    out = run_folder(spark, "six")
    queries = start_pipeline(*topics, out, out + "-checkpoints", interval=None)
    for query in queries.values():
        finish(query, 240)
    stop_all(queries)
    assert len(queries) == 6 and spark.read.parquet(f"{out}/orders").count() == 1
    states = [s for s in queries["kpi_orders_5min_tumbling"].lastProgress["stateOperators"]]
    assert states and all(s["numShufflePartitions"] == 2 for s in states)
    assert all(any(name.startswith("rocksdb") for name in s["customMetrics"]) for s in states)
    plain = [spark.readStream.format("rate").load() for _ in topics]
    with pytest.raises(ValueError, match="stream_session"):
        start_pipeline(*plain, out, out + "-checkpoints")


@pytest.mark.parametrize("minutes", [7, 15, 50, 1441])
def test_spine_of_any_width(spark, minutes):
    """Every creation and delivery is in one bucket of the spine, whether or not the width divides a day."""
    rows = Tables(spark, "/root/testdata/sf0.001").orders
    spine = ords.orders_on_spine(rows, minutes)
    created = rows.filter("event_type = 'order_created'")
    assert spine.agg(F.sum("orders_created")).first()[0] == created.count()
    buckets = [r.us for r in spine.select(F.unix_micros("bucket").alias("us")).orderBy("us").collect()]
    assert {b - a for a, b in zip(buckets, buckets[1:])} == {minutes * 60_000_000}
    over_time = ords.orders_over_time(rows, minutes).orderBy("bucket").collect()
    active, known = 0, {r.bucket: r for r in spine.collect()}
    for r in over_time:
        active += known[r.bucket].orders_created - known[r.bucket].orders_delivered
        assert r.active_orders == max(active, 0)


def test_results_do_not_depend_on_the_session_zone(spark):
    """Days, hours and clock times are UTC's, under any session zone and across its clock changes."""
    rows = Tables(spark, "/root/testdata/sf0.001")
    orders, couriers = rows.orders, rows.couriers
    shift = F.timestamp_micros(F.unix_micros("event_time") + 66 * 86_400_000_000)  # over a clock change in March
    orders, couriers = (f.withColumn("event_time", shift).cache() for f in (orders, couriers))
    assert orders.count() and couriers.count()
    holidays = [(3, 10), (4, 1)]

    def results():
        labels = rows.zones.select("zone_id", F.col("district").alias("zone_label"))
        ratios = cour.zone_demand_supply(orders, couriers)
        frames = [
            enrich.calendar_tags(orders, holidays),
            ords.latest_day_flags(orders),
            ords.order_kpis(orders),
            cour.zone_stress_pivot(ratios, labels),
            quality.dispatch_latency(orders, couriers),
            orders.select("event_id", enrich.demand_factor(F.col("event_time"), holidays).alias("factor")),
            tables.event_log(orders, couriers),
            ords.orders_over_time(orders),
            enrich.zone_demand_share(rows.zones, dt.date(2024, 3, 10), holidays),
            facts.order_kpis(facts.order_facts(orders)),
        ]
        out = []
        for frame in frames:
            stamps = [c for c, kind in frame.dtypes if kind == "timestamp"]
            frame = frame.withColumns({c: F.unix_micros(c) for c in stamps})
            out.append(sorted(repr([round(v, 9) if isinstance(v, float) else v for v in r]) for r in frame.collect()))
        return out

    want = results()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for k, (a, b) in enumerate(zip(results(), want, strict=True)):
            assert a == b, k
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        orders.unpersist()
        couriers.unpersist()
