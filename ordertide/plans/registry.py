"""Every operator as a named query over the given tables."""

import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertide import constants as C
from ordertide.functions import columns as X
from ordertide.operators import couriers as cour
from ordertide.operators import enrich, facts, pairs, quality, revenue, sketches, tables, windows
from ordertide.operators import orders as ords
from ordertide.operators import zones as zon
from ordertide.plans import feeds
from ordertide.plans.replay import Replay, closing_rows, time_slices, without_closing
from ordertide.schemas import (
    COURIER_FEED,
    COURIER_RECORD,
    COURIER_WIRE,
    ORDER_EVENTS,
    ORDER_FEED,
    ORDER_RECORD,
    ORDER_WIRE,
)
from ordertide.session import run_folder, use_utc
from ordertide.sources import decode, kafka, readers, reference, sinks
from ordertide.sources.decode import FEEDS
from ordertide.streaming import dedup, fan_out, joins, lifecycle, quarantine, sessions
from ordertide.streaming.arrival import out_of_order_stream
from ordertide.streaming.buckets import BUCKETS
from ordertide.streaming.pipeline import kpi_streams, start_all
from ordertide.streaming.sinks import finish
from ordertide.streaming.transitions import order_findings

QUERIES = {}
SHARE_DAY = datetime.date(2024, 1, 6)
PROMO_CATEGORIES = ["mexican", "burger"]


class Tables:
    """The given tables of one folder and the feeds derived from them."""

    def __init__(self, spark, folder):
        self.spark = spark
        self.folder = folder

    def read(self, name):
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def orders(self):
        return feeds.order_feed(self.read("events"))

    @property
    def couriers(self):
        return feeds.courier_feed(self.read("events"))

    @property
    def zones(self):
        return feeds.zones(self.read("nation"))

    @property
    def restaurants(self):
        return feeds.restaurants(self.read("supplier"), self.read("nation"))

    @property
    def matrix(self):
        return feeds.travel_matrix(self.read("nation"))

    @property
    def dirty_orders(self):
        """Order events in wire form with missing, unknown and unreadable values."""
        wire = sinks.iso_times(self.orders)
        e = F.substring("order_id", 4, 8).cast("bigint")
        return wire.withColumns(
            {
                "user_id": F.when(e % 31 != 0, F.col("user_id")),
                "event_type": F.when(e % 37 == 0, "order_teleported").otherwise(F.col("event_type")),
                "event_time": F.when(e % 41 == 0, "not-a-time").otherwise(F.col("event_time")),
            }
        )

    def replay(self):
        return Replay(self.spark, self.folder, {ORDER_FEED: self.orders, COURIER_FEED: self.couriers})

    def hard_replay(self):
        hard = {ORDER_FEED: feeds.harder(self.orders), COURIER_FEED: feeds.harder(self.couriers)}
        return Replay(self.spark, f"{self.folder}#hard", hard)


def naive(df):
    """Timestamps without a zone, as the given tables hold them."""
    stamps = [f.name for f in df.schema.fields if f.dataType == T.TimestampType()]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in stamps}) if stamps else df


def rounded(df, *names):
    """Percentiles to nine digits: engines differ in the last bit of the interpolation."""
    return df.withColumns({name: F.round(name, 9) for name in names})


def query(name):
    def register(build):
        def run(spark, folder):
            use_utc(spark)
            return naive(build(Tables(spark, folder)))

        QUERIES[name] = run
        return build

    return register


def saved(t, name):
    return run_folder(t.spark, name)


# Sources


@query("src_kafka")
def _(t):
    # Files of payloads stand in for the topic; the decoding path is the same.
    path = saved(t, "topic")
    kafka.messages(sinks.iso_times(t.orders), ORDER_FEED).write.parquet(path)
    replay = t.replay()
    raw = readers.stream_parquet(replay.session, path, "key binary, value binary")
    return replay.result(dedup.dedup_exact(decode.decode_feed(raw, ORDER_FEED)))


@query("decode_json")
def _(t):
    return decode.decode_json(kafka.messages(sinks.iso_times(t.orders), ORDER_FEED), ORDER_WIRE)


@query("decode_avro")
def _(t):
    return decode.decode_avro_rows(kafka.messages(t.orders, ORDER_FEED, "avro"), ORDER_RECORD)


@query("decode_avro_couriers")
def _(t):
    return decode.decode_avro_rows(kafka.messages(t.couriers, COURIER_FEED, "avro"), COURIER_RECORD)


@query("decode_mixed")
def _(t):
    payloads = kafka.messages(sinks.iso_times(t.couriers), COURIER_FEED).unionByName(
        kafka.messages(t.couriers, COURIER_FEED, "avro")
    )
    return decode.decode_feed(payloads, COURIER_FEED)


@query("align_schema")
def _(t):
    return decode.align_schema(sinks.iso_times(t.orders), COURIER_WIRE)


@query("union_formats")
def _(t):
    json_rows = decode.typed_times(
        decode.decode_json(kafka.messages(sinks.iso_times(t.orders), ORDER_FEED), ORDER_WIRE)
    )
    avro_rows = decode.decode_avro_rows(kafka.messages(t.orders, ORDER_FEED, "avro"), ORDER_RECORD)
    return decode.union_formats(json_rows, avro_rows, ORDER_EVENTS)


@query("event_time_ts")
def _(t):
    return t.dirty_orders.select("event_id", "event_time", X.to_time("event_time").alias("event_time_ts"))


@query("read_ndjson")
def _(t):
    path = saved(t, "ndjson")
    sinks.write_ndjson(t.couriers, path)
    broken = t.spark.createDataFrame([('{"event_id": "K',), ("",), ("[1, 2",)], "line string")
    broken.write.mode("append").text(path)
    return decode.align_schema(readers.read_ndjson(t.spark, path, COURIER_WIRE), COURIER_WIRE)


@query("read_parquet_prefix")
def _(t):
    path = saved(t, "events")
    sinks.write_events(t.orders, path)
    return readers.read_parquet_prefix(t.spark, path, t.orders.schema).select(*t.orders.columns)


@query("archive_by_date")
def _(t):
    # One day of a raw feed; the filter reaches the folders of the dates.
    path = saved(t, "archive")
    sinks.write_events(t.orders, path)
    schema = t.orders.schema.add("event_date", "date")
    days = readers.read_parquet_prefix(t.spark, path, schema).where(F.col("event_date") == F.lit(SHARE_DAY))
    return days.select("event_id", "event_type", "event_time")


@query("load_with_fallback")
def _(t):
    absent = readers.read_parquet_prefix(t.spark, saved(t, "absent"), t.orders.schema)
    return readers.load_with_fallback(absent, t.orders).select("event_id", "event_type", "order_id", "event_time")


@query("finalise_events")
def _(t):
    return decode.finalise_events(sinks.iso_times(t.orders))


def _csv(t, df, name):
    path = saved(t, name)
    df.write.option("header", True).csv(path)
    return path


@query("ref_zones")
def _(t):
    return reference.read_zones(t.spark, _csv(t, t.zones, "zones"))


@query("ref_restaurants")
def _(t):
    path = _csv(t, t.restaurants, "restaurants")
    return reference.read_restaurants(t.spark, path)


@query("ref_travel_matrix")
def _(t):
    return reference.read_travel_matrix(t.spark, _csv(t, t.matrix, "matrix"))


@query("ref_match_effects")
def _(t):
    return reference.read_match_effects(t.spark, _csv(t, feeds.match_effects(t.read("nation")), "effects"))


@query("ref_adjacency")
def _(t):
    return reference.read_adjacency(t.spark, _csv(t, feeds.adjacency(t.read("nation")), "adjacency"))


# Sinks


@query("sink_parquet_stream")
def _(t):
    replay = t.replay()
    return without_closing(replay.result(replay.stream(ORDER_FEED)))


@query("sink_ndjson")
def _(t):
    path = saved(t, "ndjson")
    sinks.write_ndjson(t.orders, path, max_per_file=1000)
    return decode.typed_times(readers.read_ndjson(t.spark, path, ORDER_WIRE))


@query("to_avro_record")
def _(t):
    return sinks.to_avro_record(t.dirty_orders, ORDER_FEED)


@query("to_avro_record_couriers")
def _(t):
    path = saved(t, "records")
    kind = sinks.write_records(t.couriers, COURIER_FEED, path)
    return t.spark.read.format(kind).load(path)


@query("sink_kafka")
def _(t):
    sent = kafka.messages(sinks.iso_times(t.couriers), COURIER_FEED)
    body = F.from_json(F.col("value").cast("string"), COURIER_WIRE)
    return sent.select(F.col("key").cast("string").alias("key"), body.alias("b")).select(
        "key", "b.event_id", "b.event_type", "b.event_time", "b.event_time_epoch_ms"
    )


@query("add_epoch_ms")
def _(t):
    return sinks.with_epoch_ms(t.dirty_orders).select(
        "event_id", "event_time", "event_time_epoch_ms", "ingestion_time_epoch_ms"
    )


@query("interleave_feeds")
def _(t):
    return tables.interleave_feeds(t.orders, t.couriers).select(
        "feed", "event_id", "event_type", "event_time", "order_id", "courier_id"
    )


@query("event_log_lines")
def _(t):
    return tables.event_log(t.orders, t.couriers)


# Scalar functions


@query("filter_event_type")
def _(t):
    ends = t.orders.filter(X.event_is("order_delivered", *C.CANCEL_TYPES))
    return ends.groupBy("user_zone_id").agg(
        X.count_if(X.event_is("order_delivered")).alias("delivered"),
        X.count_if(X.event_is(*C.CANCEL_TYPES)).alias("cancelled"),
    )


@query("time_bucket_15")
def _(t):
    return t.orders.select("event_id", X.time_bucket("event_time").alias("bucket"))


@query("positive_numeric")
def _(t):
    return t.orders.select(
        "event_id", X.positive("actual_prep_time").alias("prep_min"), X.positive("actual_delivery_time").alias("travel_min")
    )


@query("minutes_between")
def _(t):
    lag = X.minutes_between(F.col("event_time"), F.col("ingestion_time"))
    return t.orders.select("event_id", lag.alias("lag_min"))


@query("zone_label")
def _(t):
    return zon.label_events(t.orders, t.zones).select("event_id", "user_zone_id", "zone_label")


@query("normalise_flags")
def _(t):
    return t.restaurants.select("restaurant_id", X.flag("has_consistent_promo").alias("has_promo"))


@query("clip_fill")
def _(t):
    travel = F.col("actual_delivery_time")
    return t.orders.select(
        "event_id",
        X.at_least(travel, 0.0).alias("clipped"),
        X.or_zero("event_delay_seconds").cast("bigint").alias("delay_s"),
        X.present(travel / 8, 1).alias("travel_eighths"),
        X.present(travel / 8, 2).alias("travel_eighths_2"),
    )


@query("calendar_tags")
def _(t):
    return enrich.calendar_tags(t.orders, feeds.HOLIDAYS)


@query("latest_day_flag")
def _(t):
    return ords.latest_day_flags(t.orders)


# Joins


@query("created_delivered")
def _(t):
    return pairs.created_delivered(t.orders)


@query("stage_gap")
def _(t):
    return pairs.stage_gap(t.orders, "order_created", "order_picked_up")


@query("in_flight_orders")
def _(t):
    return ords.in_flight_orders(t.orders)


@query("in_flight_orders_system")
def _(t):
    return ords.in_flight_orders(t.orders, C.ALL_CANCEL_TYPES)


@query("zone_counts_outer")
def _(t):
    return ords.zone_counts_outer(t.orders)


@query("zone_demand_supply")
def _(t):
    return cour.zone_demand_supply(t.orders, t.couriers)


@query("spine_join")
def _(t):
    return ords.orders_on_spine(t.orders).select("bucket", "orders_created", "orders_delivered")


@query("series_align")
def _(t):
    return cour.series_align(t.couriers)


@query("zone_map_table")
def _(t):
    return zon.zone_map(t.zones, ords.zone_metrics(t.orders), ords.full_delivery_by_zone(t.orders))


@query("zone_rankings")
def _(t):
    return zon.zone_rankings(
        ords.zone_metrics(t.orders),
        ords.full_delivery_by_zone(t.orders),
        revenue.gmv_by_zone(t.orders),
        t.zones,
    )


@query("supply_demand_gap")
def _(t):
    return cour.supply_demand_gap(t.orders, t.couriers)


@query("route_lookup")
def _(t):
    created = t.orders.filter(X.event_is("order_created"))
    return enrich.route_lookup(created, t.matrix, "restaurant_zone_id", "user_zone_id").select(
        "event_id", "restaurant_zone_id", "user_zone_id", *C.DEFAULT_ROUTE
    )


@query("district_zone_map")
def _(t):
    return zon.district_zones(t.orders, t.zones)


@query("restaurants_by_zone")
def _(t):
    return enrich.restaurants_by(t.restaurants, t.zones, "zone_id")


@query("restaurants_by_category")
def _(t):
    return enrich.restaurants_by(t.restaurants, t.zones, "category")


@query("promo_match")
def _(t):
    return enrich.promo_match(t.orders, enrich.promo_hours(t.spark, feeds.PROMOS))


@query("zone_health")
def _(t):
    return windows.zone_health(t.orders, t.couriers)


@query("zone_health_stream")
def _(t):
    replay = t.replay()
    return replay.result(windows.zone_health(replay.stream(ORDER_FEED), replay.stream(COURIER_FEED)))


@query("order_courier_interval")
def _(t):
    return joins.order_courier_interval(t.orders, t.couriers)


@query("order_courier_interval_stream")
def _(t):
    replay = t.replay()
    return replay.result(joins.order_courier_interval(replay.stream(ORDER_FEED), replay.stream(COURIER_FEED)))


# Aggregations


@query("orders_tumbling_kpi")
def _(t):
    return windows.orders_tumbling_kpi(t.orders)


@query("orders_tumbling_kpi_stream")
def _(t):
    replay = t.replay()
    return replay.result(windows.orders_tumbling_kpi(replay.stream(ORDER_FEED)))


@query("orders_hopping_kpi")
def _(t):
    return windows.orders_hopping_kpi(t.orders)


@query("orders_hopping_kpi_stream")
def _(t):
    replay = t.replay()
    return replay.result(windows.orders_hopping_kpi(replay.stream(ORDER_FEED)))


@query("orders_waiting")
def _(t):
    return windows.orders_waiting(t.orders)


@query("orders_waiting_stream")
def _(t):
    replay = t.replay()
    return replay.result(windows.orders_waiting(replay.stream(ORDER_FEED)))


@query("couriers_dispatched")
def _(t):
    return windows.couriers_dispatched(t.couriers)


@query("couriers_dispatched_stream")
def _(t):
    replay = t.replay()
    return replay.result(windows.couriers_dispatched(replay.stream(COURIER_FEED)))


@query("anomaly_zones")
def _(t):
    return windows.anomaly_zones(t.orders)


@query("anomaly_zones_stream")
def _(t):
    replay = t.replay()
    return replay.result(windows.anomaly_zones(replay.stream(ORDER_FEED)))


@query("anomaly_alerts")
def _(t):
    return windows.anomaly_alerts(t.orders)


@query("order_kpis")
def _(t):
    kpis = ords.order_kpis(t.orders)
    return rounded(kpis, "p95_prep_time_min", "p95_travel_time_min", "p95_delivery_min")


def _stored_facts(t):
    """Facts of all but the last day, stored, then merged with those of the last day."""
    orders, folder = t.orders, saved(t, "facts")
    latest = orders.agg(F.max("event_time")).first()[0]
    is_old = F.col("event_time") < F.lit(latest) - F.expr("interval 1 day")
    name, buckets = f"facts_{folder[-32:]}", t.spark.sparkContext.defaultParallelism
    old = facts.save_facts(facts.order_facts(orders.filter(is_old)), f"{name}_old", f"{folder}/old", buckets)
    new = facts.order_facts(orders.filter(~F.coalesce(is_old, F.lit(False))))
    return facts.save_facts(facts.merge_facts(old, new), name, f"{folder}/all", buckets)


@query("order_kpis_from_facts")
def _(t):
    kpis = facts.order_kpis(_stored_facts(t))
    return rounded(kpis, "p95_prep_time_min", "p95_travel_time_min", "p95_delivery_min")


@query("stage_times_from_facts")
def _(t):
    return facts.stage_times(_stored_facts(t)).withColumn("avg_min", F.round("avg_min", 9))


@query("at_risk_from_facts")
def _(t):
    return facts.at_risk_orders(_stored_facts(t))


@query("cancellation_mix")
def _(t):
    return ords.cancellation_mix(t.orders, C.ALL_CANCEL_TYPES)


@query("zone_metrics")
def _(t):
    return ords.zone_metrics(t.orders)


@query("full_delivery_by_zone")
def _(t):
    return ords.full_delivery_by_zone(t.orders)


@query("on_time_trend")
def _(t):
    return ords.on_time_trend(t.orders)


@query("delivery_percentiles")
def _(t):
    return rounded(ords.delivery_percentiles(t.orders), "p50", "p95")


@query("stage_times")
def _(t):
    # The total adds four means in no fixed order; nine digits hide the order.
    return ords.stage_times(t.orders).withColumn("avg_min", F.round("avg_min", 9))


@query("courier_kpis")
def _(t):
    return cour.courier_kpis(t.couriers)


@query("courier_activity_rollup")
def _(t):
    quarter_hours = sketches.courier_sketches(t.couriers)
    hours = sketches.merged_couriers(quarter_hours, 60)
    return sketches.courier_counts(sketches.merged_couriers(hours, 1440))


@query("courier_activity_rollup_stream")
def _(t):
    replay = t.replay()
    kept = replay.result(sketches.courier_sketches(replay.stream(COURIER_FEED)))
    return sketches.courier_counts(sketches.merged_couriers(kept, 1440))


@query("delivery_percentiles_sketch")
def _(t):
    return sketches.delivery_percentiles(sketches.merged_deliveries(sketches.delivery_sketches(t.orders, 5), 15))


@query("courier_activity")
def _(t):
    return cour.courier_activity(t.couriers)


@query("gmv")
def _(t):
    return revenue.gmv(t.orders)


@query("gmv_by_zone")
def _(t):
    return revenue.gmv_by_zone(t.orders)


@query("gmv_over_time")
def _(t):
    return revenue.gmv_over_time(t.orders)


@query("gmv_actual")
def _(t):
    return revenue.gmv_actual(t.orders, feeds.order_values(t.read("events")))


@query("order_outcomes")
def _(t):
    return ords.order_outcomes(t.orders)


@query("zone_stress")
def _(t):
    ratios = cour.zone_demand_supply(t.orders, t.couriers)
    return ratios.join(zon.zone_labels(t.zones), "zone_id", "left").select(
        F.coalesce("zone_label", "zone_id").alias("zone_label"), "bucket", "demand_courier_ratio"
    )


@query("zone_stress_pivot")
def _(t):
    return cour.zone_stress_pivot(cour.zone_demand_supply(t.orders, t.couriers), zon.zone_labels(t.zones))


@query("data_freshness")
def _(t):
    return tables.data_freshness(t.orders, t.couriers)


@query("sla_gauge")
def _(t):
    return ords.sla_gauge(t.orders)


@query("feed_counts")
def _(t):
    return tables.feed_counts(t.orders, t.couriers)


# Windows, sorts, set operations


@query("orders_over_time")
def _(t):
    return ords.orders_over_time(t.orders)


@query("at_risk_orders")
def _(t):
    return ords.at_risk_orders(t.orders)


@query("dedup_first")
def _(t):
    # The first event of each type per order: logical copies collapse too.
    return tables.dedup_first(t.orders, ("order_id", "event_type"), ("ingestion_time", "event_time", "event_id"))


@query("weights_normalise")
def _(t):
    return tables.share_of_total(t.zones.select("zone_id", "population"), "population")


@query("top_zones_gmv")
def _(t):
    return revenue.top_zones(revenue.gmv_by_zone(t.orders), zon.zone_labels(t.zones))


@query("sort_by_event_time")
def _(t):
    return tables.sort_by_event_time(t.orders.select("event_id", "event_type", "event_time"))


@query("rank_zones")
def _(t):
    return zon.rank_zones(
        zon.zone_rankings(
            ords.zone_metrics(t.orders), ords.full_delivery_by_zone(t.orders), revenue.gmv_by_zone(t.orders), t.zones
        )
    )


@query("union_by_name")
def _(t):
    return tables.union_feeds(t.orders, t.couriers)


@query("id_difference")
def _(t):
    return ords.open_order_ids(t.orders)


@query("bucket_union")
def _(t):
    return cour.bucket_union(t.orders, t.couriers)


@query("zone_set_filter")
def _(t):
    return zon.zone_set_filter(t.orders, t.zones.filter(F.col("centrality_weight") > 0.85)).select(
        "event_id", "user_zone_id"
    )


# Streaming


@query("dedup_stream")
def _(t):
    replay = t.replay()
    return without_closing(replay.result(dedup.dedup_exact(replay.stream(ORDER_FEED))))


@query("dedup_watermark")
def _(t):
    replay = t.replay()
    return without_closing(replay.result(dedup.dedup_watermark(replay.stream(ORDER_FEED))))


def _logical(events):
    return dedup.dedup_logical(events).select("order_id", "event_type", "event_time")


@query("dedup_logical")
def _(t):
    return _logical(t.orders)


@query("dedup_logical_stream")
def _(t):
    replay = t.replay()
    rows = replay.result(_logical(replay.stream(ORDER_FEED)))
    return rows.filter(~F.col("order_id").startswith("CLOSING"))


@query("watermark")
def _(t):
    # Arrival order: late events come after younger ones, but within the watermark.
    replay = t.replay()
    slices = [*time_slices(t.orders, "ingestion_time", 2), closing_rows(t.spark, ORDER_FEED)]
    return replay.in_slices(ORDER_FEED, slices, windows.anomaly_zones)[0]


@query("windows")
def _(t):
    replay = t.replay()
    return replay.result(windows.orders_per_hour(replay.stream(ORDER_FEED)))


@query("courier_sessions")
def _(t):
    return sessions.courier_sessions(t.couriers)


@query("courier_sessions_stream")
def _(t):
    replay = t.replay()
    return replay.result(sessions.stream_courier_sessions(replay.stream(COURIER_FEED)))


@query("late_policy")
def _(t):
    # The second half arrives first, so all of the first half is behind the watermark.
    replay = t.replay()
    first, second = time_slices(t.orders, "event_time", 2)
    slices = [second, first, closing_rows(t.spark, ORDER_FEED)]
    return replay.in_slices(ORDER_FEED, slices, windows.orders_tumbling_kpi)[0]


@query("quarantine_counts")
def _(t):
    out, _ = _quarantine(t)
    return quarantine.counts(t.spark, out).groupBy("what").agg(F.sum("events").alias("events"))


@query("quarantine_rows")
def _(t):
    out, replay = _quarantine(t)
    bad = quarantine.quarantined(t.spark, out, FEEDS[ORDER_FEED][1])
    good = quarantine.kept(t.spark, out, FEEDS[ORDER_FEED][1]).withColumn("reasons", F.array().cast("array<string>"))
    rows = without_closing(bad.unionByName(good))
    return rows.select("event_id", "event_type", F.array_join("reasons", ", ").alias("reasons"))


def _quarantine(t):
    """The harder feed in three runs of one query: the folder it wrote, and its replay."""
    replay = t.replay()
    source, out = f"{replay.folder}/arriving", f"{replay.folder}/quarantine"
    for part in time_slices(feeds.harder(t.orders), "ingestion_time", 3):
        part.write.mode("append").parquet(source)
        rows = readers.stream_parquet(replay.session, source, FEEDS[ORDER_FEED][1])
        known = (quality.REQUIRED_ORDER_FIELDS, C.ORDER_EVENT_TYPES)
        finish(quarantine.start_quarantine(rows, out, f"{replay.folder}/checkpoint-quarantine", *known))
    return out, replay


@query("append_mode_close")
def _(t):
    # Without closing rows the windows within the watermark of the last event stay open.
    replay = t.replay()
    return replay.in_slices(ORDER_FEED, [t.orders], windows.orders_tumbling_kpi)[0]


def _both_streams(replay):
    return tables.union_feeds(replay.stream(ORDER_FEED), replay.stream(COURIER_FEED))


@query("lifecycle_state")
def _(t):
    return lifecycle.order_lifecycle(tables.union_feeds(t.orders, t.couriers))


@query("lifecycle_state_stream")
def _(t):
    replay = t.replay()
    return replay.result(lifecycle.order_lifecycle(_both_streams(replay)))


@query("stuck_orders")
def _(t):
    return lifecycle.stuck_orders(tables.union_feeds(t.orders, t.couriers))


@query("stuck_orders_stream")
def _(t):
    replay = t.replay()
    return replay.result(lifecycle.stuck_orders(_both_streams(replay)))


@query("lifecycle_transitions")
def _(t):
    return order_findings(tables.union_feeds(feeds.harder(t.orders), feeds.harder(t.couriers)))


@query("lifecycle_transitions_stream")
def _(t):
    replay = t.hard_replay()
    found = replay.result(order_findings(_both_streams(replay), buckets=BUCKETS))
    return found.filter(~F.col("order_id").startswith("CLOSING"))


@query("checkpoint_restart")
def _(t):
    replay = t.replay()
    slices = [*time_slices(t.orders, "event_time", 3), closing_rows(t.spark, ORDER_FEED)]
    return replay.in_slices(ORDER_FEED, slices, windows.orders_tumbling_kpi)[0]


@query("multi_query")
def _(t):
    replay = t.replay()
    streams = kpi_streams(replay.stream(ORDER_FEED), replay.stream(COURIER_FEED))
    running = start_all(streams, f"{replay.folder}/sinks", f"{replay.folder}/checkpoints")
    for started in running.values():
        finish(started)
    counts = None
    for name, stream in streams.items():
        rows = t.spark.read.schema(stream.schema).parquet(f"{replay.folder}/sinks/{name}")
        if "event_id" in rows.columns:
            rows = without_closing(rows)
        one = rows.agg(F.count("*").alias("rows")).select(F.lit(name).alias("sink"), "rows")
        counts = one if counts is None else counts.unionByName(one)
    return counts


def _long(rows, sink, at, key, *metrics):
    """Every row of an output as (sink, at, key, metric, value)."""
    named = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
    rows = rows.select(F.lit(sink).alias("sink"), F.col(at).alias("at"), key.alias("key"), F.inline(F.array(*named)))
    return rows


@query("multi_query_rows")
def _(t):
    # Two runs of each topic; the second brings new events and every twentieth order's old ones again.
    replay = t.replay()
    e = F.substring("order_id", 4, 8).cast("bigint")
    for feed, events in ((ORDER_FEED, t.orders), (COURIER_FEED, t.couriers)):
        topic = f"{replay.folder}/topic-{feed}"
        again = F.coalesce((e % 2 == 1) | (e % 20 == 0), F.lit(False))
        for part in (events.filter(F.coalesce(e % 2 == 0, F.lit(True))), events.filter(again)):
            kafka.messages(sinks.iso_times(part), feed).write.mode("append").parquet(topic)
            raw = readers.stream_parquet(replay.session, topic, "key binary, value binary")
            finish(fan_out.start_fan_out(raw, feed, f"{replay.folder}/out", f"{replay.folder}/checkpoint-{feed}"))
    out = fan_out.outputs(t.spark, f"{replay.folder}/out")
    zone, none = F.coalesce("zone_id", F.lit("-")), F.lit("-")
    kpis = {
        "kpi_orders_5min_tumbling": (none, "event_count", "orders_created", "orders_delivered", "avg_delivery_time_min"),
        "kpi_orders_10min_hop5": (zone, "event_count", "orders_created", "orders_delivered", "avg_delivery_time_min"),
        "kpi_zone_health": (zone, "orders_awaiting_pickup", "couriers_dispatched", "supply_gap"),
        "kpi_anomaly_zones": (zone, "total_events", "anomaly_count", "avg_delivery_min", "anomaly_rate", "zone_flagged"),
    }
    rows = None
    for name in ("orders", "couriers"):
        copies = out[name].groupBy("event_id", "event_time").agg(F.count("*").alias("copies"))
        one = _long(copies, name, "event_time", F.col("event_id"), "copies")
        rows = one if rows is None else rows.unionByName(one)
    for name, (key, *metrics) in kpis.items():
        rows = rows.unionByName(_long(out[name], name, "window_start", key, *metrics))
    return rows


# Data quality and service analytics


@query("schema_violations")
def _(t):
    return quality.schema_violations(t.dirty_orders, quality.REQUIRED_ORDER_FIELDS, C.ORDER_EVENT_TYPES)


@query("late_events")
def _(t):
    return rounded(quality.late_events(t.orders, t.couriers), "p50_delay_s", "p95_delay_s")


@query("duplicate_events")
def _(t):
    return quality.duplicate_events(t.orders)


@query("out_of_order")
def _(t):
    return quality.out_of_order(t.orders, key="restaurant_id")


@query("out_of_order_per_order")
def _(t):
    return quality.out_of_order(t.orders)


@query("out_of_order_swapped")
def _(t):
    return quality.out_of_order(feeds.harder(t.orders))


@query("out_of_order_stream")
def _(t):
    replay = t.replay()
    slices = time_slices(feeds.harder(t.orders), "ingestion_time", 3)
    return replay.in_slices(ORDER_FEED, slices, lambda orders: out_of_order_stream(orders, buckets=BUCKETS))[0]


@query("missing_steps")
def _(t):
    return quality.missing_steps(t.orders)


@query("impossible_durations")
def _(t):
    return quality.impossible_durations(t.orders, t.couriers)


@query("offline_mid_delivery")
def _(t):
    return quality.offline_mid_delivery(t.couriers)


@query("outlier_prep_times")
def _(t):
    return quality.outlier_prep_times(t.orders, whisker=0.25)


@query("unassigned_orders")
def _(t):
    return quality.unassigned_orders(t.orders, t.couriers)


@query("prep_sla")
def _(t):
    return rounded(quality.prep_sla(t.orders), "p50_prep_min", "p95_prep_min")


@query("dispatch_latency")
def _(t):
    return quality.dispatch_latency(t.orders, t.couriers)


@query("orders_per_hour")
def _(t):
    return windows.orders_per_hour(t.orders)


@query("courier_availability")
def _(t):
    return quality.courier_availability(t.couriers)


@query("shift_coverage")
def _(t):
    return quality.shift_coverage(t.couriers)


@query("route_performance")
def _(t):
    return quality.route_performance(t.couriers, t.matrix)


@query("zone_congestion")
def _(t):
    return quality.zone_congestion(t.orders, t.couriers)


# Enrichment


@query("demand_factor")
def _(t):
    created = t.orders.filter(X.event_is("order_created"))
    at = F.col("event_time")
    return created.select(
        "event_id",
        F.round(enrich.demand_factor(at, feeds.HOLIDAYS), 9).alias("demand_factor"),
        F.round(enrich.step_demand_factor(at, feeds.HOLIDAYS), 9).alias("step_factor"),
    )


@query("user_cancel_risk")
def _(t):
    created = t.orders.filter(X.event_is("order_created"))
    routed = enrich.route_lookup(created, t.matrix, "restaurant_zone_id", "user_zone_id")
    risk = enrich.user_cancel_risk(
        F.col("actual_prep_time"), F.col("estimated_delivery_time"), F.col("user_cancel_sensitivity")
    )
    return routed.select("event_id", risk.alias("cancel_risk"))


@query("courier_cancel_risk")
def _(t):
    assigned = t.couriers.filter(X.event_is("courier_assigned_order"))
    routed = enrich.route_lookup(assigned, t.matrix, "courier_zone_id", "restaurant_zone_id")
    risk = enrich.courier_cancel_risk(
        F.col("zone_hops_to_restaurant"), F.col("mean_time_min"), F.col("pickup_cancel_factor")
    )
    return routed.select("event_id", risk.alias("cancel_risk"))


@query("restaurant_cancel_risk")
def _(t):
    ready = t.orders.filter(X.event_is("order_ready_for_pickup"))
    return ready.select("event_id", enrich.restaurant_cancel_risk(F.col("actual_prep_time")).alias("cancel_risk"))


@query("expected_eta")
def _(t):
    created = t.orders.filter(X.event_is("order_created"))
    routed = enrich.route_lookup(created, t.matrix, "restaurant_zone_id", "user_zone_id")
    eta = enrich.expected_eta(F.col("mean_time_min"), F.col("base_delay_probability"))
    return routed.select("event_id", eta.alias("expected_eta_min"))


@query("backfill_category")
def _(t):
    return enrich.backfill_category(t.orders).select("event_id", "event_type", "order_id", "restaurant_category")


def _multipliers(t):
    return enrich.match_multipliers(feeds.match_effects(t.read("nation")), t.zones)


@query("match_multiplier")
def _(t):
    return enrich.match_multiplier(t.orders, _multipliers(t))


@query("restaurant_weight")
def _(t):
    weights = enrich.restaurant_weights(t.restaurants, _multipliers(t), PROMO_CATEGORIES)
    return weights.withColumns({"weight": F.round("weight", 9), "zone_share": F.round("zone_share", 9)})


@query("restaurant_weight_at")
def _(t):
    # the hours of the first three days in which an order was made
    made = t.orders.filter(F.col("event_type") == "order_created").select(X.time_bucket("event_time", 60).alias("at"))
    at = made.filter(F.col("at") < F.lit("2024-01-04 00:00:00+00:00").cast("timestamp")).distinct()
    hours = enrich.promotion_hours(feeds.promotions(t.read("nation")))
    weights = enrich.restaurant_weights_at(t.restaurants, _multipliers(t), hours, at)
    return weights.withColumns({"weight": F.round("weight", 9), "zone_share": F.round("zone_share", 9)})


@query("prep_pressure")
def _(t):
    return enrich.prep_pressure(t.orders, t.restaurants)


@query("zone_demand_share")
def _(t):
    shares = enrich.zone_demand_share(t.zones, SHARE_DAY, feeds.HOLIDAYS)
    return shares.withColumn("spawn_share", F.round("spawn_share", 9))


@query("match_day_tag")
def _(t):
    return enrich.match_day_tag(t.orders, enrich.match_minutes(feeds.match_schedule(t.read("nation"))))
