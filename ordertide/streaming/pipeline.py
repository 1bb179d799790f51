"""The six streaming queries of the platform, each with its own sink and checkpoint."""

from ordertide.functions.columns import day_of
from ordertide.operators.windows import anomaly_zones, orders_hopping_kpi, orders_tumbling_kpi, zone_health
from ordertide.schemas import COURIER_FEED, ORDER_FEED
from ordertide.session import check_stream_session
from ordertide.sources.decode import decode_feed
from ordertide.streaming.dedup import dedup_watermark
from ordertide.streaming.sinks import start_parquet


def read_events(raw, feed, delay="15 minutes"):
    """A topic's payloads as typed events without repeated event ids."""
    return dedup_watermark(decode_feed(raw, feed), delay)


def kpi_streams(orders, couriers, hopping_orders=None, marked=False):
    """The two raw feeds and the four KPIs by sink name.

    ``marked`` feeds carry their watermark already. The hopping KPI waits longer for
    late events than the others, so it may be given its own order feed.
    """
    own = {"delay": None} if marked else {}
    return {
        "orders": orders,
        "couriers": couriers,
        "kpi_orders_5min_tumbling": orders_tumbling_kpi(orders, **own),
        "kpi_orders_10min_hop5": orders_hopping_kpi(orders if hopping_orders is None else hopping_orders, **own),
        "kpi_zone_health": zone_health(orders, couriers, **own),
        "kpi_anomaly_zones": anomaly_zones(orders, **own),
    }


def start_pipeline(order_topic, courier_topic, output, checkpoints, interval="10 seconds"):
    """Start every query on two topics; without an interval each ends when it has caught up.

    The topics are read by a session of ``stream_session``, whose state store and number of state
    partitions all queries then have.
    """
    check_stream_session(order_topic.sparkSession)
    orders = read_events(order_topic, ORDER_FEED)
    couriers = read_events(courier_topic, COURIER_FEED)
    hopping = read_events(order_topic, ORDER_FEED, "20 minutes")
    streams = kpi_streams(orders, couriers, hopping, marked=True)
    # the archive keeps every event, however late; copies go when it is read (finalise_events)
    streams |= {"orders": decode_feed(order_topic, ORDER_FEED), "couriers": decode_feed(courier_topic, COURIER_FEED)}
    return start_all(streams, output, checkpoints, interval, by_date=True)


def start_all(streams, output, checkpoints, interval=None, by_date=False):
    """Start each stream into a folder of its name, raw feeds by event date if asked."""
    queries = {}
    for name, stream in streams.items():
        dates = ()
        if by_date and "event_time" in stream.columns:
            stream, dates = stream.withColumn("event_date", day_of("event_time")), ("event_date",)
        queries[name] = start_parquet(stream, f"{output}/{name}", f"{checkpoints}/{name}", interval, name, dates)
    return queries


def stop_all(queries):
    for query in queries.values():
        query.stop()
