"""Broker payloads and raw rows to typed event feeds."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertide.functions.columns import to_time
from ordertide.operators.tables import dedup_first
from ordertide.schemas import (
    COURIER_EVENTS,
    COURIER_FEED,
    COURIER_RECORD,
    COURIER_WIRE,
    ORDER_EVENTS,
    ORDER_FEED,
    ORDER_RECORD,
    ORDER_WIRE,
)
from ordertide.sources.avro_wire import decode_avro

FEEDS = {
    ORDER_FEED: (ORDER_WIRE, ORDER_EVENTS, ORDER_RECORD),
    COURIER_FEED: (COURIER_WIRE, COURIER_EVENTS, COURIER_RECORD),
}


def decode_json(raw, schema):
    """JSON payloads to rows of the wire schema; rows without an event id are dropped."""
    # Dropping inside the generator keeps the payload from being parsed a second time for a filter.
    parsed = F.array(F.from_json(F.col("value").cast("string"), schema))
    return raw.select(F.inline(F.filter(parsed, lambda d: d["event_id"].isNotNull())))


def avro_times(rows):
    """Epoch milliseconds of a decoded record to timestamps, keeping the numbers."""
    return rows.withColumns(
        {
            "event_time_epoch_ms": F.col("event_time"),
            "ingestion_time_epoch_ms": F.col("ingestion_time"),
            "event_time": F.timestamp_millis("event_time"),
            "ingestion_time": F.timestamp_millis("ingestion_time"),
        }
    )


def decode_avro_rows(raw, record):
    """Avro payloads to rows; malformed payloads and rows without an event id are dropped."""
    decoded = raw.select(decode_avro(raw.sparkSession, F.col("value"), record).alias("d")).select("d.*")
    return avro_times(decoded.filter(F.col("event_id").isNotNull()))


def align_schema(df, schema):
    """The columns of ``schema`` in its order: cast where present, null where missing."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def union_formats(first, second, schema):
    """Rows of two decoders under one schema."""
    return align_schema(first, schema).unionByName(align_schema(second, schema))


def with_epochs(events):
    """Epoch milliseconds of both times, derived from the timestamps."""
    return events.withColumns(
        {
            "event_time_epoch_ms": F.unix_millis("event_time"),
            "ingestion_time_epoch_ms": F.unix_millis("ingestion_time"),
        }
    )


def typed_times(df):
    """Text times to timestamps; text that cannot be read becomes null."""
    return df.withColumns({name: to_time(name) for name in ("event_time", "ingestion_time")})


def decode_feed(raw, feed):
    """Payloads of one topic, JSON and Avro mixed, to the typed feed in one read.

    Only payloads that are not JSON reach the Avro decoder. The generators stand where
    a plain projection or filter would be merged with its neighbours and make Spark
    decode a payload once per column.
    """
    wire, events, record = FEEDS[feed]
    text = F.from_json(F.col("value").cast("string"), wire)
    parsed = raw.select("value", F.explode(F.array(text)).alias("j"))
    binary = F.when(F.col("j.event_id").isNull(), F.col("value"))
    parsed = parsed.select("j", decode_avro(raw.sparkSession, binary, record).alias("a"))

    def either(field):
        if field.dataType == T.TimestampType():
            other = F.timestamp_millis(F.col(f"a.{field.name}"))
        else:
            other = F.col(f"a.{field.name}").cast(field.dataType)
        own = F.col(f"j.{field.name}").try_cast(field.dataType)
        return F.when(F.col("j.event_id").isNotNull(), own).otherwise(other).alias(field.name)

    row = F.array(F.struct(*[either(f) for f in events.fields]))
    return parsed.select(F.inline(F.filter(row, lambda d: d["event_id"].isNotNull())))


def finalise_events(df):
    """Typed times and the first row of each event id, as the KPIs expect them."""
    return dedup_first(typed_times(df))
