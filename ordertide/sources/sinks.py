"""Batch writers and the record forms they write."""

from pyspark.sql import functions as F

from ordertide.functions.columns import day_of, epoch_ms, rounded_int
from ordertide.schemas import COURIER_RECORD, ORDER_FEED, ORDER_RECORD, record_symbols
from ordertide.sources.avro_wire import has_connector


def with_epoch_ms(events):
    """Epoch milliseconds of both times, 0 where a time cannot be read."""
    return events.withColumns(
        {
            "event_time_epoch_ms": epoch_ms("event_time"),
            "ingestion_time_epoch_ms": epoch_ms("ingestion_time"),
        }
    )


def iso_times(events):
    """Times as ISO text in UTC with milliseconds, the form of the JSON feed, whatever the session zone."""
    form = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
    kinds = dict(events.dtypes)

    def utc(name):  # in the session zone's clock, as date_format reads it
        return F.to_utc_timestamp(name, F.current_timezone()) if kinds[name] == "timestamp" else F.col(name)

    return events.withColumns({name: F.date_format(utc(name), form) for name in ("event_time", "ingestion_time")})


# Text that stands for a missing value in a binary record.
_RECORD_DEFAULTS = {"event_version": "1.0", "courier_status": "online"}


def to_avro_record(events, feed, *kept):
    """Events in the layout of the binary record of their feed, after the columns that are kept."""
    record = ORDER_RECORD if feed == ORDER_FEED else COURIER_RECORD
    defaults = {**_RECORD_DEFAULTS, "event_type": record_symbols(record)[0]}
    columns = list(kept)
    for name, kind in record:
        if kind == "long":
            value = epoch_ms(name)
        elif kind == "int?":
            value = rounded_int(name)
        elif kind == "boolean":
            value = F.coalesce(F.col(name).try_cast("boolean"), F.lit(False))
        elif kind == "string?":
            value = F.col(name)
        else:
            value = F.coalesce(F.col(name).cast("string"), F.lit(defaults.get(name, "")))
        columns.append(value.alias(name))
    return events.select(*columns)


def record_struct_column(record):
    return F.struct(*[name for name, _ in record])


def write_ndjson(events, path, max_per_file=10000, compression="gzip"):
    """JSON lines, at most so many per file; null fields are written out.

    Lines repeat all names, so files are compressed (``none`` leaves them plain); readers tell by the file's name.
    """
    (
        iso_times(with_epoch_ms(events))
        .write.option("maxRecordsPerFile", max_per_file)
        .option("ignoreNullFields", False)
        .option("compression", compression)
        .mode("errorifexists")
        .json(path)
    )


def write_records(events, feed, path, max_per_file=10000):
    """Binary records as Avro files, or as Parquet where Spark has no Avro module."""
    kind = "avro" if has_connector(events.sparkSession) else "parquet"
    records = to_avro_record(events, feed)
    records.write.format(kind).option("maxRecordsPerFile", max_per_file).mode("errorifexists").save(path)
    return kind


def write_events(events, path):
    """Parquet by event date, so that a reader of some days opens only those.

    Rows of a date are brought together first, and dates with very many rows are split
    again, which keeps the files few and of even size.
    """
    dated = events.withColumn("event_date", day_of("event_time")).hint("rebalance", "event_date")
    dated.write.partitionBy("event_date").mode("errorifexists").parquet(path)
