"""Broken and late events in a part of their own, and the counts of every micro-batch in a table.

A micro-batch is written once, with the names of the rules that each row breaks; rows that break any
lie in ``quarantined=true``, so a reader of the kept rows opens none of them. The counts are observed on the way,
without another pass. Everything has a folder for each batch id that is overwritten as a whole: a batch that is
run again after a crash replaces what it wrote, and rows read are always rows kept plus rows quarantined.

Lateness is judged by the row alone (arrival after event time), so a replay gives the same rows
in any order of arrival, and rows that a watermark would drop without a trace are kept with their reason.

Defined cases: a row may break several rules and counts under each; a row without one of both times is not
late; equal rows are judged alike; a batch without rows has a row of zero counts.
"""

from contextlib import contextmanager

from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ordertide.functions.columns import count_if
from ordertide.sources.readers import read_parquet_prefix

LATE, UNKNOWN = "late", "unknown event_type"
#: Seconds after its event time at which an event counts as late.
DELAY = 15 * 60
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def rule_names(required):
    return [*(f"missing {name}" for name in required), UNKNOWN, LATE]


def with_reasons(events, required, known_types, delay=DELAY):
    """The events with ``reasons``, the sorted names of the rules that each breaks."""
    checks = [F.col(name).isNull() for name in required]
    checks.append(~F.col("event_type").isin(*known_types))
    checks.append(F.unix_micros("ingestion_time") - F.unix_micros("event_time") > delay * 1_000_000)
    broken = [F.when(check, F.lit(rule)) for check, rule in zip(checks, rule_names(required))]
    return events.withColumn("reasons", F.array_sort(F.array_compact(F.array(*broken))))


@contextmanager
def _unsorted(spark):
    """Both parts of a task are written at once; without this a task sorts all of its rows by part in memory first."""
    before = spark.conf.get(_WRITERS)
    spark.conf.set(_WRITERS, "2")
    try:
        yield
    finally:
        spark.conf.set(_WRITERS, before)


def batch_writer(output, required, known_types, delay=DELAY):
    """The function that writes one micro-batch and its counts."""
    names = rule_names(required)

    def write(rows, batch_id):
        spark, seen = rows.sparkSession, Observation()
        judged = with_reasons(rows, required, known_types, delay).withColumn("quarantined", F.size("reasons") > 0)
        metrics = [count_if(F.array_contains("reasons", rule)).alias(f"rule_{i}") for i, rule in enumerate(names)]
        judged = judged.observe(seen, F.count("*").alias("read"), count_if(F.col("quarantined")).alias("bad"), *metrics)
        with _unsorted(spark):
            judged.write.mode("overwrite").partitionBy("quarantined").parquet(f"{output}/events/batch_id={batch_id}")
        found = seen.get
        counts = [("read", found["read"]), ("kept", found["read"] - found["bad"]), ("quarantined", found["bad"])]
        counts += [(rule, found[f"rule_{i}"]) for i, rule in enumerate(names)]
        table = spark.createDataFrame(counts, "what string, events long").coalesce(1)
        table.write.mode("overwrite").parquet(f"{output}/counts/batch_id={batch_id}")

    return write


def start_quarantine(events, output, checkpoint, required, known_types, delay=DELAY, interval=None):
    """Start the query over decoded events; without an interval it takes what is there and ends."""
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    writer = events.writeStream.foreachBatch(batch_writer(output, required, known_types, delay))
    return writer.queryName("quarantine").option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _written(spark, output, schema, quarantined):
    place = StructType.fromDDL("reasons array<string>, batch_id bigint, quarantined boolean")
    rows = read_parquet_prefix(spark, f"{output}/events", StructType([*schema.fields, *place.fields]))
    return rows.filter(F.col("quarantined") == quarantined).drop("batch_id", "quarantined")


def kept(spark, output, schema):
    """The events that break no rule; other folders are not opened."""
    return _written(spark, output, schema, False).drop("reasons")


def quarantined(spark, output, schema):
    """The events that break a rule, with ``reasons``."""
    return _written(spark, output, schema, True)


def counts(spark, output):
    """batch_id, what (read, kept, quarantined, or a rule) and events."""
    return read_parquet_prefix(spark, f"{output}/counts", "what string, events long, batch_id bigint")
