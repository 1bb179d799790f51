"""Topic source and sink options for a Kafka-compatible broker."""

from pyspark.sql import functions as F

from ordertide.schemas import ORDER_FEED
from ordertide.sources.avro_wire import encode_avro
from ordertide.sources.decode import FEEDS
from ordertide.sources.sinks import record_struct_column, to_avro_record, with_epoch_ms


def _security(user, password):
    login = "org.apache.kafka.common.security.plain.PlainLoginModule"
    return {
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": f'{login} required username="{user}" password="{password}";',
    }


def source_options(servers, topic, user=None, password=None, max_offsets=None):
    """Read the whole history of a topic and go on when the broker has dropped data."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "kafka.request.timeout.ms": "60000",
        "kafka.session.timeout.ms": "30000",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    if user:
        options.update(_security(user, password))
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def sink_options(servers, topic, user=None, password=None):
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    if user:
        options.update(_security(user, password))
    return options


def read_topic(spark, options):
    """Streaming rows of a topic with their ``value`` bytes."""
    return spark.readStream.format("kafka").options(**options).load()


def messages(events, feed, payload="json"):
    """Key and value of one message per event; the key keeps an order's events together."""
    record = FEEDS[feed][2]
    key = F.coalesce("order_id", "event_id") if feed == ORDER_FEED else F.coalesce("courier_id", "event_id")
    if payload == "avro":
        # the key is taken before blanks stand in for missing ids
        kept = events.withColumn("_key", key.cast("binary"))
        rows = to_avro_record(kept, feed, "_key").select(F.col("_key").alias("key"), record_struct_column(record).alias("row"))
        return rows.select("key", encode_avro(events.sparkSession, F.col("row"), record).alias("value"))
    rows = with_epoch_ms(events)
    return rows.select(key.cast("binary").alias("key"), F.to_json(F.struct(*rows.columns)).cast("binary").alias("value"))


def publish(stream_messages, options, checkpoint):
    """Send a stream of messages to a topic."""
    return (
        stream_messages.writeStream.format("kafka")
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .start()
    )
