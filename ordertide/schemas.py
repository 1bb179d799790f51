"""Event schemas: the wire form (text times) and the typed canonical form."""

import json

from pyspark.sql import types as T

from ordertide.constants import COURIER_EVENT_TYPES, ORDER_EVENT_TYPES

ORDER_FEED = "order_lifecycle"
COURIER_FEED = "courier_operations"

_COMMON = [("event_id", "string"), ("event_type", "string"), ("event_version", "string")]
_TIMES = ["event_time", "ingestion_time"]
_EPOCHS = [("event_time_epoch_ms", "bigint"), ("ingestion_time_epoch_ms", "bigint")]
_LATENESS = [("is_late_event", "boolean"), ("event_delay_seconds", "double")]

_ORDER_BODY = [
    ("order_id", "string"),
    ("user_id", "string"),
    ("restaurant_id", "string"),
    ("courier_id", "string"),
    ("user_zone_id", "string"),
    ("restaurant_zone_id", "string"),
    ("estimated_prep_time", "double"),
    ("actual_prep_time", "double"),
    ("estimated_delivery_time", "double"),
    ("actual_delivery_time", "double"),
    ("promo_applied", "string"),
    ("restaurant_category", "string"),
    ("match_day_flag", "boolean"),
    ("holiday_flag", "boolean"),
    ("anomaly_flag", "boolean"),
]

_COURIER_BODY = [
    ("courier_id", "string"),
    ("courier_zone_id", "string"),
    ("order_id", "string"),
    ("restaurant_id", "string"),
    ("restaurant_zone_id", "string"),
    ("user_zone_id", "string"),
    ("shift_id", "string"),
    ("courier_status", "string"),
    ("zone_hops_to_restaurant", "double"),
    ("zone_hops_to_user", "double"),
    ("estimated_travel_time", "double"),
    ("actual_travel_time", "double"),
    ("offline_reason", "string"),
]


_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def _struct(fields):
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


def _schema(body, time_type, epochs):
    times = [(name, time_type) for name in _TIMES]
    return _struct(_COMMON + times + body + _LATENESS + (_EPOCHS if epochs else []))


ORDER_WIRE = _schema(_ORDER_BODY, "string", epochs=True)
COURIER_WIRE = _schema(_COURIER_BODY, "string", epochs=True)
ORDER_EVENTS = _schema(_ORDER_BODY, "timestamp", epochs=False)
COURIER_EVENTS = _schema(_COURIER_BODY, "timestamp", epochs=False)

ZONES = _struct(
    [
        ("zone_id", "string"),
        ("district", "string"),
        ("population", "int"),
        ("spawn_probability", "double"),
        ("centroid_x", "double"),
        ("centroid_y", "double"),
        ("centrality_weight", "double"),
    ]
)
RESTAURANTS = _struct(
    [
        ("restaurant_id", "string"),
        ("name", "string"),
        ("zone_id", "string"),
        ("district", "string"),
        ("category", "string"),
        ("price_level", "int"),
        ("base_prep_time_mean_min", "double"),
        ("base_prep_time_std_min", "double"),
        ("capacity_tier", "string"),
        ("has_consistent_promo", "string"),
        ("promo_pattern", "string"),
        ("matchday_sensitivity", "string"),
        ("latency_pressure_factor", "double"),
    ]
)
TRAVEL_MATRIX = _struct(
    [
        ("zone_from", "string"),
        ("zone_to", "string"),
        ("district_from", "string"),
        ("district_to", "string"),
        ("hop_count", "int"),
        ("distance_index", "double"),
        ("mean_time_min", "double"),
        ("std_dev_min", "double"),
        ("base_delay_probability", "double"),
        ("pickup_cancel_factor", "double"),
        ("user_cancel_sensitivity", "double"),
        ("same_zone", "string"),
    ]
)
MATCH_EFFECTS = _struct(
    [
        ("event_type", "string"),
        ("home_team", "string"),
        ("primary_district", "string"),
        ("secondary_district", "string"),
        ("category", "string"),
        ("demand_multiplier", "double"),
    ]
)
ADJACENCY = _struct([("district", "string"), ("adjacent_district", "string")])

# The binary record layout of each feed, in field order. A kind
# ending in "?" is a union of null and that kind; "enum" is the event-type enum.
ORDER_RECORD = [
    ("event_id", "string"),
    ("event_type", "enum"),
    ("event_version", "string"),
    ("event_time", "long"),
    ("ingestion_time", "long"),
    ("is_late_event", "boolean"),
    ("event_delay_seconds", "int?"),
    ("order_id", "string"),
    ("user_id", "string"),
    ("restaurant_id", "string"),
    ("courier_id", "string?"),
    ("user_zone_id", "string"),
    ("restaurant_zone_id", "string"),
    ("estimated_prep_time", "int?"),
    ("actual_prep_time", "int?"),
    ("estimated_delivery_time", "int?"),
    ("actual_delivery_time", "int?"),
    ("promo_applied", "string?"),
    ("restaurant_category", "string"),
    ("match_day_flag", "boolean"),
    ("holiday_flag", "boolean"),
    ("anomaly_flag", "boolean"),
]
COURIER_RECORD = [
    ("event_id", "string"),
    ("event_type", "enum"),
    ("event_version", "string"),
    ("event_time", "long"),
    ("ingestion_time", "long"),
    ("is_late_event", "boolean"),
    ("event_delay_seconds", "int?"),
    ("courier_id", "string"),
    ("courier_zone_id", "string"),
    ("order_id", "string?"),
    ("restaurant_id", "string?"),
    ("restaurant_zone_id", "string?"),
    ("user_zone_id", "string?"),
    ("shift_id", "string"),
    ("courier_status", "string"),
    ("zone_hops_to_restaurant", "int?"),
    ("zone_hops_to_user", "int?"),
    ("estimated_travel_time", "int?"),
    ("actual_travel_time", "int?"),
    ("offline_reason", "string?"),
]

_AVRO_DEFAULTS = {"event_version": "1.0"}


def record_symbols(record):
    return ORDER_EVENT_TYPES if record is ORDER_RECORD else COURIER_EVENT_TYPES


def record_struct(record):
    """Spark struct of a decoded binary record."""
    kinds = {"string": "string", "enum": "string", "long": "bigint", "int": "int", "boolean": "boolean"}
    return _struct([(name, kinds[kind.rstrip("?")]) for name, kind in record])


def avro_schema(record):
    """Avro schema text of a record, for the Spark Avro connector."""
    fields = []
    for name, kind in record:
        if kind == "enum":
            kind_json = {"type": "enum", "name": "EventType", "symbols": record_symbols(record)}
        elif kind.endswith("?"):
            kind_json = ["null", kind[:-1]]
        else:
            kind_json = kind
        field = {"name": name, "type": kind_json}
        if kind.endswith("?"):
            field["default"] = None
        elif kind == "boolean":
            field["default"] = False
        elif name in _AVRO_DEFAULTS:
            field["default"] = _AVRO_DEFAULTS[name]
        fields.append(field)
    name = "OrderEvent" if record is ORDER_RECORD else "CourierEvent"
    return json.dumps({"type": "record", "name": name, "fields": fields})
