"""Event names, thresholds and rates of the delivery data model."""

# Order life-cycle event types.
ORDER_EVENT_TYPES = [
    "order_created",
    "order_confirmed",
    "order_preparing",
    "order_ready_for_pickup",
    "order_picked_up",
    "order_delivered",
    "order_cancelled_user",
    "order_cancelled_restaurant",
    "order_cancelled_system",
]

# Courier event types.
COURIER_EVENT_TYPES = [
    "courier_online",
    "courier_offline",
    "courier_location_update",
    "courier_assigned_order",
    "courier_arrived_restaurant",
    "courier_pickup_completed",
    "courier_arrived_customer_zone",
    "courier_delivery_completed",
    "courier_abandoned_delivery",
    "courier_reassigned",
    "courier_offline_mid_delivery",
]

# Which cancellations the KPIs count. A system cancellation is
# not among them; pass ``cancel_types=ALL_CANCEL_TYPES`` to include it.
CANCEL_TYPES = ["order_cancelled_user", "order_cancelled_restaurant"]
ALL_CANCEL_TYPES = CANCEL_TYPES + ["order_cancelled_system"]

# Labels of the event log.
EVENT_LABELS = {
    "order_created": "Created",
    "order_confirmed": "Confirmed",
    "order_preparing": "Preparing",
    "order_ready_for_pickup": "Ready for pickup",
    "order_picked_up": "Picked up",
    "order_delivered": "Delivered",
    "courier_assigned_order": "Assigned",
    "courier_arrived_restaurant": "At restaurant",
    "courier_pickup_completed": "Pickup done",
    "courier_arrived_customer_zone": "At customer",
    "courier_delivery_completed": "Delivery done",
}

# Service levels and windows.
SLA_MINUTES = 45.0
ON_TIME_TARGET_PCT = 80.0
ANOMALY_RATE_THRESHOLD = 0.05
BUCKET_MINUTES = 15

# Revenue estimate.
AVG_ORDER_VALUE_EUR = 18.0
DELIVERY_DAY_HOURS = 16.0

# Demand curve (minutes of the day, multipliers at range centre).
LUNCH_WINDOW = ("12:00", "14:30")
DINNER_WINDOW = ("19:30", "22:00")
LUNCH_PEAK_MINUTE = 795
DINNER_PEAK_MINUTE = 1245
PEAK_SIGMA_MINUTES = 75.0
LUNCH_MULTIPLIER = 2.5
DINNER_MULTIPLIER = 2.2
WEEKEND_MULTIPLIER = 1.3
HOLIDAY_MULTIPLIER = 1.45
BASE_ORDERS_PER_MINUTE = 3.0
SPAWN_SCALE = 0.15
SPAWN_CAP = 0.99

# Route used when a zone pair is not in the travel matrix.
DEFAULT_ROUTE = {
    "mean_time_min": 8.0,
    "hop_count": 0,
    "base_delay_probability": 0.06,
    "pickup_cancel_factor": 1.0,
    "user_cancel_sensitivity": 0.9,
}

# Restaurant weight factors.
SECONDARY_MATCH_FACTOR = 0.85
PROMO_WEIGHT = 1.25
SENSITIVITY_WEIGHT = {"high": 1.2, "low": 0.9}

# Text forms read as true.
TRUE_WORDS = ["true", "1", "yes"]

# Which events may follow which stage of an order; None is an order not seen before.
TRANSITIONS = {
    None: ["order_created"],
    "order_created": ["order_confirmed", "order_cancelled_user"],
    "order_confirmed": ["order_preparing"],
    "order_preparing": ["order_ready_for_pickup", "order_cancelled_restaurant"],
    "order_ready_for_pickup": ["order_picked_up", "order_cancelled_system"],
    "order_picked_up": ["order_delivered"],
    "order_delivered": [],
    "order_cancelled_user": [],
    "order_cancelled_restaurant": [],
    "order_cancelled_system": [],
}
