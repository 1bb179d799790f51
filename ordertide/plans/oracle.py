"""SQL with the same results as the registered queries, for another engine to run.

The feeds are derived from ``events`` by the same integer rules as in ``feeds``,
and every query is then written the plain way: self joins, percentiles of whole
groups and range joins, where the Spark side takes routes that scale.
"""

from ordertide.constants import ORDER_EVENT_TYPES, TRANSITIONS
from ordertide.operators.couriers import day_slots
from ordertide.operators.quality import REQUIRED_BEFORE_DELIVERY, REQUIRED_ORDER_FIELDS
from ordertide.plans.feeds import CATEGORIES

_ORDER_COLUMNS = """event_id, event_type, event_version, event_time, ingestion_time, order_id, user_id,
restaurant_id, courier_id, user_zone_id, restaurant_zone_id, estimated_prep_time, actual_prep_time,
estimated_delivery_time, actual_delivery_time, promo_applied, restaurant_category, match_day_flag,
holiday_flag, anomaly_flag, is_late_event, event_delay_seconds"""

_COURIER_COLUMNS = """event_id, event_type, event_version, event_time, ingestion_time, courier_id,
courier_zone_id, order_id, restaurant_id, restaurant_zone_id, user_zone_id, shift_id, courier_status,
zone_hops_to_restaurant, zone_hops_to_user, estimated_travel_time, actual_travel_time, offline_reason,
is_late_event, event_delay_seconds"""

_CTES = """
WITH base AS (
  SELECT event_id AS e, user_id AS u, event_type AS k, ts,
         5 + (event_id * 13) % 25 AS prep, 3 + (event_id * 17) % 50 AS trav,
         event_type IN ('click', 'signup', 'purchase') AS done, event_type = 'error' AS failed
  FROM events
), order_rows AS (
  SELECT *, ts + to_minutes(CASE
      WHEN variant IN ('confirmed', 'preparing') THEN 1
      WHEN variant IN ('ready', 'cancel_restaurant') THEN prep
      WHEN variant = 'cancel_system' THEN prep + 60
      WHEN variant = 'picked' THEN prep + 2
      WHEN variant = 'delivered' THEN prep + 2 + trav
      ELSE 0 END) AS event_time
  FROM base, (VALUES ('created', 0, 'order_created'), ('confirmed', 1, 'order_confirmed'),
      ('preparing', 2, 'order_preparing'), ('cancel_user', 3, 'order_cancelled_user'),
      ('cancel_restaurant', 3, 'order_cancelled_restaurant'), ('ready', 3, 'order_ready_for_pickup'),
      ('cancel_system', 4, 'order_cancelled_system'), ('picked', 4, 'order_picked_up'),
      ('delivered', 5, 'order_delivered'), ('logical_copy', 0, 'order_created'),
      ('exact_copy', 0, 'order_created')) s(variant, step, event_type)
  WHERE CASE variant
      WHEN 'created' THEN true
      WHEN 'confirmed' THEN NOT (failed AND e % 3 = 0)
      WHEN 'preparing' THEN NOT (failed AND e % 3 = 0)
      WHEN 'cancel_user' THEN failed AND e % 3 = 0
      WHEN 'cancel_restaurant' THEN failed AND e % 3 = 1
      WHEN 'ready' THEN NOT failed OR e % 3 = 2
      WHEN 'cancel_system' THEN failed AND e % 3 = 2
      WHEN 'picked' THEN done AND e % 100 <> 1
      WHEN 'delivered' THEN done
      WHEN 'logical_copy' THEN e % 200 = 0
      WHEN 'exact_copy' THEN e % 150 = 0 END
), ord AS (
  SELECT CASE WHEN variant = 'logical_copy' THEN 'EVT' || e ELSE 'E' || e || '-' || step END AS event_id,
         event_type, '1.0' AS event_version, event_time,
         event_time + to_seconds(CASE WHEN e % 50 = 0 THEN 10 + e % 291 ELSE 0 END) AS ingestion_time,
         'ORD' || lpad(CAST(e AS VARCHAR), 8, '0') AS order_id,
         'U' || lpad(CAST(u AS VARCHAR), 6, '0') AS user_id,
         'R' || (e % 10) AS restaurant_id,
         CASE WHEN variant IN ('picked', 'delivered') THEN 'C' || lpad(CAST((e * 7) % 40 AS VARCHAR), 5, '0') END AS courier_id,
         'Z' || lpad(CAST(u % 25 AS VARCHAR), 2, '0') AS user_zone_id,
         'Z' || lpad(CAST((e * 5 + u) % 25 AS VARCHAR), 2, '0') AS restaurant_zone_id,
         CAST(5 + (e * 11) % 25 AS DOUBLE) AS estimated_prep_time,
         CASE WHEN variant = 'delivered' AND e % 97 = 0 THEN -3e0 ELSE CAST(prep AS DOUBLE) END AS actual_prep_time,
         CAST(prep + trav + 5 AS DOUBLE) AS estimated_delivery_time,
         CASE WHEN variant = 'delivered' THEN CASE WHEN e % 97 = 0 THEN -7e0 ELSE CAST(trav AS DOUBLE) END END AS actual_delivery_time,
         CAST(NULL AS VARCHAR) AS promo_applied,
         CASE WHEN step = 0 THEN ['burger', 'pizza', 'mexican', 'sushi', 'fast_food', 'healthy', 'dessert'][e % 7 + 1] END AS restaurant_category,
         e % 7 = 3 AS match_day_flag,
         month(ts) * 100 + day(ts) IN (101, 106) AS holiday_flag,
         variant = 'delivered' AND e % 97 = 0 AS anomaly_flag,
         e % 50 = 0 AS is_late_event,
         CASE WHEN e % 50 = 0 THEN CAST(10 + e % 291 AS DOUBLE) END AS event_delay_seconds
  FROM order_rows
), courier_rows AS (
  SELECT *, ts + to_minutes(CASE
      WHEN step = 0 THEN 0 WHEN step = 1 THEN prep WHEN step = 2 THEN prep + 1 WHEN step = 3 THEN prep + 2
      WHEN step IN (4, 5, 6) THEN prep + 3 WHEN step = 7 THEN prep + 1 + trav ELSE prep + 2 + trav END) AS event_time
  FROM base, (VALUES (0, 'courier_online'), (1, 'courier_assigned_order'), (2, 'courier_arrived_restaurant'),
      (3, 'courier_pickup_completed'), (4, 'courier_offline_mid_delivery'), (5, 'courier_abandoned_delivery'),
      (6, 'courier_reassigned'), (7, 'courier_arrived_customer_zone'), (8, 'courier_delivery_completed')) s(step, event_type)
  WHERE CASE
      WHEN step = 0 THEN k = 'signup'
      WHEN step IN (1, 2, 3) THEN done
      WHEN step IN (4, 5) THEN done AND e % 100 = 2
      WHEN step = 6 THEN done AND e % 200 = 2
      ELSE done AND e % 200 <> 102 END
), cou AS (
  SELECT 'K' || e || '-' || step AS event_id, event_type, '1.0' AS event_version, event_time,
         event_time + to_seconds(CASE WHEN e % 50 = 0 THEN 10 + e % 291 ELSE 0 END) AS ingestion_time,
         'C' || lpad(CAST((e * 7) % 40 AS VARCHAR), 5, '0') AS courier_id,
         'Z' || lpad(CAST((e * 11) % 25 AS VARCHAR), 2, '0') AS courier_zone_id,
         CASE WHEN step <> 0 THEN 'ORD' || lpad(CAST(e AS VARCHAR), 8, '0') END AS order_id,
         CASE WHEN step <> 0 THEN 'R' || (e % 10) END AS restaurant_id,
         CASE WHEN step <> 0 THEN 'Z' || lpad(CAST((e * 5 + u) % 25 AS VARCHAR), 2, '0') END AS restaurant_zone_id,
         CASE WHEN step <> 0 THEN 'Z' || lpad(CAST(u % 25 AS VARCHAR), 2, '0') END AS user_zone_id,
         'S' || ((e * 7) % 40) || '-' || day(ts) AS shift_id,
         CASE WHEN step = 0 THEN 'online' WHEN step IN (4, 5) THEN 'offline' ELSE 'busy' END AS courier_status,
         CASE WHEN step = 1 THEN CAST((e * 5) % 6 AS DOUBLE) END AS zone_hops_to_restaurant,
         CASE WHEN step <> 0 THEN CAST((e * 3) % 6 AS DOUBLE) END AS zone_hops_to_user,
         CASE WHEN step = 1 THEN CAST(trav + 2 AS DOUBLE) END AS estimated_travel_time,
         CASE WHEN step = 2 THEN CAST(1 + e % 15 AS DOUBLE)
              WHEN step = 8 THEN CASE WHEN e % 499 = 0 THEN -5e0 ELSE CAST(trav AS DOUBLE) END END AS actual_travel_time,
         CASE WHEN step = 4 THEN 'technical_issue' WHEN step = 5 THEN 'courier_offline_mid_delivery' END AS offline_reason,
         e % 50 = 0 AS is_late_event,
         CASE WHEN e % 50 = 0 THEN CAST(10 + e % 291 AS DOUBLE) END AS event_delay_seconds
  FROM courier_rows
), zones AS (
  SELECT 'Z' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS zone_id, n_name AS district,
         CAST(100000 + n_nationkey * 1000 AS INTEGER) AS population,
         (n_nationkey + 1) / 256e0 AS spawn_probability, CAST(n_nationkey % 5 AS DOUBLE) AS centroid_x,
         CAST(n_nationkey // 5 AS DOUBLE) AS centroid_y, 1e0 - n_nationkey / 100e0 AS centrality_weight
  FROM nation
), rest AS (
  SELECT 'R' || s_suppkey AS restaurant_id, s_name AS name,
         'Z' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS zone_id, n_name AS district,
         ['burger', 'pizza', 'mexican', 'sushi', 'fast_food', 'healthy', 'dessert'][s_suppkey % 7 + 1] AS category,
         CAST(1 + s_suppkey % 3 AS INTEGER) AS price_level,
         CAST(8 + s_suppkey % 20 AS DOUBLE) AS base_prep_time_mean_min,
         CAST(2 + s_suppkey % 4 AS DOUBLE) AS base_prep_time_std_min,
         CASE WHEN s_suppkey % 2 = 0 THEN 'large' ELSE 'small' END AS capacity_tier,
         s_suppkey % 5 < 3 AS has_consistent_promo,
         CASE WHEN s_suppkey % 4 = 0 THEN 'weekly' ELSE 'none' END AS promo_pattern,
         ['high', 'medium', 'low'][s_suppkey % 3 + 1] AS matchday_sensitivity,
         (80 + s_suppkey % 50) / 100e0 AS latency_pressure_factor
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
), hops AS (
  SELECT a.n_nationkey AS a, b.n_nationkey AS b, a.n_name AS district_from, b.n_name AS district_to,
         least(abs(a.n_nationkey - b.n_nationkey), 25 - abs(a.n_nationkey - b.n_nationkey)) AS h
  FROM nation a, nation b WHERE (a.n_nationkey * 7 + b.n_nationkey) % 23 <> 0
), matrix AS (
  SELECT 'Z' || lpad(CAST(a AS VARCHAR), 2, '0') AS zone_from, 'Z' || lpad(CAST(b AS VARCHAR), 2, '0') AS zone_to,
         district_from, district_to, CAST(h AS INTEGER) AS hop_count, h * 5 / 4e0 AS distance_index,
         CAST(8 + h * 6 AS DOUBLE) AS mean_time_min, (4 + h) / 2e0 AS std_dev_min,
         (6 + h) / 100e0 AS base_delay_probability, (4 + h) / 4e0 AS pickup_cancel_factor,
         (9 + h) / 10e0 AS user_cancel_sensitivity, a = b AS same_zone
  FROM hops
), effects AS (
  SELECT 'match_day' AS event_type, 'Team ' || p.n_regionkey AS home_team, p.n_name AS primary_district,
         s.n_name AS secondary_district,
         ['burger', 'pizza', 'mexican', 'sushi', 'fast_food', 'healthy', 'dessert'][(p.n_nationkey // 2) % 7 + 1] AS category,
         (11 + p.n_nationkey % 8) / 10e0 AS demand_multiplier
  FROM nation p JOIN nation s ON s.n_nationkey = (p.n_nationkey + 1) % 25
), schedule AS (
  SELECT 'Z' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS primary_zone,
         'Z' || lpad(CAST((n_nationkey + 1) % 25 AS VARCHAR), 2, '0') AS secondary_zone,
         n_nationkey % 7 AS dow, 1320 + n_nationkey * 4 AS start_minute
  FROM nation WHERE n_nationkey % 5 = 0
), adjacent AS (
  SELECT a.n_name AS district, b.n_name AS adjacent_district
  FROM nation a JOIN nation b ON b.n_nationkey IN ((a.n_nationkey + 1) % 25, (a.n_nationkey + 5) % 25)
), dirty AS (
  SELECT * REPLACE (
      CASE WHEN CAST(substr(order_id, 4) AS BIGINT) % 31 <> 0 THEN user_id END AS user_id,
      CASE WHEN CAST(substr(order_id, 4) AS BIGINT) % 37 = 0 THEN 'order_teleported' ELSE event_type END AS event_type,
      CASE WHEN CAST(substr(order_id, 4) AS BIGINT) % 41 = 0 THEN 'not-a-time'
           ELSE strftime(event_time, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' END AS event_time,
      strftime(ingestion_time, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS ingestion_time),
    CASE WHEN CAST(substr(order_id, 4) AS BIGINT) % 41 <> 0 THEN date_trunc('milliseconds', event_time) END AS read_at
  FROM ord
), snap AS (
  SELECT * FROM ord WHERE event_time <= (SELECT max(event_time) FROM ord WHERE event_type = 'order_created')
), cd AS (
  SELECT c.order_id, c.event_time AS created_at, c.user_zone_id, d.event_time AS delivered_at,
         (epoch_us(d.event_time) - epoch_us(c.event_time)) / 6e7 AS full_delivery_min
  FROM ord c JOIN ord d USING (order_id)
  WHERE c.event_type = 'order_created' AND d.event_type = 'order_delivered' AND d.event_time > c.event_time
), zm AS (
  SELECT user_zone_id AS zone_id,
         count(*) FILTER (WHERE event_type = 'order_created') AS total_orders,
         count(*) FILTER (WHERE event_type = 'order_delivered') AS delivered_orders,
         count(*) FILTER (WHERE event_type IN ('order_cancelled_user', 'order_cancelled_restaurant')) AS cancelled_orders,
         count(*) FILTER (WHERE event_type IN ('order_cancelled_user', 'order_cancelled_restaurant'))
           / greatest(count(*) FILTER (WHERE event_type = 'order_created'), 1) * 100 AS cancellation_rate
  FROM ord WHERE event_type IN ('order_created', 'order_delivered', 'order_cancelled_user', 'order_cancelled_restaurant')
  GROUP BY 1
), zd AS (
  SELECT user_zone_id AS zone_id, avg(full_delivery_min) AS avg_full_delivery_min FROM cd GROUP BY 1
), zg AS (
  SELECT user_zone_id AS zone_id, count(*) AS delivered_orders, count(*) * 18e0 AS estimated_gmv_eur
  FROM ord WHERE event_type = 'order_delivered' GROUP BY 1
), rankings AS (
  SELECT zm.zone_id, coalesce(z.district, zm.zone_id) AS district, total_orders, avg_full_delivery_min,
         cancellation_rate, coalesce(estimated_gmv_eur, 0e0) AS estimated_gmv_eur
  FROM zm LEFT JOIN zd USING (zone_id) LEFT JOIN zg USING (zone_id) LEFT JOIN zones z USING (zone_id)
), ratio AS (
  SELECT bucket, zone_id, coalesce(o.n, 0) AS orders, coalesce(c.n, 0) AS couriers,
         coalesce(o.n, 0) / greatest(CAST(coalesce(c.n, 0) AS DOUBLE), 0.1e0) AS demand_courier_ratio
  FROM (SELECT time_bucket(INTERVAL '15 minutes', event_time) AS bucket, user_zone_id AS zone_id, count(*) AS n
        FROM ord WHERE event_type = 'order_created' GROUP BY 1, 2) o
  FULL JOIN (SELECT time_bucket(INTERVAL '15 minutes', event_time) AS bucket, courier_zone_id AS zone_id,
             count(DISTINCT courier_id) AS n FROM cou WHERE event_type = 'courier_assigned_order' GROUP BY 1, 2) c
  USING (bucket, zone_id)
), spine AS (
  SELECT s.bucket, coalesce(c.n, 0) AS orders_created, coalesce(d.n, 0) AS orders_delivered
  FROM (SELECT unnest(generate_series(min(b), max(b), INTERVAL '15 minutes')) AS bucket
        FROM (SELECT time_bucket(INTERVAL '15 minutes', event_time) AS b FROM ord WHERE event_type = 'order_created')) s
  LEFT JOIN (SELECT time_bucket(INTERVAL '15 minutes', event_time) AS bucket, count(*) AS n FROM ord
             WHERE event_type = 'order_created' GROUP BY 1) c USING (bucket)
  LEFT JOIN (SELECT time_bucket(INTERVAL '15 minutes', event_time) AS bucket, count(*) AS n FROM ord
             WHERE event_type = 'order_delivered' GROUP BY 1) d USING (bucket)
), category AS (
  SELECT order_id, max(restaurant_category) AS category FROM ord WHERE event_type = 'order_created' GROUP BY 1
), feed AS (
  SELECT 'order_lifecycle' AS feed, event_id, event_type, event_time, order_id, courier_id, is_late_event,
         event_delay_seconds FROM ord
  UNION ALL
  SELECT 'courier_operations', event_id, event_type, event_time, order_id, courier_id, is_late_event,
         event_delay_seconds FROM cou
), tumbling AS (
  SELECT time_bucket(INTERVAL '5 minutes', event_time) AS window_start,
         time_bucket(INTERVAL '5 minutes', event_time) + INTERVAL '5 minutes' AS window_end,
         count(*) AS event_count, count(*) FILTER (WHERE event_type = 'order_created') AS orders_created,
         count(*) FILTER (WHERE event_type = 'order_delivered') AS orders_delivered,
         avg(actual_delivery_time) AS avg_delivery_time_min
  FROM ord GROUP BY 1, 2
), hopping AS (
  SELECT w AS window_start, w + INTERVAL '10 minutes' AS window_end, user_zone_id AS zone_id,
         count(*) AS event_count, count(*) FILTER (WHERE event_type = 'order_created') AS orders_created,
         count(*) FILTER (WHERE event_type = 'order_delivered') AS orders_delivered,
         avg(actual_delivery_time) AS avg_delivery_time_min
  FROM (SELECT *, unnest([time_bucket(INTERVAL '5 minutes', event_time),
                          time_bucket(INTERVAL '5 minutes', event_time) - INTERVAL '5 minutes']) AS w FROM ord)
  GROUP BY 1, 2, 3
), waiting AS (
  SELECT time_bucket(INTERVAL '5 minutes', event_time) AS window_start,
         time_bucket(INTERVAL '5 minutes', event_time) + INTERVAL '5 minutes' AS window_end,
         restaurant_zone_id AS zone_id, count(*) AS orders_awaiting_pickup
  FROM ord WHERE event_type = 'order_ready_for_pickup' GROUP BY 1, 2, 3
), dispatched AS (
  SELECT time_bucket(INTERVAL '5 minutes', event_time) AS window_start,
         time_bucket(INTERVAL '5 minutes', event_time) + INTERVAL '5 minutes' AS window_end,
         courier_zone_id AS zone_id, count(*) AS couriers_dispatched
  FROM cou WHERE event_type = 'courier_assigned_order' GROUP BY 1, 2, 3
), health AS (
  SELECT w.window_start, w.window_end, w.zone_id, orders_awaiting_pickup,
         coalesce(couriers_dispatched, 0) AS couriers_dispatched,
         orders_awaiting_pickup - coalesce(couriers_dispatched, 0) AS supply_gap
  FROM waiting w LEFT JOIN dispatched d ON w.window_start = d.window_start AND w.zone_id = d.zone_id
), anomaly AS (
  SELECT *, anomaly_count / total_events AS anomaly_rate,
         avg_delivery_min > 45e0 OR anomaly_count / total_events > 0.05e0 AS zone_flagged
  FROM (SELECT time_bucket(INTERVAL '5 minutes', event_time) AS window_start,
               time_bucket(INTERVAL '5 minutes', event_time) + INTERVAL '5 minutes' AS window_end,
               user_zone_id AS zone_id, count(*) AS total_events,
               count(*) FILTER (WHERE anomaly_flag) AS anomaly_count, avg(actual_delivery_time) AS avg_delivery_min
        FROM ord GROUP BY 1, 2, 3)
), hourly AS (
  SELECT time_bucket(INTERVAL '1 hour', event_time) AS window_start,
         time_bucket(INTERVAL '1 hour', event_time) + INTERVAL '1 hour' AS window_end,
         count(*) FILTER (WHERE event_type = 'order_created') AS orders_created,
         count(*) FILTER (WHERE event_type = 'order_delivered') AS orders_delivered,
         count(*) FILTER (WHERE event_type LIKE 'order_cancelled%') AS orders_cancelled,
         count(*) FILTER (WHERE event_type LIKE 'order_cancelled%')
           / greatest(count(*) FILTER (WHERE event_type = 'order_created'), 1) * 100 AS cancellation_rate_pct
  FROM ord GROUP BY 1, 2
), interval_join AS (
  SELECT r.order_id, r.restaurant_zone_id AS zone_id, a.courier_id, r.event_time AS ready_at, a.event_time AS assigned_at,
         (epoch_us(a.event_time) - epoch_us(r.event_time)) / 6e7 AS dispatch_min
  FROM ord r JOIN cou a ON r.order_id = a.order_id AND a.event_time >= r.event_time
    AND a.event_time <= r.event_time + INTERVAL '30 minutes'
  WHERE r.event_type = 'order_ready_for_pickup' AND a.event_type = 'courier_assigned_order'
), session_rows AS (
  SELECT *, sum(fresh) OVER (PARTITION BY courier_id ORDER BY event_time ROWS UNBOUNDED PRECEDING) AS session
  FROM (SELECT *, CASE WHEN event_time - lag(event_time) OVER (PARTITION BY courier_id ORDER BY event_time)
                  <= INTERVAL '30 minutes' THEN 0 ELSE 1 END AS fresh FROM cou)
), sessions AS (
  SELECT courier_id, min(event_time) AS first_event, max(event_time) AS last_event, count(*) AS events,
         count(*) FILTER (WHERE event_type = 'courier_delivery_completed') AS deliveries,
         count(DISTINCT courier_zone_id) AS zones,
         (epoch_us(max(event_time)) - epoch_us(min(event_time))) / 6e7 AS span_min,
         greatest((epoch_us(max(event_time)) - epoch_us(min(event_time))) / 6e7
           - coalesce(sum(actual_travel_time) FILTER (WHERE event_type = 'courier_delivery_completed'
               AND actual_travel_time > 0), 0e0), 0e0) AS idle_min
  FROM session_rows GROUP BY courier_id, session
), multipliers AS (
  SELECT z.zone_id, x.category, greatest(1e0, max(x.m)) AS multiplier
  FROM (SELECT primary_district AS district, category, demand_multiplier AS m FROM effects
        UNION ALL SELECT secondary_district, category, demand_multiplier * 0.85e0 FROM effects) x
  JOIN zones z USING (district) GROUP BY 1, 2
)
"""

_MS_REPLACE = (
    "REPLACE (date_trunc('milliseconds', event_time) AS event_time, "
    "date_trunc('milliseconds', ingestion_time) AS ingestion_time)"
)
_TEXT_REPLACE = (
    "REPLACE (strftime(event_time, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS event_time, "
    "strftime(ingestion_time, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS ingestion_time)"
)
_EPOCHS = "epoch_us(event_time) // 1000 AS event_time_epoch_ms, epoch_us(ingestion_time) // 1000 AS ingestion_time_epoch_ms"
_ORDER_INTS = ("event_delay_seconds", "estimated_prep_time", "actual_prep_time", "estimated_delivery_time", "actual_delivery_time")
_COURIER_INTS = (
    "event_delay_seconds",
    "zone_hops_to_restaurant",
    "zone_hops_to_user",
    "estimated_travel_time",
    "actual_travel_time",
)


def _ints(names):
    return ", ".join(f"CAST({name} AS INTEGER) AS {name}" for name in names)


def _route(events, origin, destination, columns):
    """Columns over events left-joined to the travel matrix with the default route."""
    return f"""
SELECT {columns} FROM (
  SELECT ev.*, coalesce(m.mean_time_min, 8e0) AS mean_time_min, coalesce(m.hop_count, 0) AS hop_count,
         coalesce(m.base_delay_probability, 0.06e0) AS base_delay_probability,
         coalesce(m.pickup_cancel_factor, 1e0) AS pickup_cancel_factor,
         coalesce(m.user_cancel_sensitivity, 0.9e0) AS user_cancel_sensitivity
  FROM {events} ev LEFT JOIN matrix m ON m.zone_from = ev.{origin} AND m.zone_to = ev.{destination}) routed
"""


def _demand(ts):
    minute = f"(hour({ts}) * 60 + minute({ts}))"
    weekend = f"CASE WHEN isodow({ts}) >= 6 THEN 1.3e0 ELSE 1e0 END"
    holiday = (
        f"CASE WHEN month({ts}) * 100 + day({ts}) IN (101, 106, 418, 501, 815, 1012, 1206, 1225) "
        "THEN 1.45e0 ELSE 1e0 END"
    )
    smooth = (
        f"(1e0 + 1.5e0 * exp(-0.5e0 * pow(({minute} - 795) / 75e0, 2))"
        f" + 1.2e0 * exp(-0.5e0 * pow(({minute} - 1245) / 75e0, 2)))"
    )
    clock = f"({ts} - date_trunc('day', {ts}))"
    step = (
        f"CASE WHEN {clock} BETWEEN to_minutes(720) AND to_minutes(870) THEN 2.5e0 "
        f"WHEN {clock} BETWEEN to_minutes(1170) AND to_minutes(1320) THEN 2.2e0 ELSE 1e0 END"
    )
    return f"{smooth} * {weekend} * {holiday} * 1.5e0", f"{step} * {weekend} * {holiday} * 1.5e0"


_CREATED = "(SELECT * FROM ord WHERE event_type = 'order_created')"
_ASSIGNED = "(SELECT * FROM cou WHERE event_type = 'courier_assigned_order')"
_FLIGHT = """
SELECT order_id, event_time AS created_at, user_zone_id AS zone FROM ord
WHERE event_type = 'order_created' AND order_id NOT IN (SELECT order_id FROM ord WHERE event_type IN ({types}))
"""
_ENDS = "'order_delivered', 'order_cancelled_user', 'order_cancelled_restaurant'"
_LABEL = "zone_id || ' – ' || district"
_smooth, _step = _demand("event_time")
_hour_smooth, _ = _demand("hour_start")

_SQL = {
    "src_kafka": f"SELECT DISTINCT {_ORDER_COLUMNS} FROM (SELECT * {_MS_REPLACE} FROM ord)",
    "decode_json": f"SELECT * {_TEXT_REPLACE}, {_EPOCHS} FROM ord",
    "decode_avro": f"""SELECT * EXCLUDE ({', '.join(_ORDER_INTS)}) REPLACE (
        date_trunc('milliseconds', event_time) AS event_time, date_trunc('milliseconds', ingestion_time) AS ingestion_time,
        coalesce(restaurant_category, '') AS restaurant_category), {_ints(_ORDER_INTS)}, {_EPOCHS} FROM ord""",
    "decode_avro_couriers": f"""SELECT * EXCLUDE ({', '.join(_COURIER_INTS)}) {_MS_REPLACE},
        {_ints(_COURIER_INTS)}, {_EPOCHS} FROM cou""",
    "decode_mixed": f"SELECT * {_MS_REPLACE} FROM cou UNION ALL SELECT * {_MS_REPLACE} FROM cou",
    "align_schema": """SELECT event_id, event_type, event_version,
        strftime(event_time, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS event_time,
        strftime(ingestion_time, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS ingestion_time,
        courier_id, CAST(NULL AS VARCHAR) AS courier_zone_id, order_id, restaurant_id, restaurant_zone_id, user_zone_id,
        CAST(NULL AS VARCHAR) AS shift_id, CAST(NULL AS VARCHAR) AS courier_status,
        CAST(NULL AS DOUBLE) AS zone_hops_to_restaurant, CAST(NULL AS DOUBLE) AS zone_hops_to_user,
        CAST(NULL AS DOUBLE) AS estimated_travel_time, CAST(NULL AS DOUBLE) AS actual_travel_time,
        CAST(NULL AS VARCHAR) AS offline_reason, is_late_event, event_delay_seconds,
        CAST(NULL AS BIGINT) AS event_time_epoch_ms, CAST(NULL AS BIGINT) AS ingestion_time_epoch_ms FROM ord""",
    "union_formats": f"""SELECT * {_MS_REPLACE} FROM ord UNION ALL SELECT * REPLACE (
        date_trunc('milliseconds', event_time) AS event_time, date_trunc('milliseconds', ingestion_time) AS ingestion_time,
        coalesce(restaurant_category, '') AS restaurant_category) FROM ord""",
    "event_time_ts": "SELECT event_id, event_time, read_at AS event_time_ts FROM dirty",
    "read_ndjson": f"SELECT * {_TEXT_REPLACE}, {_EPOCHS} FROM cou",
    "read_parquet_prefix": "SELECT * FROM ord",
    "archive_by_date": """SELECT event_id, event_type, event_time FROM ord
        WHERE CAST(event_time AS DATE) = DATE '2024-01-06'""",
    "load_with_fallback": "SELECT event_id, event_type, order_id, event_time FROM ord",
    "finalise_events": f"SELECT DISTINCT {_ORDER_COLUMNS} FROM (SELECT * {_MS_REPLACE} FROM ord)",
    "ref_zones": "SELECT * REPLACE (spawn_probability / (SELECT sum(spawn_probability) FROM zones) AS spawn_probability) FROM zones",
    "ref_restaurants": "SELECT * FROM rest",
    "ref_travel_matrix": "SELECT * FROM matrix",
    "ref_match_effects": "SELECT * FROM effects",
    "ref_adjacency": "SELECT * FROM adjacent UNION SELECT adjacent_district, district FROM adjacent",
    "sink_parquet_stream": "SELECT * FROM ord",
    "sink_ndjson": f"SELECT * {_MS_REPLACE}, {_EPOCHS} FROM ord",
    "to_avro_record": f"""SELECT * EXCLUDE (read_at, {', '.join(_ORDER_INTS)}) REPLACE (
        coalesce(epoch_us(read_at) // 1000, 0) AS event_time,
        epoch_us(CAST(replace(ingestion_time, 'Z', '') AS TIMESTAMP)) // 1000 AS ingestion_time,
        coalesce(user_id, '') AS user_id, coalesce(restaurant_category, '') AS restaurant_category),
        {_ints(_ORDER_INTS)} FROM dirty""",
    "to_avro_record_couriers": f"""SELECT * EXCLUDE ({', '.join(_COURIER_INTS)}) REPLACE (
        epoch_us(event_time) // 1000 AS event_time, epoch_us(ingestion_time) // 1000 AS ingestion_time), {_ints(_COURIER_INTS)} FROM cou""",
    "sink_kafka": """SELECT courier_id AS key, event_id, event_type,
        strftime(event_time, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS event_time, epoch_us(event_time) // 1000 AS event_time_epoch_ms FROM cou""",
    "add_epoch_ms": """SELECT event_id, event_time, coalesce(epoch_us(read_at) // 1000, 0) AS event_time_epoch_ms,
        epoch_us(CAST(replace(ingestion_time, 'Z', '') AS TIMESTAMP)) // 1000 AS ingestion_time_epoch_ms FROM dirty""",
    "interleave_feeds": "SELECT feed, event_id, event_type, event_time, order_id, courier_id FROM feed",
    "event_log_lines": """SELECT event_id, event_date, event_clock, label, order_ref, courier_ref, feed_name,
        '  ' || event_date || '  ' || event_clock || '   ' || rpad(label, greatest(length(label), 20)::INTEGER, ' ')
        || '  ' || rpad(order_ref, greatest(length(order_ref), 12)::INTEGER, ' ') || '   '
        || rpad(courier_ref, greatest(length(courier_ref), 8)::INTEGER, ' ') || '  ' || feed_name AS line
      FROM (SELECT event_id, strftime(event_time, '%Y-%m-%d') AS event_date, strftime(event_time, '%H:%M') AS event_clock,
        CASE event_type WHEN 'order_created' THEN 'Created' WHEN 'order_confirmed' THEN 'Confirmed'
          WHEN 'order_preparing' THEN 'Preparing' WHEN 'order_ready_for_pickup' THEN 'Ready for pickup'
          WHEN 'order_picked_up' THEN 'Picked up' WHEN 'order_delivered' THEN 'Delivered'
          WHEN 'courier_assigned_order' THEN 'Assigned' WHEN 'courier_arrived_restaurant' THEN 'At restaurant'
          WHEN 'courier_pickup_completed' THEN 'Pickup done' WHEN 'courier_arrived_customer_zone' THEN 'At customer'
          WHEN 'courier_delivery_completed' THEN 'Delivery done' ELSE event_type END AS label,
        coalesce(order_id, '-') AS order_ref, coalesce(courier_id, '-') AS courier_ref,
        CASE feed WHEN 'order_lifecycle' THEN 'Order' ELSE 'Courier' END AS feed_name FROM feed)""",
    "filter_event_type": """SELECT user_zone_id, count(*) FILTER (WHERE event_type = 'order_delivered') AS delivered,
        count(*) FILTER (WHERE event_type <> 'order_delivered') AS cancelled FROM ord
        WHERE event_type IN ('order_delivered', 'order_cancelled_user', 'order_cancelled_restaurant') GROUP BY 1""",
    "time_bucket_15": "SELECT event_id, time_bucket(INTERVAL '15 minutes', event_time) AS bucket FROM ord",
    "positive_numeric": """SELECT event_id, CASE WHEN actual_prep_time > 0 THEN actual_prep_time END AS prep_min,
        CASE WHEN actual_delivery_time > 0 THEN actual_delivery_time END AS travel_min FROM ord""",
    "minutes_between": "SELECT event_id, (epoch_us(ingestion_time) - epoch_us(event_time)) / 6e7 AS lag_min FROM ord",
    "zone_label": f"""SELECT event_id, user_zone_id, {_LABEL} AS zone_label FROM ord JOIN zones ON zone_id = user_zone_id""",
    "normalise_flags": "SELECT restaurant_id, has_consistent_promo AS has_promo FROM rest",
    "clip_fill": """SELECT event_id,
        CASE WHEN actual_delivery_time IS NOT NULL THEN greatest(actual_delivery_time, 0e0) END AS clipped,
        CAST(coalesce(event_delay_seconds, 0) AS BIGINT) AS delay_s,
        round_even(actual_delivery_time / 8, 1) AS travel_eighths,
        round_even(actual_delivery_time / 8, 2) AS travel_eighths_2 FROM ord""",
    "calendar_tags": """SELECT event_id, event_time, isodow(event_time) >= 6 AS is_weekend,
        month(event_time) * 100 + day(event_time) IN (101, 106, 418, 501, 815, 1012, 1206, 1225) AS is_holiday,
        CASE WHEN event_time - date_trunc('day', event_time) BETWEEN to_minutes(720) AND to_minutes(870) THEN 'lunch'
             WHEN event_time - date_trunc('day', event_time) BETWEEN to_minutes(1170) AND to_minutes(1320) THEN 'dinner'
        END AS meal_period, CAST(hour(event_time) AS INTEGER) AS hour FROM ord""",
    "latest_day_flag": """SELECT event_id, order_id, event_type, event_time, CAST(event_time AS DATE) =
        (SELECT CAST(max(event_time) AS DATE) FROM ord WHERE event_type = 'order_created') AS on_latest_day FROM ord""",
    "created_delivered": "SELECT *, count(*) AS pairs FROM cd GROUP BY ALL",
    "stage_gap": """SELECT a.order_id, a.event_time AS t_a, b.event_time AS t_b,
        (epoch_us(b.event_time) - epoch_us(a.event_time)) / 6e7 AS gap_min, count(*) AS pairs
        FROM ord a JOIN ord b USING (order_id) WHERE a.event_type = 'order_created' AND b.event_type = 'order_picked_up'
        AND b.event_time >= a.event_time GROUP BY ALL""",
    "in_flight_orders": _FLIGHT.format(types=_ENDS),
    "in_flight_orders_system": _FLIGHT.format(types=_ENDS + ", 'order_cancelled_system'"),
    "zone_counts_outer": "SELECT * FROM zm",
    "zone_demand_supply": "SELECT * FROM ratio",
    "spine_join": "SELECT * FROM spine",
    "series_align": """SELECT time_bucket(INTERVAL '15 minutes', event_time) AS bucket,
        count(DISTINCT courier_id) FILTER (WHERE event_type = 'courier_assigned_order') AS active_couriers,
        count(DISTINCT courier_id) FILTER (WHERE event_type = 'courier_online') AS online_couriers
        FROM cou WHERE event_type IN ('courier_assigned_order', 'courier_online') GROUP BY 1""",
    "zone_map_table": """SELECT zone_id, district, centroid_x, centroid_y, coalesce(total_orders, 0) AS total_orders,
        coalesce(avg_full_delivery_min, 0e0) AS avg_delivery_min, coalesce(cancellation_rate, 0e0) AS cancellation_rate,
        CAST(greatest(coalesce(total_orders, 0), 1) AS DOUBLE) AS size_val
        FROM zones LEFT JOIN zm USING (zone_id) LEFT JOIN zd USING (zone_id)""",
    "zone_rankings": "SELECT * FROM rankings",
    "supply_demand_gap": """SELECT bucket, coalesce(o.n, 0) AS orders_created, coalesce(c.n, 0) AS active_couriers,
        coalesce(o.n, 0) - coalesce(c.n, 0) AS supply_gap
        FROM (SELECT time_bucket(INTERVAL '15 minutes', event_time) AS bucket, count(*) AS n FROM ord
              WHERE event_type = 'order_created' GROUP BY 1) o
        FULL JOIN (SELECT time_bucket(INTERVAL '15 minutes', event_time) AS bucket, count(DISTINCT courier_id) AS n
              FROM cou WHERE event_type = 'courier_assigned_order' GROUP BY 1) c USING (bucket)""",
    "route_lookup": _route(
        _CREATED,
        "restaurant_zone_id",
        "user_zone_id",
        "event_id, restaurant_zone_id, user_zone_id, mean_time_min, hop_count, base_delay_probability, "
        "pickup_cancel_factor, user_cancel_sensitivity",
    ),
    "district_zone_map": """SELECT event_id, user_zone_id, district, zone_id AS zone_of_district
        FROM ord LEFT JOIN zones ON zone_id = user_zone_id""",
    "restaurants_by_zone": """SELECT zone_id, restaurant_id, count(*) OVER (PARTITION BY zone_id) AS candidates FROM rest""",
    "restaurants_by_category": """SELECT category, restaurant_id, count(*) OVER (PARTITION BY category) AS candidates FROM rest""",
    "promo_match": """, promos AS (
          SELECT * FROM (VALUES (1, 'Taco Tuesday 2x1', [1], 0, 24, ['mexican']),
            (2, 'Weekend Burger Deal', [5], 0, 24, ['burger']),
            (3, 'Weekend Evening', [5, 6], 18, 23, ['burger', 'pizza'])) p(no, promo, days, h1, h2, kinds)
        ), created AS (
          SELECT row_number() OVER () AS row_no, event_id, order_id, event_time, restaurant_category AS category
          FROM ord WHERE event_type = 'order_created'
        ), hits AS (
          SELECT row_no, arg_min(promo, no) AS promo FROM created, promos
          WHERE list_contains(days, isodow(event_time) - 1) AND hour(event_time) >= h1 AND hour(event_time) < h2
            AND list_contains(kinds, category) GROUP BY 1)
        SELECT event_id, order_id, event_time, category, promo FROM created LEFT JOIN hits USING (row_no)""",
    "zone_health": "SELECT * FROM health",
    "zone_health_stream": "SELECT * FROM health",
    "order_courier_interval": "SELECT * FROM interval_join",
    "order_courier_interval_stream": "SELECT * FROM interval_join",
    "orders_tumbling_kpi": "SELECT * FROM tumbling",
    "orders_tumbling_kpi_stream": "SELECT * FROM tumbling",
    "orders_hopping_kpi": "SELECT * FROM hopping",
    "orders_hopping_kpi_stream": "SELECT * FROM hopping",
    "orders_waiting": "SELECT * FROM waiting",
    "orders_waiting_stream": "SELECT * FROM waiting",
    "couriers_dispatched": "SELECT * FROM dispatched",
    "couriers_dispatched_stream": "SELECT * FROM dispatched",
    "anomaly_zones": "SELECT * FROM anomaly",
    "anomaly_zones_stream": "SELECT * FROM anomaly",
    "anomaly_alerts": "SELECT * FROM anomaly WHERE zone_flagged",
    "order_kpis": """SELECT
        (SELECT count(DISTINCT order_id) FROM snap WHERE event_type = 'order_created') AS total_created,
        (SELECT count(DISTINCT order_id) FROM snap WHERE event_type = 'order_delivered') AS total_delivered,
        (SELECT count(DISTINCT order_id) FROM snap WHERE event_type = 'order_created' AND CAST(event_time AS DATE) = today) AS created_today,
        (SELECT count(DISTINCT order_id) FROM snap WHERE event_type = 'order_delivered' AND CAST(event_time AS DATE) = today) AS delivered_today,
        (SELECT count(DISTINCT order_id) FROM snap WHERE event_type IN ('order_cancelled_user', 'order_cancelled_restaurant')) AS total_cancelled,
        (SELECT count(DISTINCT order_id) FROM snap WHERE event_type IN ('order_cancelled_user', 'order_cancelled_restaurant'))
          / (SELECT count(DISTINCT order_id) FROM snap WHERE event_type = 'order_created') * 100 AS cancellation_rate_pct,
        (SELECT count(*) FROM (SELECT order_id FROM snap WHERE event_type = 'order_created' EXCEPT
          SELECT order_id FROM snap WHERE event_type IN ('order_delivered', 'order_cancelled_user', 'order_cancelled_restaurant'))) AS orders_in_flight,
        d.avg_prep_time_min, round(d.p95_prep_time_min, 9) AS p95_prep_time_min, d.avg_travel_time_min,
        round(d.p95_travel_time_min, 9) AS p95_travel_time_min, f.avg_full_delivery_min,
        round(f.p95_delivery_min, 9) AS p95_delivery_min, f.on_time_rate_pct
      FROM (SELECT CAST(max(event_time) AS DATE) AS today FROM ord WHERE event_type = 'order_created') now,
        (SELECT avg(actual_prep_time) FILTER (WHERE actual_prep_time > 0) AS avg_prep_time_min,
                quantile_cont(actual_prep_time, 0.95) FILTER (WHERE actual_prep_time > 0) AS p95_prep_time_min,
                avg(actual_delivery_time) FILTER (WHERE actual_delivery_time > 0) AS avg_travel_time_min,
                quantile_cont(actual_delivery_time, 0.95) FILTER (WHERE actual_delivery_time > 0) AS p95_travel_time_min
         FROM snap WHERE event_type = 'order_delivered') d,
        (SELECT avg(m) AS avg_full_delivery_min, quantile_cont(m, 0.95) AS p95_delivery_min,
                count(*) FILTER (WHERE m <= 45) / count(*) * 100 AS on_time_rate_pct
         FROM (SELECT (epoch_us(x.event_time) - epoch_us(c.event_time)) / 6e7 AS m FROM snap c JOIN snap x USING (order_id)
               WHERE c.event_type = 'order_created' AND x.event_type = 'order_delivered') WHERE m > 0) f""",
    "cancellation_mix": """SELECT time_bucket(INTERVAL '15 minutes', event_time) AS bucket,
        count(*) FILTER (WHERE event_type = 'order_cancelled_user') AS order_cancelled_user,
        count(*) FILTER (WHERE event_type = 'order_cancelled_restaurant') AS order_cancelled_restaurant,
        count(*) FILTER (WHERE event_type = 'order_cancelled_system') AS order_cancelled_system
        FROM ord WHERE event_type LIKE 'order_cancelled%' GROUP BY 1""",
    "zone_metrics": "SELECT * FROM zm",
    "full_delivery_by_zone": "SELECT * FROM zd",
    "on_time_trend": """SELECT time_bucket(INTERVAL '15 minutes', delivered_at) AS bucket,
        count(*) FILTER (WHERE full_delivery_min <= 45) / count(*) * 100 AS on_time_rate_pct FROM cd GROUP BY 1""",
    "delivery_percentiles": """SELECT time_bucket(INTERVAL '15 minutes', delivered_at) AS bucket,
        round(quantile_cont(full_delivery_min, 0.5), 9) AS p50, round(quantile_cont(full_delivery_min, 0.95), 9) AS p95 FROM cd GROUP BY 1""",
    "stage_times": """, gaps AS (
        SELECT a.event_type AS ta, b.event_type AS tb, (epoch_us(b.event_time) - epoch_us(a.event_time)) / 6e7 AS gap
        FROM ord a JOIN ord b USING (order_id)
        WHERE b.event_time >= a.event_time AND (a.event_type, b.event_type) IN
          (('order_created', 'order_confirmed'), ('order_ready_for_pickup', 'order_picked_up'))
      ), stages AS (
        SELECT 1 AS stage_no, 'Wait – Confirm' AS stage, avg(gap) AS avg_min FROM gaps WHERE ta = 'order_created'
        UNION ALL SELECT 2, 'Prep', avg(actual_prep_time) FROM ord WHERE event_type = 'order_delivered' AND actual_prep_time > 0
        UNION ALL SELECT 3, 'Wait – Courier', avg(gap) FROM gaps WHERE ta = 'order_ready_for_pickup'
        UNION ALL SELECT 4, 'Travel', avg(actual_delivery_time) FROM ord WHERE event_type = 'order_delivered' AND actual_delivery_time > 0)
      SELECT stage_no, stage, round(avg_min, 9) AS avg_min FROM stages
      UNION ALL SELECT 5, 'Total', round(sum(avg_min), 9) FROM stages""",
    "courier_kpis": """SELECT a AS active_couriers, CASE WHEN o = 0 THEN everyone ELSE o END AS online_couriers,
        d AS deliveries_completed, d / a AS utilization_rate FROM (SELECT
        count(DISTINCT courier_id) FILTER (WHERE event_type = 'courier_assigned_order') AS a,
        count(DISTINCT courier_id) FILTER (WHERE event_type = 'courier_online') AS o,
        count(DISTINCT courier_id) AS everyone,
        count(courier_id) FILTER (WHERE event_type = 'courier_delivery_completed') AS d FROM cou)""",
    "gmv": """SELECT n * 18e0 AS estimated_gmv_eur, n * 18e0 / hours AS hourly_run_rate_eur,
        n * 18e0 / hours * 16e0 AS eod_projection_eur
        FROM (SELECT count(*) AS n, greatest((epoch_us(max(event_time)) - epoch_us(min(event_time))) / 1e6 / 3600e0, 0.1e0) AS hours
              FROM ord WHERE event_type = 'order_delivered')""",
    "gmv_by_zone": "SELECT * FROM zg",
    "gmv_over_time": """SELECT time_bucket(INTERVAL '15 minutes', event_time) AS bucket, count(*) AS delivered_orders,
        count(*) * 18e0 AS estimated_gmv_eur FROM ord WHERE event_type = 'order_delivered' GROUP BY 1""",
    "gmv_actual": """SELECT user_zone_id AS zone_id, count(*) AS delivered_orders,
        CAST(sum(CAST(floor(ev.value * 100) AS BIGINT)) AS BIGINT) AS gmv_cents
        FROM ord o JOIN events ev ON o.order_id = 'ORD' || lpad(CAST(ev.event_id AS VARCHAR), 8, '0')
        WHERE o.event_type = 'order_delivered' GROUP BY 1""",
    "order_outcomes": """, n AS (SELECT
        (SELECT count(DISTINCT order_id) FROM snap WHERE event_type = 'order_delivered') AS d,
        (SELECT count(DISTINCT order_id) FROM snap WHERE event_type IN ('order_cancelled_user', 'order_cancelled_restaurant')) AS c,
        (SELECT count(*) FROM (SELECT order_id FROM snap WHERE event_type = 'order_created' EXCEPT
          SELECT order_id FROM snap WHERE event_type IN ('order_delivered', 'order_cancelled_user', 'order_cancelled_restaurant'))) AS f)
      SELECT 'Delivered' AS outcome, d AS orders, d / (d + c + f) AS share FROM n
      UNION ALL SELECT 'Cancelled', c, c / (d + c + f) FROM n UNION ALL SELECT 'In-Flight', f, f / (d + c + f) FROM n""",
    "zone_stress": f"""SELECT coalesce({_LABEL}, zone_id) AS zone_label, bucket, demand_courier_ratio
        FROM ratio LEFT JOIN zones USING (zone_id)""",
    "zone_stress_pivot": f"""SELECT coalesce({_LABEL}, zone_id) AS zone_label, date_trunc('day', bucket)::TIMESTAMP AS day, """
    + ", ".join(
        f"coalesce(avg(demand_courier_ratio) FILTER (WHERE strftime(bucket, 't%H%M') = '{slot}'), 0e0) AS {slot}"
        for slot in day_slots()
    )
    + " FROM ratio LEFT JOIN zones USING (zone_id) GROUP BY 1, 2",
    "data_freshness": """SELECT (SELECT count(*) FROM ord) AS order_count, (SELECT count(*) FROM cou) AS courier_count,
        (SELECT max(event_time) FROM ord) AS latest_event, (SELECT min(event_time) FROM ord) AS earliest_event""",
    "sla_gauge": """SELECT value, 80e0 AS target, value - 80e0 AS delta,
        CASE WHEN value < 80e0 * 0.7e0 THEN 'red' WHEN value < 80e0 THEN 'amber' ELSE 'green' END AS band
        FROM (SELECT count(*) FILTER (WHERE m <= 45) / count(*) * 100 AS value
              FROM (SELECT (epoch_us(x.event_time) - epoch_us(c.event_time)) / 6e7 AS m FROM snap c JOIN snap x USING (order_id)
                    WHERE c.event_type = 'order_created' AND x.event_type = 'order_delivered') WHERE m > 0)""",
    "feed_counts": "SELECT feed, count(*) AS events FROM feed GROUP BY 1",
    "orders_over_time": """SELECT bucket, orders_created, orders_delivered, CAST(greatest(sum(orders_created - orders_delivered)
        OVER (ORDER BY bucket ROWS UNBOUNDED PRECEDING), 0) AS BIGINT) AS active_orders FROM spine""",
    "at_risk_orders": f""", flight AS (SELECT order_id, zone, (epoch_us((SELECT max(event_time) FROM ord)) - epoch_us(created_at)) / 6e7
        AS elapsed_min FROM ({_FLIGHT.format(types=_ENDS)}))
        SELECT order_id, zone, elapsed_min, 'In-Flight' AS status FROM flight
        WHERE elapsed_min >= (SELECT quantile_cont(elapsed_min, 0.5) FROM flight)""",
    "dedup_first": f"""SELECT {_ORDER_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY order_id, event_type
        ORDER BY ingestion_time, event_time, event_id) AS rn FROM ord) WHERE rn = 1""",
    "weights_normalise": """SELECT zone_id, population, population / sum(population) OVER () AS share FROM zones""",
    "top_zones_gmv": f"""SELECT zone_id, coalesce({_LABEL}, zone_id) AS zone_label, delivered_orders, estimated_gmv_eur
        FROM zg LEFT JOIN zones USING (zone_id) ORDER BY estimated_gmv_eur DESC, zone_id LIMIT 10""",
    "sort_by_event_time": "SELECT event_id, event_type, event_time FROM ord ORDER BY event_time, event_id",
    "rank_zones": """SELECT zone_id, rank() OVER (ORDER BY total_orders DESC) AS orders_rank,
        rank() OVER (ORDER BY avg_full_delivery_min DESC NULLS LAST) AS delivery_rank,
        rank() OVER (ORDER BY estimated_gmv_eur DESC) AS gmv_rank FROM rankings""",
    "union_by_name": """SELECT *, 'order_lifecycle' AS feed FROM ord
        UNION ALL BY NAME SELECT *, 'courier_operations' AS feed FROM cou""",
    "id_difference": f"""SELECT order_id FROM ord WHERE event_type = 'order_created'
        EXCEPT SELECT order_id FROM ord WHERE event_type IN ({_ENDS})""",
    "bucket_union": """SELECT time_bucket(INTERVAL '15 minutes', event_time) AS bucket FROM ord
        UNION SELECT time_bucket(INTERVAL '15 minutes', event_time) FROM cou""",
    "zone_set_filter": """SELECT event_id, user_zone_id FROM ord
        WHERE user_zone_id IN (SELECT zone_id FROM zones WHERE centrality_weight > 0.85)""",
    "dedup_stream": f"SELECT DISTINCT {_ORDER_COLUMNS} FROM ord",
    "dedup_watermark": f"SELECT DISTINCT {_ORDER_COLUMNS} FROM ord",
    "dedup_logical": "SELECT DISTINCT order_id, event_type, event_time FROM ord",
    "dedup_logical_stream": "SELECT DISTINCT order_id, event_type, event_time FROM ord",
    "watermark": "SELECT * FROM anomaly",
    "windows": "SELECT * FROM hourly",
    "courier_sessions": "SELECT * FROM sessions",
    "courier_sessions_stream": "SELECT * FROM sessions",
    "late_policy": """SELECT time_bucket(INTERVAL '5 minutes', event_time) AS window_start,
        time_bucket(INTERVAL '5 minutes', event_time) + INTERVAL '5 minutes' AS window_end,
        count(*) AS event_count, count(*) FILTER (WHERE event_type = 'order_created') AS orders_created,
        count(*) FILTER (WHERE event_type = 'order_delivered') AS orders_delivered,
        avg(actual_delivery_time) AS avg_delivery_time_min FROM ord
        WHERE epoch_us(event_time) >= (SELECT min(epoch_us(event_time))
          + (max(epoch_us(event_time)) - min(epoch_us(event_time))) // 2 FROM ord) GROUP BY 1, 2""",
    "append_mode_close": """SELECT * FROM tumbling
        WHERE window_end <= (SELECT max(event_time) - INTERVAL '15 minutes' FROM ord)""",
    "lifecycle_state": """, taken AS (SELECT order_id, event_time FROM feed
          WHERE event_type IN ('courier_assigned_order', 'order_delivered') OR event_type LIKE 'order_cancelled%'),
        ready AS (SELECT order_id, min(event_time) AS ready_at FROM ord WHERE event_type = 'order_ready_for_pickup' GROUP BY 1)
        SELECT f.order_id, min(event_time) AS first_at, max(event_time) AS last_at,
          arg_max(event_type, (event_time, event_type)) AS last_event,
          (epoch_us(max(event_time)) - epoch_us(min(event_time))) / 6e7 AS elapsed_min, r.ready_at,
          r.ready_at IS NOT NULL AND f.order_id NOT IN (SELECT t.order_id FROM taken t JOIN ready x USING (order_id)
            WHERE t.event_time <= x.ready_at + INTERVAL '15 minutes') AS stuck
        FROM feed f LEFT JOIN ready r ON r.order_id = f.order_id WHERE f.order_id IS NOT NULL GROUP BY f.order_id, r.ready_at""",
    "stuck_orders": """SELECT r.order_id, r.event_time AS ready_at, r.event_time + INTERVAL '15 minutes' AS due_at FROM ord r
        WHERE r.event_type = 'order_ready_for_pickup' AND NOT EXISTS (SELECT 1 FROM feed f WHERE f.order_id = r.order_id
          AND f.event_time <= r.event_time + INTERVAL '15 minutes' AND f.event_time >= r.event_time - INTERVAL '240 minutes'
          AND (f.event_type IN ('courier_assigned_order', 'order_delivered') OR f.event_type LIKE 'order_cancelled%'))""",
    "checkpoint_restart": "SELECT * FROM tumbling",
    "multi_query": """SELECT 'orders' AS sink, count(*) AS rows FROM ord
        UNION ALL SELECT 'couriers', count(*) FROM cou
        UNION ALL SELECT 'kpi_orders_5min_tumbling', count(*) FROM tumbling
        UNION ALL SELECT 'kpi_orders_10min_hop5', count(*) FROM hopping
        UNION ALL SELECT 'kpi_zone_health', count(*) FROM health
        UNION ALL SELECT 'kpi_anomaly_zones', count(*) FROM anomaly""",
    "schema_violations": "SELECT rule, count(*) AS events FROM (SELECT unnest(["
    + ", ".join(f"CASE WHEN {name} IS NULL THEN 'missing {name}' END" for name in REQUIRED_ORDER_FIELDS)
    + """, CASE WHEN event_type = 'order_teleported' THEN 'unknown event_type' END,
        CASE WHEN read_at IS NULL THEN 'unreadable event_time' END]) AS rule FROM dirty) WHERE rule IS NOT NULL GROUP BY 1""",
    "late_events": """SELECT feed, time_bucket(INTERVAL '1 hour', event_time) AS bucket, count(*) AS events,
        count(*) FILTER (WHERE is_late_event) AS late_events,
        count(*) FILTER (WHERE is_late_event) / count(*) AS late_share,
        round(quantile_cont(event_delay_seconds, 0.5) FILTER (WHERE is_late_event), 9) AS p50_delay_s,
        round(quantile_cont(event_delay_seconds, 0.95) FILTER (WHERE is_late_event), 9) AS p95_delay_s FROM feed GROUP BY 1, 2""",
    "duplicate_events": """SELECT order_id, event_type, event_time, count(*) AS copies, count(DISTINCT event_id) AS event_ids
        FROM ord GROUP BY 1, 2, 3 HAVING count(*) > 1""",
    "out_of_order": """SELECT event_id, restaurant_id, event_type, event_time, latest_before,
        (epoch_us(latest_before) - epoch_us(event_time)) / 6e7 AS behind_min
        FROM (SELECT *, max(event_time) OVER (PARTITION BY restaurant_id ORDER BY ingestion_time, event_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest_before FROM ord) WHERE event_time < latest_before""",
    "out_of_order_per_order": """SELECT event_id, order_id, event_type, event_time, latest_before,
        (epoch_us(latest_before) - epoch_us(event_time)) / 6e7 AS behind_min
        FROM (SELECT *, max(event_time) OVER (PARTITION BY order_id ORDER BY ingestion_time, event_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest_before FROM ord) WHERE event_time < latest_before""",
    "missing_steps": "SELECT d.order_id, s.step AS missing_step FROM "
    "(SELECT DISTINCT order_id FROM ord WHERE event_type = 'order_delivered') d, "
    f"(SELECT unnest([{', '.join(repr(step) for step in REQUIRED_BEFORE_DELIVERY)}]) AS step) s "
    "WHERE NOT EXISTS (SELECT 1 FROM ord o WHERE o.order_id = d.order_id AND o.event_type = s.step)",
    "impossible_durations": """SELECT 'order_lifecycle' AS feed, event_id, order_id, field, value, anomaly_flag AS flagged
        FROM (UNPIVOT ord ON estimated_prep_time, actual_prep_time, estimated_delivery_time, actual_delivery_time
              INTO NAME field VALUE value) WHERE value < 0
        UNION ALL SELECT 'courier_operations', event_id, order_id, field, value, false
        FROM (UNPIVOT cou ON estimated_travel_time, actual_travel_time INTO NAME field VALUE value) WHERE value < 0""",
    "offline_mid_delivery": """SELECT o.order_id, o.t AS offline_at, a.t AS abandoned_at, r.t AS reassigned_at,
        d.t AS completed_at, d.t IS NOT NULL AS recovered, (epoch_us(d.t) - epoch_us(o.t)) / 6e7 AS minutes_to_recovery
        FROM (SELECT order_id, min(event_time) AS t FROM cou WHERE event_type = 'courier_offline_mid_delivery' GROUP BY 1) o
        LEFT JOIN (SELECT order_id, min(event_time) AS t FROM cou WHERE event_type = 'courier_abandoned_delivery' GROUP BY 1) a USING (order_id)
        LEFT JOIN (SELECT order_id, min(event_time) AS t FROM cou WHERE event_type = 'courier_reassigned' GROUP BY 1) r USING (order_id)
        LEFT JOIN (SELECT order_id, max(event_time) AS t FROM cou WHERE event_type = 'courier_delivery_completed' GROUP BY 1) d
          ON d.order_id = o.order_id AND d.t >= o.t""",
    "outlier_prep_times": """, timed AS (SELECT event_id, order_id, category, actual_prep_time FROM ord JOIN category USING (order_id)
          WHERE event_type = 'order_delivered'),
        q AS (SELECT category, quantile_cont(actual_prep_time, 0.25) AS q1, quantile_cont(actual_prep_time, 0.75) AS q3
              FROM timed GROUP BY 1)
        SELECT category, event_id, order_id, actual_prep_time, q1 - (q3 - q1) * 0.25e0 AS lower, q3 + (q3 - q1) * 0.25e0 AS upper
        FROM timed JOIN q USING (category)
        WHERE actual_prep_time < q1 - (q3 - q1) * 0.25e0 OR actual_prep_time > q3 + (q3 - q1) * 0.25e0""",
    "unassigned_orders": """SELECT r.order_id, r.event_time AS ready_at, r.restaurant_zone_id AS zone_id FROM ord r
        WHERE r.event_type = 'order_ready_for_pickup' AND NOT EXISTS (SELECT 1 FROM cou a WHERE a.order_id = r.order_id
          AND a.event_type = 'courier_assigned_order'
          AND a.event_time <= r.event_time + INTERVAL '15 minutes')""",
    "prep_sla": """SELECT restaurant_id, category, avg(CASE WHEN actual_prep_time <= estimated_prep_time THEN 1e0 ELSE 0e0 END) * 100 AS on_time_rate_pct,
        round(quantile_cont(actual_prep_time, 0.5), 9) AS p50_prep_min, round(quantile_cont(actual_prep_time, 0.95), 9) AS p95_prep_min, count(*) AS orders
        FROM ord JOIN category USING (order_id) WHERE event_type = 'order_ready_for_pickup' AND actual_prep_time > 0 GROUP BY 1, 2""",
    "dispatch_latency": """SELECT r.restaurant_zone_id AS zone_id, hour(r.event_time) AS hour, count(*) AS dispatches,
        avg((epoch_us(a.event_time) - epoch_us(r.event_time)) / 6e7) AS avg_dispatch_min
        FROM ord r JOIN cou a ON a.order_id = r.order_id AND a.event_time >= r.event_time
        WHERE r.event_type = 'order_ready_for_pickup' AND a.event_type = 'courier_assigned_order' GROUP BY 1, 2""",
    "orders_per_hour": "SELECT * FROM hourly",
    "courier_availability": """SELECT time_bucket(INTERVAL '1 hour', event_time) AS hour_start, courier_zone_id AS zone_id,
        count(DISTINCT courier_id) AS online_couriers FROM cou WHERE event_type = 'courier_online' GROUP BY 1, 2""",
    "shift_coverage": """SELECT shift_id, min(event_time) AS first_event, max(event_time) AS last_event, count(*) AS events,
        count(*) FILTER (WHERE event_type = 'courier_delivery_completed') AS deliveries,
        (epoch_us(max(event_time)) - epoch_us(min(event_time))) / 6e7 AS span_min FROM cou GROUP BY 1""",
    "route_performance": """SELECT t.leg, t.zone_from, t.zone_to, t.trips, t.avg_actual_min,
        coalesce(m.mean_time_min, 8e0) AS mean_time_min, t.avg_actual_min - coalesce(m.mean_time_min, 8e0) AS over_mean_min
        FROM (SELECT 'to_restaurant' AS leg, courier_zone_id AS zone_from, restaurant_zone_id AS zone_to, count(*) AS trips,
                     avg(actual_travel_time) AS avg_actual_min
              FROM cou WHERE event_type = 'courier_arrived_restaurant' AND actual_travel_time > 0 GROUP BY 2, 3
              UNION ALL SELECT 'to_customer', restaurant_zone_id, user_zone_id, count(*), avg(actual_travel_time)
              FROM cou WHERE event_type = 'courier_delivery_completed' AND actual_travel_time > 0 GROUP BY 2, 3) t
        LEFT JOIN matrix m USING (zone_from, zone_to)""",
    "zone_congestion": """SELECT zone_id, avg_pickup_delay_min, coalesce(pickups, 0) AS pickups, coalesce(assigned, 0) AS assigned,
        coalesce(abandoned, 0) AS abandoned, CASE WHEN assigned > 0 THEN abandoned / assigned END AS abandonment_rate
        FROM (SELECT a.restaurant_zone_id AS zone_id, avg((epoch_us(b.event_time) - epoch_us(a.event_time)) / 6e7) AS avg_pickup_delay_min,
                     count(*) AS pickups
              FROM ord a JOIN ord b USING (order_id) WHERE a.event_type = 'order_ready_for_pickup'
                AND b.event_type = 'order_picked_up' AND b.event_time >= a.event_time GROUP BY 1) p
        FULL JOIN (SELECT restaurant_zone_id AS zone_id, count(*) FILTER (WHERE event_type = 'courier_assigned_order') AS assigned,
                     count(*) FILTER (WHERE event_type = 'courier_abandoned_delivery') AS abandoned
              FROM cou WHERE event_type IN ('courier_assigned_order', 'courier_abandoned_delivery') GROUP BY 1) l USING (zone_id)""",
    "demand_factor": f"""SELECT event_id, round({_smooth}, 9) AS demand_factor, round({_step}, 9) AS step_factor
        FROM ord WHERE event_type = 'order_created'""",
    "user_cancel_risk": _route(
        _CREATED,
        "restaurant_zone_id",
        "user_zone_id",
        """event_id, least(0.3e0, 0.002e0 * actual_prep_time * user_cancel_sensitivity
           + 0.0015e0 * estimated_delivery_time * user_cancel_sensitivity) AS cancel_risk""",
    ),
    "courier_cancel_risk": _route(
        _ASSIGNED,
        "courier_zone_id",
        "restaurant_zone_id",
        """event_id, least(0.25e0, 0.001e0 + 0.02e0 * zone_hops_to_restaurant * pickup_cancel_factor
           + 0.008e0 * mean_time_min * pickup_cancel_factor) AS cancel_risk""",
    ),
    "restaurant_cancel_risk": """SELECT event_id, least(0.05e0, 0.005e0 + 0.001e0 * actual_prep_time) AS cancel_risk
        FROM ord WHERE event_type = 'order_ready_for_pickup'""",
    "expected_eta": _route(
        _CREATED,
        "restaurant_zone_id",
        "user_zone_id",
        "event_id, mean_time_min * (1e0 + base_delay_probability * 0.35e0) AS expected_eta_min",
    ),
    "backfill_category": """SELECT event_id, event_type, order_id, category AS restaurant_category
        FROM ord LEFT JOIN category USING (order_id)""",
    "match_multiplier": """SELECT event_id, order_id, user_zone_id, restaurant_category, coalesce(multiplier, 1e0) AS multiplier
        FROM ord LEFT JOIN multipliers m ON m.zone_id = user_zone_id AND m.category = restaurant_category
        WHERE event_type = 'order_created'""",
    "restaurant_weight": """, w AS (SELECT restaurant_id, zone_id, category, greatest(0.01e0, coalesce(multiplier, 1e0)
          * CASE WHEN category IN ('mexican', 'burger') THEN 1.25e0 ELSE 1e0 END
          * CASE matchday_sensitivity WHEN 'high' THEN 1.2e0 WHEN 'low' THEN 0.9e0 ELSE 1e0 END) AS weight
          FROM rest LEFT JOIN multipliers USING (zone_id, category))
        SELECT restaurant_id, zone_id, category, round(weight, 9) AS weight,
          round(weight / sum(weight) OVER (PARTITION BY zone_id), 9) AS zone_share FROM w""",
    "prep_pressure": """SELECT event_id, order_id, restaurant_id,
        greatest(5e0, base_prep_time_mean_min * latency_pressure_factor) AS expected_prep_min,
        greatest(5e0, base_prep_time_mean_min) AS estimated_prep_min,
        greatest(5e0, base_prep_time_mean_min * latency_pressure_factor) - greatest(5e0, base_prep_time_mean_min) AS prep_gap_min
        FROM ord JOIN rest USING (restaurant_id) WHERE event_type = 'order_created'""",
    "zone_demand_share": f"""SELECT zone_id, CAST(hour(hour_start) AS INTEGER) AS hour,
        round(least(0.99e0, spawn_probability * {_hour_smooth} * 0.15e0), 9) AS spawn_share
        FROM zones, (SELECT unnest(generate_series(TIMESTAMP '2024-01-06', TIMESTAMP '2024-01-06 23:00:00', INTERVAL '1 hour')) AS hour_start)""",
    "match_day_tag": """SELECT event_id, order_id, event_type, event_time, zone_id,
        CASE WHEN EXISTS (SELECT 1 FROM schedule s WHERE s.primary_zone = o.zone_id AND
            (o.week_minute - (s.dow * 1440 + s.start_minute) + 10080) % 10080 < 120) THEN 'primary'
          WHEN EXISTS (SELECT 1 FROM schedule s WHERE s.secondary_zone = o.zone_id AND
            (o.week_minute - (s.dow * 1440 + s.start_minute) + 10080) % 10080 < 120) THEN 'secondary'
          ELSE 'none' END AS match_role
        FROM (SELECT *, user_zone_id AS zone_id,
              (isodow(event_time) - 1) * 1440 + hour(event_time) * 60 + minute(event_time) AS week_minute FROM ord) o""",
}
_KINDS = ", ".join(f"'{kind}'" for kind in [*ORDER_EVENT_TYPES, "courier_assigned_order"])
_LEGAL = ", ".join(f"'{stage or ''}>{event}'" for stage, after in TRANSITIONS.items() for event in after)
_SQL["lifecycle_transitions"] = f""", hard AS (
  SELECT DISTINCT order_id, event_type, epoch_us(event_time) + CAST(60000000 AS BIGINT) * CASE
      WHEN event_type = 'order_delivered' AND e % 61 = 0 THEN 21600
      WHEN event_type = 'order_delivered' AND e % 53 = 0 THEN 300
      WHEN event_type = 'order_picked_up' AND e % 59 = 0 THEN 240 ELSE 0 END AS us
  FROM (SELECT *, CAST(substr(order_id, 4) AS BIGINT) AS e FROM feed WHERE order_id IS NOT NULL)
  WHERE e % 67 <> 0 AND e % 71 <> 0 AND event_type IN ({_KINDS})
), gaps AS (
  SELECT *, us - lag(us) OVER (PARTITION BY order_id ORDER BY us, rank) AS gap
  FROM (SELECT *, list_position([{_KINDS}], event_type) AS rank FROM hard)
), lives AS (
  SELECT *, sum(CASE WHEN gap IS NULL OR gap > 604800000000 THEN 1 ELSE 0 END)
      OVER (PARTITION BY order_id ORDER BY us, rank) AS life FROM gaps
), steps AS (
  SELECT *, last_value(CASE WHEN event_type LIKE 'order%' THEN event_type END IGNORE NULLS)
      OVER (PARTITION BY order_id, life ORDER BY us, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS stage,
    min(us) OVER (PARTITION BY order_id, life) AS first_us,
    row_number() OVER (PARTITION BY order_id, life ORDER BY us, rank) AS events,
    lead(us) OVER (PARTITION BY order_id, life ORDER BY us, rank) - us AS silence FROM lives
), judged AS (
  SELECT *, event_type LIKE 'order%' AND coalesce(stage, '') || '>' || event_type NOT IN ({_LEGAL}) AS broken FROM steps
), summed AS (
  SELECT *, count(*) FILTER (WHERE broken) OVER (PARTITION BY order_id, life ORDER BY us, rank) AS illegal FROM judged
), ready AS (
  SELECT order_id, min(first_us) AS first_us, min(us) FILTER (WHERE event_type = 'order_ready_for_pickup') AS ready_us,
    min(us) FILTER (WHERE event_type IN ('courier_assigned_order', 'order_delivered') OR event_type LIKE 'order_cancelled%') AS taken_us
  FROM lives JOIN (SELECT order_id, life, min(us) AS first_us FROM lives GROUP BY ALL) USING (order_id, life) GROUP BY order_id, life
)
SELECT order_id, 'illegal' AS kind, make_timestamp(us) AS at, stage AS from_event, event_type AS event,
  make_timestamp(first_us) AS first_at, CAST(NULL AS BIGINT) AS events, CAST(NULL AS BIGINT) AS illegal FROM summed WHERE broken
UNION ALL SELECT order_id, 'quiet', make_timestamp(us + 14400000000), NULL, event_type, make_timestamp(first_us), events, illegal
FROM summed WHERE silence IS NULL OR silence > 14400000000
UNION ALL SELECT order_id, 'stuck', make_timestamp(ready_us + 900000000), NULL, 'order_ready_for_pickup', make_timestamp(first_us), NULL, NULL
FROM ready WHERE ready_us IS NOT NULL AND (taken_us IS NULL OR taken_us > ready_us + 900000000)"""
_SQL["lifecycle_transitions_stream"] = _SQL["lifecycle_transitions"]


def _long_rows(sink, source, key, *metrics):
    pairs = ", ".join(f"{{'metric': '{m}', 'value': CAST({m} AS DOUBLE)}}" for m in metrics)
    return f"""SELECT '{sink}' AS sink, window_start AS at, {key} AS key, x.metric AS metric, x.value AS value
FROM (SELECT *, unnest([{pairs}]) AS x FROM {source})"""


_DELIVERY = ("event_count", "orders_created", "orders_delivered", "avg_delivery_time_min")
_ONCE = f"""count(*) AS event_count, count(*) FILTER (WHERE event_type = 'order_created') AS orders_created,
    count(*) FILTER (WHERE event_type = 'order_delivered') AS orders_delivered, avg(actual_delivery_time) AS avg_delivery_time_min
    FROM (SELECT DISTINCT {_ORDER_COLUMNS} FROM ord)"""
_PANE = "time_bucket(INTERVAL '5 minutes', event_time)"
_COPIES = """SELECT '{sink}' AS sink, date_trunc('milliseconds', event_time) AS at, event_id AS key, 'copies' AS metric,
CAST(sum(1 + CASE WHEN CAST(substr(order_id, 4) AS BIGINT) % 20 = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS value FROM {feed} GROUP BY ALL"""
_SQL["multi_query_rows"] = f""", once AS (SELECT {_PANE} AS window_start, {_ONCE} GROUP BY 1),
once_by_zone AS (SELECT window_start - INTERVAL '5 minutes' * back AS window_start, user_zone_id AS zone_id, {_ONCE.replace(
    "FROM (SELECT DISTINCT", f"FROM (SELECT {_PANE} AS window_start, unnest([0, 1]) AS back, * FROM (SELECT DISTINCT")}) GROUP BY 1, 2),
flags AS (SELECT {_PANE} AS window_start, user_zone_id AS zone_id, count(*) AS total_events,
    count(*) FILTER (WHERE anomaly_flag) AS anomaly_count, avg(actual_delivery_time) AS avg_delivery_min
    FROM (SELECT DISTINCT {_ORDER_COLUMNS} FROM ord) GROUP BY 1, 2),
rates AS (SELECT *, anomaly_count / total_events AS anomaly_rate,
    avg_delivery_min > 45 OR anomaly_count / total_events > 0.05 AS zone_flagged FROM flags)
{_COPIES.format(sink="orders", feed="ord")}
UNION ALL {_COPIES.format(sink="couriers", feed="cou")}
UNION ALL {_long_rows("kpi_orders_5min_tumbling", "once", "'-'", *_DELIVERY)}
UNION ALL {_long_rows("kpi_orders_10min_hop5", "once_by_zone", "coalesce(zone_id, '-')", *_DELIVERY)}
UNION ALL {_long_rows("kpi_zone_health", "health", "coalesce(zone_id, '-')", "orders_awaiting_pickup", "couriers_dispatched", "supply_gap")}
UNION ALL {_long_rows("kpi_anomaly_zones", "rates", "coalesce(zone_id, '-')", "total_events", "anomaly_count", "avg_delivery_min", "anomaly_rate", "zone_flagged")}"""
_SQL["out_of_order_swapped"] = """SELECT event_id, order_id, event_type, event_time, latest_before,
    (epoch_us(latest_before) - epoch_us(event_time)) / 6e7 AS behind_min
  FROM (SELECT *, max(event_time) OVER (PARTITION BY order_id ORDER BY ingestion_time, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest_before
    FROM (SELECT event_id, event_type, ingestion_time, order_id, CASE WHEN e % 71 <> 0 THEN event_time + to_minutes(CASE
        WHEN event_type = 'order_delivered' AND e % 61 = 0 THEN 21600
        WHEN event_type = 'order_delivered' AND e % 53 = 0 THEN 300
        WHEN event_type = 'order_picked_up' AND e % 59 = 0 THEN 240 ELSE 0 END) END AS event_time
      FROM (SELECT *, CAST(substr(order_id, 4) AS BIGINT) AS e FROM ord) WHERE e % 67 <> 0)) WHERE event_time < latest_before"""
_SQL["out_of_order_stream"] = _SQL["out_of_order_swapped"]
_SQL["courier_activity_rollup"] = """SELECT time_bucket(INTERVAL '1 day', event_time) AS bucket,
    count(DISTINCT courier_id) FILTER (WHERE event_type = 'courier_assigned_order') AS active_couriers,
    count(DISTINCT courier_id) FILTER (WHERE event_type = 'courier_online') AS online_couriers
  FROM cou WHERE event_type IN ('courier_assigned_order', 'courier_online') GROUP BY 1"""
_SQL["courier_activity_rollup_stream"] = _SQL["courier_activity_rollup"]
_SQL["delivery_percentiles_sketch"] = """SELECT time_bucket(INTERVAL '15 minutes', delivered_at) AS bucket, count(*) AS n,
    quantile_disc(full_delivery_min, 0.5) AS p50, quantile_disc(full_delivery_min, 0.95) AS p95 FROM cd GROUP BY 1"""
_CATEGORY_NAMES = ", ".join(f"'{name}'" for name in CATEGORIES)
_SQL["restaurant_weight_at"] = f""", promo AS (
  SELECT [{_CATEGORY_NAMES}][n_nationkey % 7 + 1] AS category,
    TIMESTAMP '2024-01-01' + to_hours(CAST(n_nationkey * 7 % 100 AS BIGINT)) AS valid_from,
    TIMESTAMP '2024-01-01' + to_hours(CAST(n_nationkey * 7 % 100 + n_nationkey + 6 AS BIGINT)) AS valid_to,
    (11 + n_nationkey % 9) / 10e0 AS multiplier FROM nation
), times AS (SELECT DISTINCT time_bucket(INTERVAL '1 hour', event_time) AS "at" FROM ord
    WHERE event_type = 'order_created' AND event_time < TIMESTAMP '2024-01-04'
), held AS (SELECT "at", category, arg_max(multiplier, (valid_from, multiplier)) AS factor
    FROM times JOIN promo ON "at" >= valid_from AND "at" < valid_to GROUP BY ALL
), w AS (SELECT "at", restaurant_id, zone_id, category, greatest(0.01e0, coalesce(m.multiplier, 1e0) * coalesce(factor, 1e0)
      * CASE matchday_sensitivity WHEN 'high' THEN 1.2e0 WHEN 'low' THEN 0.9e0 ELSE 1e0 END) AS weight
    FROM times CROSS JOIN rest LEFT JOIN multipliers m USING (zone_id, category) LEFT JOIN held USING ("at", category))
SELECT "at", restaurant_id, zone_id, category, round(weight, 9) AS weight,
  round(weight / sum(weight) OVER (PARTITION BY "at", zone_id), 9) AS zone_share FROM w"""
_SQL["order_kpis_from_facts"] = _SQL["order_kpis"]
_SQL["stage_times_from_facts"] = _SQL["stage_times"]
_SQL["at_risk_from_facts"] = _SQL["at_risk_orders"]
_SQL["courier_activity"] = _SQL["series_align"]
_SQL["stuck_orders_stream"] = _SQL["stuck_orders"]
_SQL["lifecycle_state_stream"] = _SQL["lifecycle_state"]
_REASONS = [f"CASE WHEN {name} IS NULL THEN 'missing {name}' END" for name in REQUIRED_ORDER_FIELDS] + [
    "CASE WHEN event_type NOT IN (" + ", ".join(f"'{t}'" for t in ORDER_EVENT_TYPES) + ") THEN 'unknown event_type' END",
    "CASE WHEN epoch_us(ingestion_time) - epoch_us(event_time) > 900000000 THEN 'late' END",
]
_JUDGED = f""", judged AS (SELECT event_id, event_type, list_filter([{", ".join(_REASONS)}], lambda r: r IS NOT NULL) AS reasons
  FROM (SELECT * REPLACE (CASE WHEN e % 67 <> 0 THEN order_id END AS order_id,
      CASE WHEN coalesce(e % 71 <> 0, true) THEN event_time + to_minutes(CASE
        WHEN event_type = 'order_delivered' AND e % 61 = 0 THEN 21600
        WHEN event_type = 'order_delivered' AND e % 53 = 0 THEN 300
        WHEN event_type = 'order_picked_up' AND e % 59 = 0 THEN 240 ELSE 0 END) END AS event_time)
    FROM (SELECT *, CAST(substr(order_id, 4) AS BIGINT) AS e FROM ord)))"""
_SQL["quarantine_rows"] = f"""{_JUDGED}
SELECT event_id, event_type, coalesce(array_to_string(list_sort(reasons), ', '), '') AS reasons FROM judged"""
_SQL["quarantine_counts"] = f"""{_JUDGED}
SELECT 'read' AS what, count(*) AS events FROM judged
UNION ALL SELECT 'kept', count(*) FROM judged WHERE len(reasons) = 0
UNION ALL SELECT 'quarantined', count(*) FROM judged WHERE len(reasons) > 0
UNION ALL SELECT rule, count(event_id) FROM (SELECT unnest([{", ".join(f"'missing {n}'" for n in REQUIRED_ORDER_FIELDS)},
    'unknown event_type', 'late']) AS rule) LEFT JOIN judged ON list_contains(reasons, rule) GROUP BY 1"""

ORACLE = {name: _CTES + sql for name, sql in _SQL.items()}
