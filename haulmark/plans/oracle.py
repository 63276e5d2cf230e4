"""The registered queries in DuckDB SQL, over the same tables."""

from __future__ import annotations

from haulmark.plans.stand_ins import TABLES

PINGS = """pings AS (
  SELECT printf('DRV_%04d', user_id) AS driver_id,
         40.7128::DOUBLE + (value / 1000.0::DOUBLE - 0.5::DOUBLE) * 0.1::DOUBLE AS latitude,
         -74.0060::DOUBLE + (value / 1000.0::DOUBLE - 0.5::DOUBLE) * 0.1::DOUBLE AS longitude,
         ts AS "timestamp",
         value AS speed,
         0.0::DOUBLE + (value / 1000.0::DOUBLE) * 360.0::DOUBLE AS heading,
         CASE event_type WHEN 'view' THEN 'idle' WHEN 'click' THEN 'moving' WHEN 'error' THEN 'moving'
              WHEN 'signup' THEN 'pickup' WHEN 'purchase' THEN 'dropoff' END AS status
  FROM events)"""

STATUS = """CASE event_type WHEN 'purchase' THEN 'delivered' WHEN 'click' THEN 'in_transit'
              WHEN 'signup' THEN 'picked_up' WHEN 'view' THEN 'assigned'
              WHEN 'error' THEN 'cancelled' END AS status"""

UPDATES = f"""updates AS (
  SELECT printf('ORD_%06d', event_id) AS order_id,
         printf('DRV_%04d', user_id) AS driver_id,
         printf('CUST_%06d', user_id) AS customer_id,
         {STATUS},
         ts AS "timestamp",
         40.7128::DOUBLE + (value / 1000.0::DOUBLE - 0.5::DOUBLE) * 0.1::DOUBLE AS lat,
         -74.0060::DOUBLE + (value / 1000.0::DOUBLE - 0.5::DOUBLE) * 0.1::DOUBLE AS lng,
         ts + to_minutes(CAST(json_extract(props, '$.k') AS INTEGER)) AS estimated_arrival,
         CASE WHEN event_type <> 'view' AND floor(value) >= 60 THEN 'traffic' END AS delay_reason,
         CASE WHEN event_type <> 'view' THEN CAST(floor(value) AS INTEGER) END AS delay_minutes
  FROM events)"""

ALERTS = (
    UPDATES
    + """, alerts AS (
  SELECT 'high_delay' AS anomaly_type, order_id, delay_minutes, "timestamp"
  FROM updates WHERE delay_minutes >= 120
  UNION ALL
  SELECT 'cancellation' AS anomaly_type, order_id, delay_minutes, "timestamp"
  FROM updates WHERE status = 'cancelled')"""
)



def to_one_decimal(number: str) -> str:
    """Half up on the number as it is written; rounding the double itself would first
    multiply it by ten and so lift 0.44999999999999996 to 0.5."""
    return f"CAST(round(CAST(CAST({number} AS VARCHAR) AS DECIMAL(38, 18)), 1) AS DOUBLE)"


MEAN_DELAY = f"coalesce({to_one_decimal('avg(delay_minutes)')}, 0.0::DOUBLE)"

AS_OF = "(SELECT max(ts) FROM events)"

PER_MINUTE = """SELECT time_bucket(INTERVAL '1 minute', "timestamp") AS window_start,
       time_bucket(INTERVAL '1 minute', "timestamp") + INTERVAL '1 minute' AS window_end,
       status, count(*) AS delivery_count
FROM updates WHERE "timestamp" IS NOT NULL GROUP BY ALL"""

ALL_COUNTS = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}" for name in TABLES
)

HOURLY_TREND = f"""WITH {UPDATES}
SELECT date_trunc('hour', "timestamp") AS hour, count(*) AS deliveries, avg(delay_minutes) AS avg_delay
FROM updates WHERE "timestamp" > {AS_OF} - INTERVAL '7 days' GROUP BY 1 ORDER BY 1"""

ORACLE = {
    "ingest_driver_pings": f"WITH {PINGS} SELECT * FROM pings",
    "ingest_delivery_updates": f"WITH {UPDATES} SELECT *, lat AS text_lat, lng AS text_lng FROM updates",
    "ingest_traffic_updates": """
SELECT printf('AREA_%03d', user_id % 50 + 1) AS area_id,
       ts AS "timestamp",
       CASE event_type WHEN 'click' THEN 'low' WHEN 'view' THEN 'medium' WHEN 'signup' THEN 'high'
            WHEN 'purchase' THEN 'very_high' WHEN 'error' THEN 'very_high' END AS traffic_density,
       value AS average_speed,
       CAST(json_extract(props, '$.k') AS INTEGER) % 4 AS incidents,
       CASE CAST(json_extract(props, '$.k') AS INTEGER) % 4 WHEN 0 THEN 'clear' WHEN 1 THEN 'rain'
            WHEN 2 THEN 'fog' WHEN 3 THEN 'storm' END AS weather_condition
FROM events""",
    "encode_events_json": f"""WITH {UPDATES}
SELECT '{{' || concat_ws(',',
         '"order_id":"' || order_id || '"',
         '"driver_id":"' || driver_id || '"',
         '"customer_id":"' || customer_id || '"',
         '"status":"' || status || '"',
         '"timestamp":"' || strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') || '"',
         '"estimated_arrival":"' || strftime(estimated_arrival, '%Y-%m-%dT%H:%M:%S.%f') || '"',
         '"delay_reason":"' || delay_reason || '"',
         '"delay_minutes":' || delay_minutes) || '}}' AS message, lat, lng
FROM updates""",
    "replay_events": "SELECT * FROM events",
    "append_pings_to_table": f"""WITH {PINGS}
SELECT *, CAST("timestamp" AS DATE) AS event_date FROM pings""",
    "kpi_status_per_minute": f"WITH {UPDATES} {PER_MINUTE}",
    "kpi_stream_update": f"WITH {UPDATES} {PER_MINUTE}",
    "kpi_late_rows": f"""WITH bounds AS (SELECT min(ts) AS least, epoch(max(ts)) - epoch(min(ts)) + 1 AS span FROM events),
given AS (
    SELECT {STATUS},
           CASE WHEN event_id % 97 <> 5 THEN ts END AS t,
           least(floor((epoch(ts) - epoch(least)) * 8 / span) + CASE WHEN event_id % 10 = 3 THEN 2 ELSE 0 END, 7) AS batch
    FROM events, bounds
), newest AS (
    SELECT batch, max(max(t)) OVER (ORDER BY batch) AS t FROM given GROUP BY batch
), judged AS (
    SELECT status, given.t, date_trunc('minute', given.t) AS minute,
           given.t IS NOT NULL AND newest.t IS NOT NULL
           AND date_trunc('minute', given.t) + INTERVAL '1 minute' <= date_trunc('millisecond', newest.t) - INTERVAL '2 minutes' AS late
    FROM given LEFT JOIN newest ON newest.batch = given.batch - 2
)
SELECT status, count(*) AS events, count(*) FILTER (WHERE t IS NULL) AS without_time,
       count(*) FILTER (WHERE t IS NOT NULL AND NOT late) AS counted,
       count(DISTINCT minute) FILTER (WHERE NOT late) AS minutes, count(*) FILTER (WHERE late) AS too_late
FROM judged GROUP BY status""",
    "kpi_stream_closed": f"""WITH {UPDATES}, counts AS ({PER_MINUTE})
SELECT * FROM counts
WHERE window_end <= date_trunc('millisecond', {AS_OF}) - INTERVAL '2 minutes'""",
    "alerts_stream": f"WITH {ALERTS} SELECT * FROM alerts",
    "streams_together": f"""WITH {UPDATES}, counts AS ({PER_MINUTE})
SELECT 'driver_locations' AS table_name, count(*) AS row_count FROM events
UNION ALL SELECT 'delivery_analytics', count(*) FROM updates
UNION ALL SELECT 'status_counts', count(*) FROM counts""",
    "stream_progress": """
SELECT 'counts' AS query_name, count(*) AS input_rows, CAST(0 AS BIGINT) AS late_rows_dropped FROM events
UNION ALL SELECT 'slices', count(*), CAST(0 AS BIGINT) FROM events""",
    "insert_into_stored_updates": f"""WITH {UPDATES}
SELECT order_id, status, "timestamp", delay_minutes, CAST("timestamp" AS DATE) AS event_date FROM updates""",
    "insert_by_two_clients": f"""WITH {UPDATES}
SELECT order_id, status, "timestamp", delay_minutes, CAST("timestamp" AS DATE) AS event_date FROM updates""",
    "compacted_updates": f"""WITH {UPDATES}
SELECT order_id, status, "timestamp", delay_minutes, CAST("timestamp" AS DATE) AS event_date FROM updates""",
    "alerts_of_stored_records": f"""WITH {ALERTS}
SELECT * FROM alerts WHERE "timestamp" > {AS_OF} - INTERVAL '7 days'""",
    "report_active_drivers": f"""WITH {PINGS}
SELECT count(DISTINCT driver_id) AS active_drivers FROM pings
WHERE "timestamp" > {AS_OF} - INTERVAL '24 hours' AND status <> 'idle'""",
    "report_deliveries_today": f"""WITH {UPDATES}
SELECT count(*) AS deliveries_today FROM updates
WHERE CAST("timestamp" AS DATE) = CAST({AS_OF} AS DATE) AND status = 'delivered'""",
    "report_avg_delay": f"""WITH {UPDATES}
SELECT {MEAN_DELAY} AS avg_delay FROM updates
WHERE "timestamp" > {AS_OF} - INTERVAL '24 hours' AND delay_minutes > 0""",
    "report_kpi_record": f"""WITH {PINGS}, {ALERTS}
SELECT (SELECT count(DISTINCT driver_id) FROM pings
        WHERE "timestamp" > {AS_OF} - INTERVAL '24 hours' AND status <> 'idle') AS active_drivers,
       (SELECT count(*) FROM updates
        WHERE CAST("timestamp" AS DATE) = CAST({AS_OF} AS DATE) AND status = 'delivered') AS deliveries_today,
       (SELECT {MEAN_DELAY} FROM updates
        WHERE "timestamp" > {AS_OF} - INTERVAL '24 hours' AND delay_minutes > 0) AS avg_delay,
       (SELECT count(*) FROM alerts) AS active_alerts""",
    "report_recent_positions": f"""WITH {PINGS}
SELECT driver_id, latitude, longitude, speed, status FROM pings
WHERE "timestamp" > {AS_OF} - INTERVAL '24 hours'""",
    "report_hourly_trend": HOURLY_TREND,
    "trend_of_stored_updates": HOURLY_TREND,
    "table_row_counts": f"{ALL_COUNTS} UNION ALL SELECT 'delivery_analytics', CAST(NULL AS BIGINT)",
    "list_tables": ALL_COUNTS,
    "alerts_high_delay": f"WITH {ALERTS} SELECT * FROM alerts WHERE anomaly_type = 'high_delay'",
    "alerts_cancellation": f"WITH {ALERTS} SELECT * FROM alerts WHERE anomaly_type = 'cancellation'",
    "alerts_all": f"WITH {ALERTS} SELECT * FROM alerts",
    "alerts_by_key_prefix": f"""WITH {ALERTS}
SELECT 'alert:' || concat_ws(':', anomaly_type, order_id,
                             strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f')) AS "key", *
FROM alerts""",
    "alert_count": f"WITH {ALERTS} SELECT count(*) AS active_alerts FROM alerts",
    "alert_type_or_unknown": f"""WITH {UPDATES}
SELECT order_id, CASE WHEN status = 'cancelled' THEN 'cancellation'
                      WHEN delay_minutes >= 120 THEN 'high_delay' ELSE 'unknown' END AS anomaly_type
FROM updates""",
    "alert_messages": f"""WITH {ALERTS}, lines AS (
SELECT order_id, anomaly_type,
       CASE anomaly_type WHEN 'high_delay' THEN '🚨 High Delay: Order ' || order_id || ' - ' || delay_minutes || ' min'
                         WHEN 'cancellation' THEN '❌ Cancellation: Order ' || order_id END AS message
FROM alerts)
SELECT * FROM lines WHERE message IS NOT NULL""",
    "latest_alerts": f"""WITH {ALERTS}
SELECT * FROM alerts ORDER BY "timestamp" DESC NULLS LAST, order_id DESC, anomaly_type DESC LIMIT 5""",
    "insert_if_absent": """
SELECT l_orderkey AS order_key, l_shipdate AS shipped, l_linenumber AS line, l_suppkey AS supplier
FROM lineitem
WHERE l_orderkey IS NULL
   OR l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderkey IS NOT NULL)
QUALIFY l_orderkey IS NULL
     OR row_number() OVER (
       PARTITION BY l_orderkey
       ORDER BY l_shipdate NULLS FIRST, l_linenumber NULLS FIRST, l_suppkey NULLS FIRST) = 1""",

    "insert_by_key_table": """
SELECT l_orderkey AS order_key, l_shipdate AS shipped, l_linenumber AS line, l_suppkey AS supplier
FROM lineitem
WHERE l_orderkey IS NULL
   OR l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderkey IS NOT NULL)
QUALIFY l_orderkey IS NULL
     OR row_number() OVER (
       PARTITION BY l_orderkey
       ORDER BY l_shipdate NULLS FIRST, l_linenumber NULLS FIRST, l_suppkey NULLS FIRST) = 1""",    "partition_lag": f"""
WITH sent AS (
  SELECT CASE event_type WHEN 'view' THEN 'driver_locations' WHEN 'error' THEN 'traffic_conditions'
              ELSE 'delivery_status' END AS topic,
         CAST(user_id % 3 AS INTEGER) AS "partition", ts
  FROM events),
ends AS (SELECT topic, "partition", count(*) AS end_offset FROM sent GROUP BY ALL),
reads AS (
  SELECT topic, "partition", count(*) AS committed_offset FROM sent
  WHERE NOT (ts > {AS_OF} - INTERVAL '24 hours') AND topic <> 'traffic_conditions' GROUP BY ALL)
SELECT topic, "partition", end_offset, committed_offset,
       end_offset - coalesce(committed_offset, 0) AS lag
FROM ends LEFT JOIN reads USING (topic, "partition")""",
    "project_ping_columns": f"WITH {PINGS} SELECT driver_id, latitude, longitude, speed, status FROM pings",
    "derive_entity_ids": """
SELECT event_id, 'driver_' || event_id % 5 AS driver_id, 'del_' || event_id AS delivery_id,
       'cust_' || event_id AS customer_id
FROM events""",
    "classify_status": """
SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'delivered' WHEN 1 THEN 'in_transit' ELSE 'picked_up' END AS status,
       'NYC' AS location
FROM events""",
    "rescale_to_coordinate": """
SELECT event_id,
       40.7128::DOUBLE + (value / 1000.0::DOUBLE - 0.5::DOUBLE) * 0.1::DOUBLE AS latitude,
       -74.0060::DOUBLE + (value / 1000.0::DOUBLE - 0.5::DOUBLE) * 0.1::DOUBLE AS longitude,
       20.0::DOUBLE + (value / 1000.0::DOUBLE) * 60.0::DOUBLE AS speed,
       0.0::DOUBLE + (value / 1000.0::DOUBLE) * 360.0::DOUBLE AS heading
FROM events""",
    "format_entity_ids": """
SELECT event_id, printf('ORD_%06d', event_id) AS order_id, printf('DRV_%04d', user_id) AS driver_id,
       printf('CUST_%06d', user_id) AS customer_id, printf('AREA_%03d', user_id % 50 + 1) AS area_id
FROM events""",
    "estimate_arrival": """
SELECT event_id, ts + to_minutes(CAST(json_extract(props, '$.k') AS INTEGER)) AS estimated_arrival,
       ts - to_minutes(CAST(json_extract(props, '$.k') AS INTEGER)) AS order_time
FROM events""",
    "flatten_location": """
SELECT event_id,
       40.7128::DOUBLE + (value / 1000.0::DOUBLE - 0.5::DOUBLE) * 0.1::DOUBLE AS lat,
       -74.0060::DOUBLE + (value / 1000.0::DOUBLE - 0.5::DOUBLE) * 0.1::DOUBLE AS lng
FROM events""",
    "round_rating": f"SELECT event_id, {to_one_decimal('value')} AS rating FROM events",
}
