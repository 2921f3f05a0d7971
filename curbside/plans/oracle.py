"""The registered queries in DuckDB SQL, for the equality check.

Every statement starts from the ``events`` view and goes through named steps; ``statement``
prepends the steps a query needs.
"""

from __future__ import annotations

import re


def r(x: str, digits: int = 2) -> str:
    """Half-up rounding of the shortest decimal text, as Spark rounds a double."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,20)), {digits}) AS DOUBLE)"


def total(x: str) -> str:
    """An exact decimal sum."""
    return f"CAST(sum(CAST(CAST({x} AS VARCHAR) AS DECIMAL(28,6))) AS DOUBLE)"


def mean(x: str) -> str:
    return f"({total(x)} / nullif(count({x}), 0))"


def n(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def pct(part: str, whole: str) -> str:
    return r(f"({part} / greatest({whole}, 1) * 100)")


_PAYLOAD = ("ride_id, driver_id, rider_id, city, event_type, trip_distance, fare_amount, "
            "surge_multiplier, event_timestamp, schema_version")

SILVER_COLUMNS = (
    "ride_id, driver_id, rider_id, city, event_type, trip_distance, fare_amount, net_fare, "
    "surge_multiplier, event_ts, event_date, event_hour, event_minute, schema_version, "
    "has_data_quality_issue, dq_invalid_event_type, dq_fare_out_of_range, "
    "dq_distance_out_of_range, dq_null_driver, dq_null_rider, ingestion_ts, silver_version")

STEPS: dict[str, str] = {}

STEPS["base"] = """
SELECT event_id, user_id, event_type AS kind, value,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_id // 8 AS ride,
       make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 60 + 64800000000)
         AS event_time
FROM events"""

STEPS["placed"] = """
SELECT *, CASE WHEN ride % 2 = 0 THEN 'New York' WHEN ride % 3 = 0 THEN 'Chicago'
               WHEN ride % 5 = 0 THEN 'Miami' ELSE 'Denver' END AS town FROM base"""

STEPS["rides"] = """
SELECT CASE WHEN event_id % 97 <> 0 THEN 'RIDE-' || ride END AS ride_id,
       CASE WHEN event_id % 53 <> 0 THEN 'DRV-' || (user_id % 6) END AS driver_id,
       CASE WHEN event_id % 59 <> 0 THEN 'RDR-' || user_id END AS rider_id,
       CASE WHEN event_id % 7 = 0 THEN '  ' || lower(town) || ' ' ELSE town END AS city,
       CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 83 = 0 THEN 'ride_rated'
            WHEN kind = 'view' THEN 'ride_requested' WHEN kind = 'click' THEN 'driver_assigned'
            WHEN kind = 'signup' THEN 'trip_started' WHEN kind = 'purchase' THEN 'trip_completed'
            WHEN kind = 'error' THEN 'payment_completed' END AS event_type,
       CASE WHEN event_id % 61 = 0 THEN NULL WHEN event_id % 67 = 0 THEN k * 1000.0::DOUBLE
            ELSE k / 2.0::DOUBLE END AS trip_distance,
       CASE WHEN event_id % 71 = 0 THEN NULL WHEN event_id % 73 = 0 THEN -1.0::DOUBLE
            WHEN event_id % 79 = 0 THEN 99999.0::DOUBLE ELSE value END AS fare_amount,
       CASE town WHEN 'New York' THEN 1.5::DOUBLE WHEN 'Chicago' THEN 1.2::DOUBLE
                 WHEN 'Miami' THEN 1.6::DOUBLE ELSE 1.0::DOUBLE END AS surge_multiplier,
       strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS event_timestamp,
       '1.0' AS schema_version, event_time,
       event_time + to_seconds(event_id % 600) AS ingestion_ts,
       event_id AS kafka_offset, CAST(event_id % 10 AS INTEGER) AS kafka_partition,
       'ride-events' AS kafka_topic
FROM placed"""



def _json(**renamed: str) -> str:
    """The payload as text: fields that are not NULL, in order."""
    text = ("ride_id", "driver_id", "rider_id", "city", "event_type")
    more = (("timestamp", "event_timestamp"), ("kafka_partition_key", "city"), ("schema_version", "schema_version"))
    def field(name: str, value: str, quote: str) -> str:
        return f"""CASE WHEN {value} IS NOT NULL THEN '"{name}":{quote}' || {value} || '{quote}' END"""
    fields = [*(field(x, x, '"') for x in text),
              *(field(x, f"CAST({x} AS VARCHAR)", "") for x in ("trip_distance", "fare_amount", "surge_multiplier")),
              *(field(x, y, '"') for x, y in more)]
    return f"'{{' || array_to_string(list_filter([{', '.join(fields)}], lambda x: x IS NOT NULL), ',') || '}}'"


STEPS["bronze"] = f"""
SELECT {_PAYLOAD}, {_json()} AS raw_value, city AS raw_key, ingestion_ts, kafka_offset, kafka_partition, kafka_topic,
       CAST(ingestion_ts AS DATE) AS event_date, event_time
FROM rides"""

# What is left of the damaged messages.
STEPS["faulty"] = """
SELECT * REPLACE (
  CASE WHEN kafka_offset % 11 <> 0 THEN ride_id END AS ride_id, CASE WHEN kafka_offset % 11 <> 0 THEN driver_id END AS driver_id,
  CASE WHEN kafka_offset % 11 <> 0 THEN rider_id END AS rider_id, CASE WHEN kafka_offset % 11 <> 0 THEN city END AS city,
  CASE WHEN kafka_offset % 11 <> 0 THEN event_type END AS event_type,
  CASE WHEN kafka_offset % 11 <> 0 THEN trip_distance END AS trip_distance,
  CASE WHEN kafka_offset % 11 <> 0 AND kafka_offset % 13 <> 0 THEN fare_amount END AS fare_amount,
  CASE WHEN kafka_offset % 11 <> 0 THEN surge_multiplier END AS surge_multiplier,
  CASE WHEN kafka_offset % 11 = 0 THEN NULL WHEN kafka_offset % 13 = 0 THEN event_timestamp
       WHEN kafka_offset % 17 = 0 THEN regexp_replace(event_timestamp, '\\.[0-9]{6}', '')
       WHEN kafka_offset % 19 = 0 THEN 'x' ELSE event_timestamp END AS event_timestamp,
  CASE WHEN kafka_offset % 11 <> 0 THEN schema_version END AS schema_version,
  CASE WHEN kafka_offset % 11 = 0 THEN '{bad ' || raw_value
       WHEN kafka_offset % 13 = 0 THEN regexp_replace(raw_value, '"fare_amount":([-0-9.E]+)', '"fare_amount":"\\1"')
       WHEN kafka_offset % 17 = 0 THEN regexp_replace(raw_value, '\\.[0-9]{6}\\+00:00', '+00:00')
       WHEN kafka_offset % 19 = 0 THEN regexp_replace(raw_value, '"timestamp":"[^"]*"', '"timestamp":"x"')
       ELSE raw_value END AS raw_value,
  CASE WHEN kafka_offset % 13 <> 0 AND kafka_offset % 17 = 0 THEN date_trunc('second', event_time)
       WHEN kafka_offset % 13 <> 0 AND kafka_offset % 19 = 0 THEN ingestion_ts ELSE event_time END AS event_time)
FROM bronze"""

STEPS["faulty_valid"] = "SELECT * FROM faulty WHERE ride_id IS NOT NULL AND event_type IS NOT NULL"

STEPS["valid"] = "SELECT * FROM bronze WHERE ride_id IS NOT NULL AND event_type IS NOT NULL"

STEPS["dead"] = """
SELECT *, CASE WHEN ride_id IS NULL THEN 'NULL_RIDE_ID' ELSE 'NULL_EVENT_TYPE' END
  AS dead_letter_reason
FROM bronze WHERE ride_id IS NULL OR event_type IS NULL"""

def _cleaned(source: str) -> str:
    """One statement from accepted records to cleaned ones."""
    parts = [STEPS[x] for x in ("imputed", "flagged", "cleaned")]
    return parts[2].replace("FROM flagged", f"FROM ({parts[1].replace('FROM imputed', f'FROM ({parts[0].replace('FROM valid', f'FROM {source}')})')})")


STEPS["imputed"] = """
SELECT * REPLACE (
         array_to_string(list_transform(string_split(lower(trim(city)), ' '),
                                        lambda w: upper(w[1]) || w[2:]), ' ') AS city,
         coalesce(trip_distance, 0.0) AS trip_distance, coalesce(fare_amount, 0.0) AS fare_amount)
FROM valid"""

STEPS["flagged"] = """
SELECT *, event_type NOT IN ('ride_requested', 'driver_assigned', 'trip_started',
                             'trip_completed', 'payment_completed') AS dq_invalid_event_type,
       fare_amount < 0 OR fare_amount > 5000 AS dq_fare_out_of_range,
       trip_distance < 0.1 OR trip_distance > 500 AS dq_distance_out_of_range,
       driver_id IS NULL AS dq_null_driver, rider_id IS NULL AS dq_null_rider
FROM imputed"""

STEPS["cleaned"] = f"""
SELECT * EXCLUDE (event_date, event_time), event_time AS event_ts,
       dq_invalid_event_type OR dq_fare_out_of_range OR dq_distance_out_of_range
         OR dq_null_driver OR dq_null_rider AS has_data_quality_issue,
       CAST(event_time AS DATE) AS event_date,
       CAST(hour(event_time) AS INTEGER) AS event_hour,
       CAST(minute(event_time) AS INTEGER) AS event_minute,
       {r('(fare_amount * 0.82::DOUBLE)')} AS net_fare, '1.0' AS silver_version
FROM flagged"""


def _newest(source: str) -> str:
    return f"""
SELECT * FROM {source}
QUALIFY row_number() OVER (PARTITION BY ride_id, event_type
  ORDER BY ingestion_ts DESC, kafka_offset DESC, kafka_partition DESC) = 1"""


STEPS["silver"] = _newest("cleaned")
STEPS["faulty_cleaned"] = _cleaned("faulty_valid")
STEPS["early"] = _newest("(SELECT * FROM cleaned WHERE ingestion_ts <= (SELECT ts FROM clock) - INTERVAL '6 hours')")
STEPS["first_load"] = _newest("(SELECT * FROM cleaned WHERE kafka_partition < 5)")
STEPS["second_load"] = _newest("(SELECT * FROM cleaned WHERE kafka_partition >= 5)")
STEPS["clock"] = "SELECT max(event_time) AS ts FROM rides"


def _city(source: str) -> str:
    earning = "event_type IN ('trip_completed', 'payment_completed')"
    done = "CASE WHEN event_type = 'trip_completed' THEN fare_amount END"
    return f"""
SELECT time_bucket(INTERVAL '1 minute', event_ts) AS window_start,
       time_bucket(INTERVAL '1 minute', event_ts) + INTERVAL '1 minute' AS window_end,
       CAST(time_bucket(INTERVAL '1 minute', event_ts) AS DATE) AS window_start_date, city,
       count(*) AS total_rides, count(DISTINCT ride_id) AS unique_rides,
       count(*) FILTER (event_type = 'trip_completed') AS completed_rides,
       count(*) FILTER (event_type = 'ride_requested') AS requested_rides,
       count(*) FILTER (event_type = 'payment_completed') AS payment_events,
       {total(f"CASE WHEN {earning} THEN fare_amount ELSE 0 END")} AS total_gross_revenue,
       {total(f"CASE WHEN {earning} THEN net_fare ELSE 0 END")} AS total_net_revenue,
       {mean(done)} AS avg_fare, max(fare_amount) AS max_fare, min(fare_amount) AS min_fare,
       {mean("trip_distance")} AS avg_distance_km, {total("trip_distance")} AS total_distance_km,
       {mean("surge_multiplier")} AS avg_surge_multiplier,
       {pct("count(*) FILTER (event_type = 'trip_completed')",
            "count(*) FILTER (event_type = 'ride_requested')")} AS completion_rate
FROM {source} WHERE NOT has_data_quality_issue GROUP BY ALL"""


def _driver(source: str) -> str:
    return f"""
SELECT *, {r("(utilization_rate * 0.6::DOUBLE + least(avg_earnings_per_trip / 50.0::DOUBLE * 100, "
             "100.0::DOUBLE) * 0.4::DOUBLE)")} AS efficiency_score
FROM (
  SELECT *, {pct("trips_completed", "trips_assigned")} AS utilization_rate,
         {r("(total_earnings / greatest(trips_completed, 1))")} AS avg_earnings_per_trip
  FROM (
    SELECT window_start, window_start + INTERVAL '15 minutes' AS window_end,
           CAST(window_start AS DATE) AS window_start_date, driver_id, city,
           count(DISTINCT ride_id) AS unique_rides,
           count(*) FILTER (event_type = 'driver_assigned') AS trips_assigned,
           count(*) FILTER (event_type = 'trip_completed') AS trips_completed,
           {total("CASE WHEN event_type = 'payment_completed' THEN fare_amount ELSE 0 END")}
             AS total_earnings,
           {mean("trip_distance")} AS avg_distance_km
    FROM (SELECT *, time_bucket(INTERVAL '5 minutes', event_ts)
                    - unnest([INTERVAL '0 minutes', INTERVAL '5 minutes', INTERVAL '10 minutes'])
                    AS window_start
          FROM {source} WHERE NOT has_data_quality_issue AND driver_id IS NOT NULL)
    GROUP BY ALL))"""


def _pairs(source: str) -> dict[str, str]:
    bucket = "time_bucket(INTERVAL '5 minutes', event_ts) AS window_start, city"
    return {
        "demand": f"""
SELECT {bucket}, count(*) AS ride_requests, {mean("surge_multiplier")} AS avg_surge_multiplier
FROM {source} WHERE NOT has_data_quality_issue AND event_type = 'ride_requested' GROUP BY ALL""",
        "supply": f"""
SELECT {bucket}, count(DISTINCT driver_id) AS drivers_active
FROM {source} WHERE NOT has_data_quality_issue AND event_type = 'driver_assigned' GROUP BY ALL""",
    }


_PAIRED = """
SELECT d.window_start, d.window_start + INTERVAL '5 minutes' AS window_end, d.city,
       d.ride_requests, coalesce(s.drivers_active, 0) AS drivers_active, d.avg_surge_multiplier
FROM {demand} d LEFT JOIN {supply} s ON d.window_start = s.window_start AND d.city = s.city"""

_PRICED = f"""
SELECT window_start, window_end, CAST(window_start AS DATE) AS window_start_date, city,
       ride_requests, drivers_active, avg_surge_multiplier, demand_supply_ratio,
       demand_supply_ratio > 1.5 AS surge_triggered,
       CASE WHEN demand_supply_ratio > 3 THEN 2.5::DOUBLE WHEN demand_supply_ratio > 2 THEN 2.0::DOUBLE
            WHEN demand_supply_ratio > 1.5 THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END
         AS recommended_surge_multiplier,
       CASE WHEN demand_supply_ratio > 3 THEN 'EXTREME' WHEN demand_supply_ratio > 2 THEN 'HIGH'
            WHEN demand_supply_ratio > 1.5 THEN 'MODERATE' ELSE 'NORMAL' END AS surge_tier
FROM (SELECT *, {r("(ride_requests / greatest(drivers_active, 1))")} AS demand_supply_ratio
      FROM {{pairs}})"""

STEPS["city_metrics"] = _city("silver")
STEPS["drivers"] = _driver("silver")
STEPS |= _pairs("silver")
STEPS["pairs"] = _PAIRED.format(demand="demand", supply="supply")
STEPS["surge"] = _PRICED.format(pairs="pairs")
STEPS["stages"] = """
SELECT event_date, city,
       nullif(count(DISTINCT ride_id) FILTER (event_type = 'ride_requested'), 0) AS stage_1_requested,
       nullif(count(DISTINCT ride_id) FILTER (event_type = 'driver_assigned'), 0) AS stage_2_assigned,
       nullif(count(DISTINCT ride_id) FILTER (event_type = 'trip_started'), 0) AS stage_3_started,
       nullif(count(DISTINCT ride_id) FILTER (event_type = 'trip_completed'), 0) AS stage_4_completed,
       nullif(count(DISTINCT ride_id) FILTER (event_type = 'payment_completed'), 0) AS stage_5_payment
FROM silver WHERE NOT has_data_quality_issue GROUP BY ALL"""
STEPS["funnel"] = f"""
SELECT *, {pct("stage_2_assigned", "stage_1_requested")} AS assignment_rate,
       {pct("stage_4_completed", "stage_2_assigned")} AS completion_rate,
       {pct("stage_5_payment", "stage_4_completed")} AS payment_rate
FROM stages"""

_UPDATED = ("driver_id rider_id city trip_distance fare_amount net_fare surge_multiplier event_ts "
            "event_date event_hour event_minute schema_version has_data_quality_issue "
            "dq_invalid_event_type dq_fare_out_of_range dq_distance_out_of_range dq_null_driver "
            "dq_null_rider ingestion_ts silver_version").split()
_PICK = ", ".join(f"CASE WHEN newer THEN s_{c} ELSE t_{c} END AS {c}" for c in _UPDATED)
_SIDES = ", ".join(f"t.{c} AS t_{c}, s.{c} AS s_{c}" for c in _UPDATED)
STEPS["merged"] = f"""
SELECT ride_id, event_type, {_PICK} FROM (
  SELECT coalesce(t.ride_id, s.ride_id) AS ride_id, coalesce(t.event_type, s.event_type) AS event_type,
         t.ride_id IS NULL OR coalesce(s.ingestion_ts > t.ingestion_ts, false) AS newer, {_SIDES}
  FROM first_load t FULL JOIN second_load s ON t.ride_id = s.ride_id AND t.event_type = s.event_type)"""

STEPS["city_first"] = _city("first_load")
STEPS["city_early"] = _city("early")
STEPS["no_miami"] = "SELECT * REPLACE (CASE WHEN city <> 'Miami' THEN city END AS city) FROM silver"
STEPS["city_no_miami"] = _city("no_miami")
STEPS["city_second"] = _city("second_load")

STEPS["roster"] = """
SELECT driver_id, CAST(event_ts + INTERVAL '20 hours' AS DATE) AS event_date, city, event_type
FROM silver WHERE driver_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY driver_id, CAST(event_ts + INTERVAL '20 hours' AS DATE)
  ORDER BY ingestion_ts DESC, kafka_offset DESC) = 1"""

QUERIES: dict[str, str] = {}
Q = QUERIES

_BRONZE_OUT = (f"{_PAYLOAD}, raw_value, raw_key, ingestion_ts, kafka_offset, kafka_partition, kafka_topic, "
               "event_date")
Q["bronze_parse"] = f"SELECT {_BRONZE_OUT} FROM bronze"
Q["triage_valid"] = f"SELECT {_BRONZE_OUT} FROM valid"
Q["dead_letter"] = f"SELECT {_BRONZE_OUT}, dead_letter_reason FROM dead"
Q["bronze_malformed"] = f"SELECT {_BRONZE_OUT} FROM faulty"
Q["dead_letter_strict"] = f"""
SELECT {_BRONZE_OUT}, CASE WHEN kafka_offset % 11 = 0 THEN 'SCHEMA_MISMATCH' WHEN ride_id IS NULL THEN 'NULL_RIDE_ID'
  ELSE 'NULL_EVENT_TYPE' END AS dead_letter_reason FROM faulty WHERE ride_id IS NULL OR event_type IS NULL"""
STEPS["faulty_silver"] = _newest("faulty_cleaned")
Q["silver_bad_times"] = f"SELECT {SILVER_COLUMNS} FROM faulty_silver"
Q["silver_clean"] = f"SELECT {SILVER_COLUMNS} FROM cleaned"
Q["dq_flags"] = """
SELECT kafka_offset, dq_invalid_event_type, dq_fare_out_of_range, dq_distance_out_of_range,
       dq_null_driver, dq_null_rider, has_data_quality_issue FROM cleaned"""
Q["deduplicate"] = f"SELECT {SILVER_COLUMNS} FROM silver"
Q["add_schema_version"] = "SELECT kafka_offset, ride_id, '2.0' AS schema_version FROM valid"
Q["enforce_schema"] = "SELECT ride_id, event_type, city, fare_amount FROM valid"
Q["incremental_silver"] = f"""
SELECT {SILVER_COLUMNS} FROM silver
WHERE event_ts >= CAST((SELECT ts FROM clock) + INTERVAL '1 day' AS DATE) - 1"""
Q["point_lookup"] = f"""
SELECT {SILVER_COLUMNS} FROM silver
WHERE event_date = DATE '2024-01-01' AND city = 'New York' AND ride_id = 'RIDE-40'"""
Q["scalar_suite"] = f"""
SELECT kafka_offset, trim(city) AS trimmed, lower(city) AS lowered,
       CAST(event_time AS DATE) AS day, CAST(hour(event_time) AS INTEGER) AS hr,
       CAST(minute(event_time) AS INTEGER) AS mi, date_trunc('hour', event_time) AS hour_start,
       CAST(CAST(event_time AS DATE) - 7 AS DATE) AS week_ago,
       event_time - INTERVAL '15 minutes' AS quarter_ago,
       {r("(fare_amount * 0.82::DOUBLE)")} AS share,
       greatest(fare_amount, trip_distance) AS hi, least(fare_amount, trip_distance) AS lo,
       coalesce(fare_amount, -1.0) AS fare_or_minus,
       CASE WHEN surge_multiplier > 1.5 THEN 'high' WHEN surge_multiplier > 1.0 THEN 'some'
            ELSE 'none' END AS surge_band,
       event_type IN ('trip_completed', 'payment_completed') AS earning,
       driver_id IS NULL AS no_driver,
       driver_id IS NOT NULL AND NOT rider_id IS NULL AS both_known
FROM bronze"""
_GOLD = {"city_ride_metrics": "city_metrics", "driver_utilization": "drivers",
         "surge_pricing": "surge", "funnel_analysis": "funnel"}
for _name, _step in _GOLD.items():
    Q[_name] = f"SELECT * FROM {_step}"
Q["surge_demand"] = "SELECT *, window_start + INTERVAL '5 minutes' AS window_end FROM demand"
Q["surge_supply"] = "SELECT *, window_start + INTERVAL '5 minutes' AS window_end FROM supply"
Q["demand_supply_join"] = "SELECT * FROM pairs"

_NOW = "(SELECT ts FROM clock)"
_TODAY = f"CAST({_NOW} AS DATE)"


def _avg2(x: str) -> str:
    return r(mean(x))


def _sum2(x: str) -> str:
    return r(total(x))


Q["r01_city_dashboard"] = f"""
SELECT city, {n("sum(total_rides)")} AS rides_last_15min,
       {n("sum(completed_rides)")} AS completed_rides, {_avg2("avg_fare")} AS avg_fare_usd,
       {_sum2("total_gross_revenue")} AS gross_revenue_usd,
       {_avg2("avg_surge_multiplier")} AS avg_surge,
       {_avg2("completion_rate")} AS completion_rate_pct
FROM city_metrics WHERE window_start >= {_NOW} - INTERVAL '15 minutes' GROUP BY city"""
_ALERTS = """
SELECT city, window_start, ride_requests, drivers_active, demand_supply_ratio,
       recommended_surge_multiplier, surge_tier,
       CASE surge_tier WHEN 'EXTREME' THEN '🔴 EXTREME' WHEN 'HIGH' THEN '🟠 HIGH'
                       WHEN 'MODERATE' THEN '🟡 MODERATE' ELSE '🟢 NORMAL' END AS surge_status
FROM surge WHERE surge_triggered"""
Q["r02_surge_alerts"] = _ALERTS + f" AND window_start >= {_NOW} - INTERVAL '10 minutes'"
Q["r03_driver_leaderboard"] = f"""
SELECT driver_id, city, {_avg2("efficiency_score")} AS avg_efficiency_score,
       {n("sum(trips_completed)")} AS total_completed_trips,
       {_sum2("total_earnings")} AS total_earnings_usd,
       {_avg2("utilization_rate")} AS avg_utilization_pct,
       {_avg2("avg_earnings_per_trip")} AS avg_earnings_per_trip
FROM drivers WHERE window_start_date = {_TODAY} GROUP BY driver_id, city
HAVING sum(trips_completed) > 0
ORDER BY avg_efficiency_score DESC, driver_id, city LIMIT 20"""
Q["r04_hourly_revenue"] = f"""
SELECT city, date_trunc('hour', window_start) AS hour_bucket,
       {n("sum(total_rides)")} AS total_rides, {n("sum(completed_rides)")} AS completed_rides,
       {_sum2("total_gross_revenue")} AS gross_revenue_usd,
       {_sum2("total_net_revenue")} AS net_revenue_usd, {_avg2("avg_fare")} AS avg_fare_usd,
       {_avg2("avg_surge_multiplier")} AS avg_surge_multiplier
FROM city_metrics WHERE window_start >= {_NOW} - INTERVAL '24 hours' GROUP BY ALL"""
Q["r05_funnel_conversion"] = f"""
SELECT city, {n("sum(stage_1_requested)")} AS total_requested,
       {n("sum(stage_2_assigned)")} AS total_assigned, {n("sum(stage_3_started)")} AS total_started,
       {n("sum(stage_4_completed)")} AS total_completed, {n("sum(stage_5_payment)")} AS total_payments,
       {_avg2("assignment_rate")} AS avg_assignment_rate_pct,
       {_avg2("completion_rate")} AS avg_completion_rate_pct,
       {_avg2("payment_rate")} AS avg_payment_rate_pct,
       {pct("sum(stage_5_payment)", "sum(stage_1_requested)")} AS end_to_end_conversion_pct
FROM funnel WHERE event_date = {_TODAY} GROUP BY city"""
Q["r06_demand_gap"] = f"""
SELECT g.*, m.surge_tier AS dominant_surge_tier FROM (
  SELECT city, max(window_start) AS latest_window, avg(ride_requests) AS avg_ride_requests,
         avg(drivers_active) AS avg_drivers_active,
         {mean("demand_supply_ratio")} AS avg_demand_supply_ratio,
         {r("avg(ride_requests - drivers_active)", 0)} AS avg_unmet_demand,
         count(*) FILTER (surge_triggered) AS surge_trigger_count
  FROM surge WHERE window_start >= {_NOW} - INTERVAL '1 hour' GROUP BY city) g
JOIN (SELECT city, surge_tier FROM surge WHERE window_start >= {_NOW} - INTERVAL '1 hour'
      GROUP BY city, surge_tier
      QUALIFY row_number() OVER (PARTITION BY city ORDER BY count(*) DESC, surge_tier) = 1) m
  ON g.city = m.city"""
_DAY7 = f"CAST({_NOW} + INTERVAL '6 days' AS DATE)"


def _week(current: str, prior: str) -> str:
    return f"""
SELECT c.city, {r("this_week")} AS revenue_this_week_usd, {r("prior_week")} AS revenue_prior_week_usd,
       {r("(this_week - prior_week)")} AS revenue_delta_usd,
       {r("((this_week - prior_week) / greatest(prior_week, 1) * 100)")} AS revenue_growth_pct
FROM (SELECT city, {total("total_gross_revenue")} AS this_week FROM {current}
      WHERE window_start_date BETWEEN {_DAY7} - 7 AND {_DAY7} GROUP BY city) c
LEFT JOIN (SELECT city, {total("total_gross_revenue")} AS prior_week FROM {prior}
           WHERE window_start_date BETWEEN {_DAY7} - 14 AND {_DAY7} - 7 GROUP BY city) p
  ON c.city = p.city"""


Q["r07_week_over_week"] = _week("city_metrics", "city_metrics")
Q["r08_dead_letter_daily"] = f"""
SELECT event_date, count(*) AS dead_letter_count,
       count(*) FILTER (dead_letter_reason = 'NULL_RIDE_ID') AS null_ride_id_count,
       count(*) FILTER (dead_letter_reason = 'NULL_EVENT_TYPE') AS null_event_type_count,
       count(*) FILTER (dead_letter_reason = 'SCHEMA_MISMATCH') AS schema_mismatch_count
FROM dead WHERE event_date >= {_TODAY} - 7 GROUP BY event_date"""
Q["r09_peak_hours"] = f"""
SELECT city, max(CASE WHEN peak = 1 THEN hour_of_day END) AS peak_hour,
       max(CASE WHEN peak = 1 THEN rides END) AS peak_rides_per_hr,
       max(CASE WHEN off_peak = 1 THEN hour_of_day END) AS off_peak_hour,
       max(CASE WHEN off_peak = 1 THEN rides END) AS off_peak_rides_per_hr
FROM (SELECT city, CAST(hour(window_start) AS INTEGER) AS hour_of_day,
             {r("avg(total_rides)", 1)} AS rides,
             row_number() OVER (PARTITION BY city
               ORDER BY avg(total_rides) DESC, hour(window_start)) AS peak,
             row_number() OVER (PARTITION BY city
               ORDER BY avg(total_rides), hour(window_start)) AS off_peak
      FROM city_metrics WHERE window_start_date >= {_TODAY} - 30
      GROUP BY city, hour(window_start))
GROUP BY city"""
_FIXED = "city = 'New York' AND event_date = DATE '2024-01-01' AND dq_fare_out_of_range"
Q["r10_fare_correction"] = f"""
SELECT {SILVER_COLUMNS} FROM (SELECT * REPLACE (
  CASE WHEN {_FIXED} THEN fare_amount * 1.1::DOUBLE ELSE fare_amount END AS fare_amount,
  CASE WHEN {_FIXED} THEN {r("(fare_amount * 1.1::DOUBLE * 0.82::DOUBLE)")} ELSE net_fare END AS net_fare,
  dq_fare_out_of_range AND NOT ({_FIXED}) AS dq_fare_out_of_range,
  has_data_quality_issue AND NOT ({_FIXED}) AS has_data_quality_issue) FROM silver)"""
Q["n1_bronze_profile"] = f"""
SELECT event_date, city, event_type, count(*) AS event_count, {_avg2("fare_amount")} AS avg_fare
FROM valid GROUP BY ALL ORDER BY event_date DESC, event_count DESC, city, event_type LIMIT 50"""
Q["n2_dead_letter_reasons"] = """
SELECT dead_letter_reason, count(*) AS record_count FROM dead GROUP BY ALL"""
Q["n2_dead_letter_today"] = f"""
SELECT dead_letter_reason, count(*) AS record_count FROM dead
WHERE event_date = {_TODAY} GROUP BY ALL"""
Q["dq_summary"] = f"""
SELECT has_data_quality_issue, dq_invalid_event_type, dq_fare_out_of_range,
       dq_distance_out_of_range, dq_null_driver, dq_null_rider, count(*) AS record_count,
       {r("(count(*) * 100::DOUBLE / sum(count(*)) OVER ())")} AS pct_of_total
FROM silver GROUP BY ALL"""
Q["n4_city_last_hour"] = f"""
SELECT city, {n("sum(total_rides)")} AS rides_last_hour,
       {_sum2("total_gross_revenue")} AS gross_revenue_usd, {_avg2("avg_fare")} AS avg_fare,
       {_avg2("avg_surge_multiplier")} AS avg_surge, {_avg2("completion_rate")} AS completion_rate_pct
FROM city_metrics WHERE window_start >= {_NOW} - INTERVAL '1 hour' GROUP BY city"""
_RECENT = """
SELECT city, surge_tier, demand_supply_ratio, recommended_surge_multiplier, window_start
FROM surge WHERE surge_triggered"""
Q["n5_surge_recent"] = _RECENT + f" AND window_start >= {_NOW} - INTERVAL '15 minutes'"
Q["n5_surge_all"] = _RECENT
Q["n6_driver_short"] = f"""
SELECT driver_id, city, {_avg2("efficiency_score")} AS efficiency_score,
       {n("sum(trips_completed)")} AS trips_completed, {_sum2("total_earnings")} AS total_earnings_usd
FROM drivers WHERE window_start_date = {_TODAY} GROUP BY driver_id, city
HAVING sum(trips_completed) > 0 ORDER BY efficiency_score DESC, driver_id, city LIMIT 20"""
Q["n8_event_type_counts"] = "SELECT event_type, count(*) AS record_count FROM valid GROUP BY ALL"
Q["n9_dq_averages"] = f"""
SELECT has_data_quality_issue, count(*) AS records, {_avg2("fare_amount")} AS avg_fare,
       {_avg2("trip_distance")} AS avg_distance_km FROM silver GROUP BY ALL"""
Q["merge_newer_wins"] = f"SELECT {SILVER_COLUMNS} FROM merged"
Q["merge_replace"] = """
SELECT * FROM city_second UNION ALL
SELECT * FROM city_first t WHERE NOT EXISTS (
  SELECT 1 FROM city_second s WHERE s.window_start = t.window_start AND s.city = t.city)"""
Q["merge_sync"] = """
SELECT coalesce(t.driver_id, s.driver_id) AS driver_id, coalesce(t.event_date, s.event_date) AS event_date,
       s.city, s.event_type, t.ride_id, t.fare_amount, t.event_ts
FROM roster s LEFT JOIN silver t ON t.driver_id = s.driver_id AND t.event_date = s.event_date"""
_FEED = ("driver_id, city, fare_amount, net_fare, surge_multiplier, event_ts, event_date, "
         "has_data_quality_issue, ingestion_ts")
_FEED_T = ", ".join(f"t.{c.strip()}" for c in _FEED.split(","))
_FEED_M = ", ".join(f"m.{c.strip()}" for c in _FEED.split(","))
STEPS["paired_states"] = """
SELECT coalesce(t.ride_id, m.ride_id) AS k1, coalesce(t.event_type, m.event_type) AS k2,
       t.ride_id IS NULL AS is_new, m.ingestion_ts > t.ingestion_ts AS is_newer
FROM first_load t FULL JOIN merged m ON t.ride_id = m.ride_id AND t.event_type = m.event_type"""
Q["changes_between"] = f"""
SELECT m.ride_id, m.event_type, {_FEED_M},
       CASE WHEN is_new THEN 'insert' ELSE 'update_postimage' END AS _change_type
FROM paired_states JOIN merged m ON m.ride_id = k1 AND m.event_type = k2 WHERE is_new OR is_newer
UNION ALL
SELECT t.ride_id, t.event_type, {_FEED_T}, 'update_preimage'
FROM paired_states JOIN first_load t ON t.ride_id = k1 AND t.event_type = k2 WHERE is_newer"""
Q["cluster_rows_preserved"] = f"SELECT {SILVER_COLUMNS} FROM silver"
Q["dead_letter_rate"] = f"""
SELECT *, 5.0::DOUBLE AS threshold_pct, dead_letter_pct > 5 AS alert_triggered FROM (
  SELECT *, {pct("dead_letter_count", "(bronze_count + dead_letter_count)")} AS dead_letter_pct FROM (
    SELECT count(*) FILTER (ride_id IS NOT NULL AND event_type IS NOT NULL) AS bronze_count,
           count(*) FILTER (ride_id IS NULL OR event_type IS NULL) AS dead_letter_count
    FROM bronze WHERE ingestion_ts >= {_NOW} - INTERVAL '1 hour'))"""
Q["pipeline_metrics"] = f"""
SELECT (SELECT count(*) FROM valid) AS bronze_row_count, count(*) AS silver_row_count,
       (SELECT count(*) FROM city_metrics) AS gold_city_row_count,
       {pct("count(*) FILTER (has_data_quality_issue)", "count(*)")} AS silver_dq_issue_rate
FROM silver"""
Q["gold_nonempty_check"] = "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, count(*) > 0 AS ok FROM {s}"
    for t, s in _GOLD.items())
Q["duplicate_keys"] = """
SELECT ride_id, event_type, count(*) AS row_count FROM valid GROUP BY ALL HAVING count(*) > 1"""
Q["batch_quality"] = """
SELECT count(*) FILTER (NOT has_data_quality_issue) AS valid_count,
       count(*) FILTER (has_data_quality_issue) AS flagged_count FROM silver"""
Q["clustered_ranges"] = "SELECT CAST(0 AS BIGINT) AS overlaps FROM (SELECT count(*) FROM silver)"
Q["r11_counts_by_version"] = """
SELECT 0 AS version, city, count(*) AS rides FROM early GROUP BY city UNION ALL
SELECT 1, city, count(*) FROM silver GROUP BY city UNION ALL
SELECT 2, city, count(*) FROM early GROUP BY city"""
Q["r11_counts_as_of"] = "SELECT city, count(*) AS rides FROM early GROUP BY city"
Q["n7_rows_as_of"] = "SELECT 'silver' AS table_name, count(*) AS row_count FROM early"
STEPS["two_states"] = """
SELECT s.ride_id AS k1, s.event_type AS k2, e.ride_id IS NULL AS is_new, s.ingestion_ts > e.ingestion_ts AS is_newer
FROM silver s LEFT JOIN early e ON s.ride_id = e.ride_id AND s.event_type = e.event_type"""
Q["r11_version_changes"] = f"""
SELECT m.ride_id, m.event_type, {_FEED_M},
       CASE WHEN is_new THEN 'insert' ELSE 'update_postimage' END AS _change_type
FROM two_states JOIN silver m ON m.ride_id = k1 AND m.event_type = k2 WHERE is_new OR is_newer
UNION ALL
SELECT t.ride_id, t.event_type, {_FEED_T}, 'update_preimage'
FROM two_states JOIN early t ON t.ride_id = k1 AND t.event_type = k2 WHERE is_newer"""
Q["table_stats"] = "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST(max({c}) AS TIMESTAMP) AS latest_ts FROM {x}" for t, x, c in (
        ("bronze", "valid", "ingestion_ts"), ("dead_letter", "dead", "ingestion_ts"), ("silver", "silver", "ingestion_ts"),
        *((t, x, "event_date" if x == "funnel" else "window_start") for t, x in _GOLD.items())))
Q["table_detail"] = "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, true AS has_files, true AS has_bytes, true AS has_time FROM {x}" for t, x in _GOLD.items())
Q["r04_catalog"] = Q["r04_hourly_revenue"]
Q["catalog_rows"] = "\nUNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {x}" for t, x in (
    ("ride_events_raw", "valid"), ("ride_events_dead_letter", "dead"), ("ride_events_clean", "silver"), *_GOLD.items()))
Q["cluster_skipping"] = """
SELECT count(*) > 0 AS ride_id_narrowed, count(*) > 0 AS driver_id_narrowed, count(*) > 0 AS rider_id_narrowed FROM silver"""
Q["r07_time_travel"] = _week("city_metrics", "city_early")
for _name in _GOLD:
    Q[f"gold_refresh_{_name}"] = Q[_name]
Q["gold_refresh_twice"] = Q["city_ride_metrics"]
Q["gold_refresh_null_city"] = "SELECT * FROM city_no_miami"
Q["r01_stored"] = Q["r01_city_dashboard"]
Q["r02_stored"] = Q["r02_surge_alerts"]
Q["r03_stored"] = Q["r03_driver_leaderboard"]
Q["r04_stored"] = Q["r04_hourly_revenue"]
Q["r05_stored"] = Q["r05_funnel_conversion"]
Q["r06_stored"] = Q["r06_demand_gap"]
Q["append_evolving"] = """
SELECT kafka_offset, ride_id, CASE WHEN kafka_partition >= 5 THEN city END AS city, kafka_partition FROM valid"""
Q["bronze_rescued"] = """
SELECT kafka_offset, ride_id, fare_amount, CASE WHEN kafka_offset % 3 = 0 AND kafka_partition >= 5 THEN (kafka_offset % 10) / 2.0::DOUBLE END AS tip,
       CASE WHEN kafka_offset % 3 = 0 AND kafka_partition >= 5 THEN CAST(kafka_offset % 4 AS VARCHAR) END AS app_version,
       CAST(NULL AS VARCHAR) AS known FROM valid"""
STEPS["thirds"] = """
SELECT *, 3 * (kafka_offset - (SELECT min(kafka_offset) FROM bronze))
  // ((SELECT max(kafka_offset) FROM bronze) - (SELECT min(kafka_offset) FROM bronze) + 1) AS batch_id FROM bronze"""
Q["audit_rows"] = """
SELECT 'bronze' AS layer, CAST(batch_id AS BIGINT) AS batch_id, count(*) AS rows_in,
       count(*) FILTER (ride_id IS NOT NULL AND event_type IS NOT NULL) AS rows_out, 'SUCCESS' AS status, '' AS error_message, true AS timed
FROM thirds GROUP BY batch_id"""
Q["stream_progress"] = """
SELECT 'bronze' AS observation, CAST(batch_id AS BIGINT) AS batch_id, count(*) AS num_input_rows, count(*) AS rows_in,
       count(*) FILTER (ride_id IS NOT NULL AND event_type IS NOT NULL) AS rows_good FROM thirds GROUP BY batch_id
UNION ALL
SELECT 'silver', 0, count(*), count(*), count(*) FILTER (NOT has_data_quality_issue) FROM cleaned"""
Q["stream_health"] = """
SELECT *, NOT is_active AS stopped, is_active AND input_rows_per_sec = 0 AND batch_id > 5 AS stalled FROM (
  SELECT CAST(kafka_partition AS VARCHAR) AS query_id, 'partition-' || kafka_partition AS query_name,
         kafka_partition <> 9 AS is_active, CAST(kafka_partition AS BIGINT) AS batch_id, count(*) AS num_input_rows,
         CASE WHEN kafka_partition % 2 = 0 THEN 0.0::DOUBLE ELSE count(*) / 10 END AS input_rows_per_sec,
         count(*) / 10 AS processed_rows_per_sec FROM valid GROUP BY kafka_partition)
UNION ALL
SELECT NULL, observation, true, batch_id, num_input_rows, NULL, NULL, false, false FROM (
  SELECT 'bronze' AS observation, CAST(batch_id AS BIGINT) AS batch_id, count(*) AS num_input_rows FROM thirds GROUP BY batch_id
  UNION ALL SELECT 'silver', CAST(0 AS BIGINT), count(*) FROM cleaned)"""
Q["stream_bronze"] = Q["triage_valid"]
Q["stream_dead_letter"] = Q["dead_letter"]
Q["stream_silver"] = Q["deduplicate"]
# Streams keep up the stored aggregates of deduplicated records.
Q["stream_city_metrics"] = Q["city_ride_metrics"]
Q["stream_driver_utilization"] = Q["driver_utilization"]
Q["stream_surge"] = Q["surge_pricing"]
Q["gold_delta_city"] = Q["city_ride_metrics"]
Q["gold_delta_driver"] = Q["driver_utilization"]
Q["gold_delta_surge"] = Q["surge_pricing"]
STEPS["arrived"] = """
SELECT * FROM cleaned QUALIFY row_number() OVER (PARTITION BY ride_id, event_type ORDER BY kafka_offset) = 1"""
STEPS["arrived_city"] = _city("arrived")
STEPS["arrived_drivers"] = _driver("arrived")
for _step, _sql in _pairs("arrived").items():
    STEPS[f"arrived_{_step}"] = _sql
STEPS["arrived_pairs"] = _PAIRED.format(demand="arrived_demand", supply="arrived_supply")
_LATEST = "(SELECT max(event_ts) FROM cleaned)"
Q["stream_closed_city"] = f"SELECT * FROM arrived_city WHERE window_end <= {_LATEST} - INTERVAL '5 minutes'"
Q["stream_closed_driver"] = f"SELECT * FROM arrived_drivers WHERE window_end <= {_LATEST} - INTERVAL '10 minutes'"
Q["stream_demand_supply"] = f"SELECT * FROM arrived_pairs WHERE window_end <= {_LATEST} - INTERVAL '5 minutes'"
STEPS["arrivals"] = """
SELECT *, CAST(kafka_offset * 7 % 10 * 3 // 10 AS BIGINT) AS batch_id, time_bucket(INTERVAL '1 minute', event_ts) AS minute FROM cleaned"""
STEPS["limits"] = """
SELECT batch_id + 1 AS batch_id, max(max(event_ts)) OVER (ORDER BY batch_id) - INTERVAL '5 minutes' AS watermark FROM arrivals GROUP BY batch_id"""
STEPS["timed"] = """
SELECT a.*, coalesce(minute + INTERVAL '1 minute' <= watermark, false) AS late FROM arrivals a LEFT JOIN limits l ON a.batch_id = l.batch_id"""
Q["stream_late_rows"] = f"SELECT {SILVER_COLUMNS}, batch_id FROM timed WHERE late"
STEPS["on_time_end"] = """
SELECT max(event_ts) - INTERVAL '5 minutes' AS watermark FROM timed WHERE NOT late AND NOT has_data_quality_issue"""
Q["stream_accounting"] = """
SELECT minute AS window_start, city,
       count(*) FILTER (NOT late AND minute + INTERVAL '1 minute' <= (SELECT watermark FROM on_time_end)) AS closed,
       count(*) FILTER (late) AS late,
       count(*) FILTER (NOT late AND minute + INTERVAL '1 minute' > (SELECT watermark FROM on_time_end)) AS open,
       count(*) AS records
FROM timed WHERE NOT has_data_quality_issue GROUP BY ALL"""

STEPS["intervals"] = """
SELECT * FROM (
  SELECT *, ingestion_ts AS valid_from, lead(ingestion_ts) OVER (
    PARTITION BY ride_id, event_type ORDER BY ingestion_ts, kafka_offset, kafka_partition) AS valid_to FROM cleaned)
WHERE valid_to IS NULL OR valid_from < valid_to"""
Q["history_intervals"] = f"SELECT {SILVER_COLUMNS}, valid_from, valid_to FROM intervals"
Q["counts_at_many"] = """
SELECT instant, city, count(*) AS rides
FROM (SELECT ts - to_hours(h) AS instant FROM clock, range(24) r(h))
JOIN cleaned_ranked ON ingestion_ts <= instant AND (next_ts IS NULL OR next_ts > instant)
GROUP BY ALL"""
STEPS["cleaned_ranked"] = """
SELECT city, ingestion_ts, lead(ingestion_ts) OVER (
  PARTITION BY ride_id, event_type ORDER BY ingestion_ts, kafka_offset, kafka_partition) AS next_ts FROM cleaned"""
Q["merge_bucketed"] = Q["merge_newer_wins"]
Q["point_lookup_stored"] = Q["point_lookup"]
Q["lookup_many"] = f"""
SELECT {SILVER_COLUMNS} FROM silver WHERE ride_id IN (SELECT ride_id FROM silver WHERE city = 'New York' AND dq_fare_out_of_range)"""


def statement(name: str) -> str:
    """The query with the steps it needs, in order."""
    needed: set[str] = set()
    def visit(sql: str) -> None:
        for step in STEPS:
            if step not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{step}\b", sql):
                needed.add(step)
                visit(STEPS[step])
    visit(QUERIES[name])
    steps = [f"{s} AS MATERIALIZED ({STEPS[s]})" for s in _ordered(needed)]
    return ("WITH " + ",\n".join(steps) + "\n" if steps else "") + QUERIES[name].strip()


def _ordered(needed: set[str]) -> list[str]:
    """Every step after the steps it reads."""
    out: list[str] = []
    def add(step: str) -> None:
        for other in needed:
            if other != step and other not in out and re.search(
                    rf"\b(?:FROM|JOIN)\s+{other}\b", STEPS[step]):
                add(other)
        if step not in out:
            out.append(step)
    for step in sorted(needed):
        add(step)
    return out
