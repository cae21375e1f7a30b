"""Common table expressions shared by the check queries (DuckDB dialect)."""

from __future__ import annotations

RAW = """
base AS (
  SELECT event_id, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         TIMESTAMP '2024-01-01' + to_microseconds((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 20) AS t
  FROM events),
one AS (
  SELECT event_id AS rec_id, 'V' || user_id AS "Vehicle_ID",
    CASE WHEN event_id % 97 = 0 THEN 'garbage' ELSE CAST(t AS VARCHAR) END AS "timestamp",
    CASE WHEN event_id % 61 = 0 THEN '-----' ELSE CAST(value AS VARCHAR) END AS total_fuel,
    CASE WHEN k < 30 THEN '0' WHEN event_id % 53 = 0 THEN '-----'
         ELSE CAST(CAST(k * 22 AS DOUBLE) / 10 AS VARCHAR) END AS speed_raw,
    CASE WHEN event_id % 10 = 0 THEN NULL WHEN k < 30 THEN '0' ELSE '1' END AS ignition_raw,
    CASE WHEN event_id % 50 = 0 THEN NULL ELSE 'D' || user_id % 20 END AS driver_name,
    CASE WHEN event_id % 40 = 0 THEN NULL ELSE event_type || '-' || user_id % 7 END AS location,
    CASE WHEN event_id % 83 = 0 THEN '95.5,-200.25' WHEN event_id % 89 = 0 THEN 'n/a'
         ELSE CAST(CAST(k AS DOUBLE) / 10 AS VARCHAR) || ',' || CAST(-70 - CAST(k AS DOUBLE) / 10 AS VARCHAR) END AS coordinates
  FROM base),
raw AS (
  SELECT * FROM one
  UNION ALL
  SELECT * REPLACE (rec_id + 10000000 AS rec_id) FROM one WHERE rec_id % 100 = 0)
"""

GAPS = (
    RAW
    + """,
typed AS (
  SELECT rec_id, "Vehicle_ID", TRY_CAST("timestamp" AS TIMESTAMP) AS "timestamp",
         TRY_CAST(total_fuel AS DOUBLE) AS total_fuel, TRY_CAST(speed_raw AS DOUBLE) AS speed_raw,
         ignition_raw, driver_name, location, coordinates,
         TRY_CAST(split_part(coordinates, ',', 1) AS DOUBLE) AS lat,
         TRY_CAST(split_part(coordinates, ',', 2) AS DOUBLE) AS lon
  FROM raw),
gaps AS (
  SELECT rec_id, "Vehicle_ID", "timestamp", total_fuel, speed_raw,
         CAST(CASE WHEN ignition_raw IS NOT NULL THEN CAST(ignition_raw AS INTEGER)
              WHEN speed_raw IS NULL OR speed_raw = 0 THEN 0 ELSE 1 END AS INTEGER) AS ignition_raw,
         driver_name, location, coordinates,
         CASE WHEN lat BETWEEN -90 AND 90 THEN lat END AS "Latitude",
         CASE WHEN lon BETWEEN -180 AND 180 THEN lon END AS "Longitude"
  FROM typed WHERE "timestamp" IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY "Vehicle_ID", "timestamp", total_fuel ORDER BY rec_id) = 1)
"""
)

TELEMETRY = (
    GAPS
    + """,
telemetry AS (
  SELECT * FROM gaps WHERE speed_raw BETWEEN 0 AND 200 AND total_fuel BETWEEN 0 AND 400)
"""
)

STEPS = (
    TELEMETRY
    + """,
diffs AS (
  SELECT *,
    epoch_us("timestamp") - epoch_us(lag("timestamp") OVER v) AS gap_us,
    CAST(epoch_us("timestamp") - epoch_us(lag("timestamp") OVER v) AS DOUBLE) / 60000000 AS "Time_Diff",
    total_fuel - lag(total_fuel) OVER v AS "Fuel_Diff",
    CAST(speed_raw = 0 AS INTEGER) AS "Is_Stationary",
    row_number() OVER v AS rn
  FROM telemetry WINDOW v AS (PARTITION BY "Vehicle_ID" ORDER BY "timestamp", rec_id)),
steps AS (
  SELECT *, coalesce("Fuel_Diff" / nullif("Time_Diff", 0), 0) AS "Fuel_Rate" FROM diffs)
"""
)

FEATURED = (
    STEPS
    + """,
marked AS (
  SELECT *,
    CAST(extract(hour FROM "timestamp") AS INTEGER) AS "Hour",
    CAST(extract(hour FROM "timestamp") >= 22 OR extract(hour FROM "timestamp") <= 5 AS INTEGER) AS "Is_NightTime",
    CAST(coalesce("Fuel_Diff" > 15, false) AS INTEGER) AS "Is_Refuel",
    CAST(coalesce("Fuel_Diff" < -5 AND "Time_Diff" < 30, false) AS INTEGER) AS "Is_Sudden_Drop",
    CASE WHEN lag("Is_Stationary") OVER v IS DISTINCT FROM "Is_Stationary" THEN 1 ELSE 0 END AS turn
  FROM steps WINDOW v AS (PARTITION BY "Vehicle_ID" ORDER BY rn)),
islands AS (
  SELECT *, sum(turn) OVER (PARTITION BY "Vehicle_ID" ORDER BY rn) AS island,
    max(CASE WHEN "Is_Refuel" = 1 THEN "timestamp" END)
      OVER (PARTITION BY "Vehicle_ID" ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS refuelled
  FROM marked),
featured AS (
  SELECT *,
    CASE WHEN "Time_Diff" IS NOT NULL THEN
      CAST(sum(gap_us) OVER (PARTITION BY "Vehicle_ID", island ORDER BY rn) AS DOUBLE) / 60000000 * "Is_Stationary" END AS "Stationary_Duration",
    coalesce(CAST(epoch_us("timestamp") - epoch_us(refuelled) AS DOUBLE) / 3600000000, 0) AS "Time_Since_Refuel"
  FROM islands)
"""
)

DRIVERS = (
    FEATURED
    + """,
drivers AS (
  SELECT driver_name,
    avg("Fuel_Diff") AS "Driver_Fuel_Diff_mean", stddev_samp("Fuel_Diff") AS "Driver_Fuel_Diff_std",
    min("Fuel_Diff") AS "Driver_Fuel_Diff_min", max("Fuel_Diff") AS "Driver_Fuel_Diff_max",
    quantile_cont("Fuel_Diff", 0.25) AS "Driver_Fuel_Diff_q25",
    avg(speed_raw) AS "Driver_speed_raw_mean", stddev_samp(speed_raw) AS "Driver_speed_raw_std", max(speed_raw) AS "Driver_speed_raw_max",
    avg("Stationary_Duration") AS "Driver_Stationary_Duration_mean", max("Stationary_Duration") AS "Driver_Stationary_Duration_max",
    avg("Is_NightTime") AS "Driver_Is_NightTime_mean", avg("Is_Stationary") AS "Driver_Is_Stationary_mean"
  FROM featured WHERE driver_name IS NOT NULL GROUP BY driver_name)
"""
)

PLACES = (
    DRIVERS
    + """,
place_counts AS (SELECT location, count(*) AS n FROM telemetry WHERE location IS NOT NULL GROUP BY location),
places AS (
  SELECT location, n,
    1 - CAST(n AS DOUBLE) / (SELECT max(n) FROM place_counts) AS "Location_Risk_Score",
    CAST(n AS DOUBLE) / (SELECT count(*) FROM telemetry) AS "Location_Frequency",
    CAST(n <= (SELECT quantile_cont(CAST(n AS DOUBLE), 0.1) FROM place_counts) AS INTEGER) AS "Is_Rare_Location"
  FROM place_counts)
"""
)

PROFILED = (
    PLACES
    + """,
profiled AS (
  SELECT f.*, d.* EXCLUDE (driver_name),
    coalesce(p."Location_Risk_Score", 1) AS "Location_Risk_Score",
    coalesce(p."Location_Frequency", 0) AS "Location_Frequency",
    coalesce(p."Is_Rare_Location", 0) AS "Is_Rare_Location",
    (f."Fuel_Diff" - d."Driver_Fuel_Diff_mean") / (d."Driver_Fuel_Diff_std" + 1e-6) AS "Fuel_Deviation_From_Driver",
    (f.speed_raw - d."Driver_speed_raw_mean") / (d."Driver_speed_raw_std" + 1e-6) AS "Speed_Deviation_From_Driver"
  FROM featured f LEFT JOIN drivers d ON f.driver_name = d.driver_name LEFT JOIN places p ON f.location = p.location)
"""
)

RULES = (
    PROFILED
    + """,
flagged AS (
  SELECT *,
    CAST(coalesce("Is_Stationary" = 1 AND "Fuel_Diff" < -2.5, false) AS INTEGER) AS "Anomaly_stationary_loss",
    CAST(coalesce("Is_NightTime" = 1 AND "Fuel_Diff" < -3, false) AS INTEGER) AS "Anomaly_night_loss",
    CAST(coalesce("Fuel_Rate" < -0.5 AND "Is_Stationary" = 1, false) AS INTEGER) AS "Anomaly_rapid_loss",
    CAST(coalesce(abs("Fuel_Deviation_From_Driver") > 3, false) AS INTEGER) AS "Anomaly_high_deviation",
    CAST("Is_Sudden_Drop" = 1 AS INTEGER) AS "Anomaly_sudden_drop",
    CAST("Location_Risk_Score" < 0.1 AS INTEGER) AS "Anomaly_unusual_location"
  FROM profiled),
summed AS (
  SELECT *, 3.0 * "Anomaly_stationary_loss" + 2.0 * "Anomaly_night_loss" + 3.0 * "Anomaly_rapid_loss"
    + 2.0 * "Anomaly_high_deviation" + 3.0 * "Anomaly_sudden_drop" + 1.0 * "Anomaly_unusual_location" AS points
  FROM flagged),
ruled AS (
  SELECT *, CAST(points AS DOUBLE) / (SELECT max(points) FROM summed) AS "Anomaly_Score" FROM summed)
"""
)

SCORED = (
    FEATURED
    + """,
scored AS (
  SELECT *, CAST(rec_id % 1000 AS DOUBLE) / 1000 AS "Final_Score",
    CAST(rec_id * 3 % 1000 AS DOUBLE) / 1000 AS "Ensemble_Score",
    CAST(rec_id * 7 % 1000 AS DOUBLE) / 1000 AS "Theft_Probability"
  FROM featured),
predicted AS (
  SELECT *, CAST("Final_Score" > 0.8 AS INTEGER) AS "Prediction_conservative",
    CAST("Final_Score" > 0.6 AS INTEGER) AS "Prediction_balanced",
    CAST("Final_Score" > 0.4 AS INTEGER) AS "Prediction_aggressive",
    CAST("Final_Score" > 0.6 AS INTEGER) AS "Final_Prediction"
  FROM scored)
"""
)
