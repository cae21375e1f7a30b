"""Loading, cleaning and shaping queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from odoscan.operators import cleaning, shaping, summaries
from odoscan.operators.ordering import lay_out, stage
from odoscan.plans.registry import query, r, rounded
from odoscan.plans.sql import GAPS, RAW, TELEMETRY
from odoscan.plans.views import ROLES, TRACK, table, telemetry, telemetry_gaps, telemetry_raw
from odoscan.sources.folder import normalise_headers, union_all


@query(
    "folder_union",
    f"""WITH {RAW}
SELECT rec_id, "Vehicle_ID", "timestamp", total_fuel, speed_raw, driver_name,
  CASE WHEN rec_id % 2 = 1 THEN location END AS location,
  CASE WHEN rec_id % 2 = 0 THEN coordinates END AS coordinates
FROM raw""",
)
def folder_union(spark, sf_dir):
    """Two layouts with different headers and spellings become one table."""
    raw = telemetry_raw(spark, sf_dir)
    named = {"timestamp": " Tiempo", "speed_raw": "Velocidad", "driver_name": "Driver"}
    even = raw.filter("rec_id % 2 = 0").withColumnsRenamed({**named, "total_fuel": "Tanque total", "coordinates": "Coordenadas"})
    odd = raw.filter("rec_id % 2 = 1").withColumnsRenamed({**named, "total_fuel": "Tanque Total", "location": "Ubicación"})
    parts = [normalise_headers(even.drop("location", "ignition_raw")), normalise_headers(odd.drop("coordinates", "ignition_raw"))]
    return union_all(parts)


@query(
    "load_metadata",
    f"""WITH {RAW}
SELECT CAST(count(DISTINCT "Vehicle_ID") AS BIGINT) AS total_files, CAST(count(DISTINCT "Vehicle_ID") AS BIGINT) AS loaded_files,
  count(*) AS total_records, count(DISTINCT "Vehicle_ID") AS vehicles, CAST(0 AS BIGINT) AS errors
FROM raw""",
)
def load_metadata(spark, sf_dir):
    rows = telemetry_raw(spark, sf_dir).withColumn("Source_File", F.concat("Vehicle_ID", F.lit(".csv")))
    return summaries.load_metadata(rows)


@query(
    "dataset_info",
    f"""WITH {TELEMETRY}
SELECT c.column_name, c.data_type, e."start", e."end" FROM (VALUES
  ('rec_id', 'bigint'), ('Vehicle_ID', 'string'), ('timestamp', 'timestamp_ntz'), ('total_fuel', 'double'),
  ('speed_raw', 'double'), ('ignition_raw', 'int'), ('driver_name', 'string'), ('location', 'string'),
  ('coordinates', 'string'), ('Latitude', 'double'), ('Longitude', 'double')) c(column_name, data_type),
  (SELECT min("timestamp") AS "start", max("timestamp") AS "end" FROM telemetry) e""",
)
def dataset_info(spark, sf_dir):
    return summaries.dataset_info(telemetry(spark, sf_dir))


@query(
    "date_range",
    """SELECT min(ts) AS start_date, max(ts) AS end_date,
  CAST(floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 86400000000.0) AS BIGINT) AS duration_days,
  count(DISTINCT CAST(ts AS DATE)) AS unique_dates FROM events""",
)
def date_range(spark, sf_dir):
    return summaries.date_range(table(spark, sf_dir, "events"), "ts")


@query(
    "missing_markers",
    f"""WITH {RAW}
SELECT rec_id, "Vehicle_ID", "timestamp", nullif(total_fuel, '-----') AS total_fuel, nullif(speed_raw, '-----') AS speed_raw,
  ignition_raw, driver_name, location, coordinates FROM raw""",
)
def missing_markers(spark, sf_dir):
    return cleaning.null_markers(telemetry_raw(spark, sf_dir))


@query(
    "null_counts",
    f"""WITH {RAW}, n AS (SELECT
  count(*) - count(rec_id) AS rec_id, count(*) - count("Vehicle_ID") AS "Vehicle_ID", count(*) - count("timestamp") AS "timestamp",
  count(*) - count(nullif(total_fuel, '-----')) AS total_fuel, count(*) - count(nullif(speed_raw, '-----')) AS speed_raw,
  count(*) - count(ignition_raw) AS ignition_raw, count(*) - count(driver_name) AS driver_name,
  count(*) - count(location) AS location, count(*) - count(coordinates) AS coordinates FROM raw)
UNPIVOT n ON rec_id, "Vehicle_ID", "timestamp", total_fuel, speed_raw, ignition_raw, driver_name, location, coordinates
INTO NAME column_name VALUE null_count""",
)
def null_counts(spark, sf_dir):
    return cleaning.null_counts(cleaning.null_markers(telemetry_raw(spark, sf_dir)))


@query(
    "ts_coerce",
    f"""WITH {RAW}
SELECT rec_id, "Vehicle_ID", TRY_CAST("timestamp" AS TIMESTAMP) AS "timestamp"
FROM raw WHERE TRY_CAST("timestamp" AS TIMESTAMP) IS NOT NULL""",
)
def ts_coerce(spark, sf_dir):
    return cleaning.parse_time(telemetry_raw(spark, sf_dir).select("rec_id", "Vehicle_ID", "timestamp"))


@query(
    "num_coerce",
    f"""WITH {RAW}
SELECT rec_id, TRY_CAST(total_fuel AS DOUBLE) AS total_fuel, TRY_CAST(speed_raw AS DOUBLE) AS speed_raw FROM raw""",
)
def num_coerce(spark, sf_dir):
    return cleaning.parse_numbers(telemetry_raw(spark, sf_dir).select("rec_id", "total_fuel", "speed_raw"))


@query(
    "ignition_fill",
    f"""WITH {RAW}
SELECT rec_id, CAST(CASE WHEN ignition_raw IS NOT NULL THEN CAST(ignition_raw AS INTEGER)
  WHEN TRY_CAST(speed_raw AS DOUBLE) IS NULL OR TRY_CAST(speed_raw AS DOUBLE) = 0 THEN 0 ELSE 1 END AS INTEGER) AS ignition_raw
FROM raw""",
)
def ignition_fill(spark, sf_dir):
    rows = cleaning.parse_numbers(telemetry_raw(spark, sf_dir))
    return cleaning.fill_ignition(rows).select("rec_id", "ignition_raw")


@query(
    "coord_split",
    f"""WITH {RAW}, parts AS (SELECT rec_id, TRY_CAST(split_part(coordinates, ',', 1) AS DOUBLE) AS lat,
  TRY_CAST(split_part(coordinates, ',', 2) AS DOUBLE) AS lon FROM raw)
SELECT rec_id, CASE WHEN lat BETWEEN -90 AND 90 THEN lat END AS "Latitude",
  CASE WHEN lon BETWEEN -180 AND 180 THEN lon END AS "Longitude" FROM parts""",
)
def coord_split(spark, sf_dir):
    return cleaning.split_coordinates(telemetry_raw(spark, sf_dir)).select("rec_id", "Latitude", "Longitude")


@query("dedup_first", f'WITH {GAPS} SELECT rec_id, "Vehicle_ID", "timestamp", total_fuel, speed_raw, driver_name, location FROM gaps')
def dedup_first(spark, sf_dir):
    return telemetry_gaps(spark, sf_dir).select("rec_id", "Vehicle_ID", "timestamp", "total_fuel", "speed_raw", "driver_name", "location")


@query(
    "range_filter",
    f"""WITH {RAW}, typed AS (SELECT rec_id, TRY_CAST(total_fuel AS DOUBLE) AS total_fuel, TRY_CAST(speed_raw AS DOUBLE) AS speed_raw FROM raw)
SELECT * FROM typed WHERE speed_raw BETWEEN 0 AND 200 AND total_fuel BETWEEN 0 AND 400""",
)
def range_filter(spark, sf_dir):
    rows = cleaning.parse_numbers(telemetry_raw(spark, sf_dir).select("rec_id", "total_fuel", "speed_raw"))
    return cleaning.filter_ranges(rows)


_NUMBERS = ["total_fuel", "speed_raw", "ignition_raw", "Latitude", "Longitude"]


def _interpolated(column: str) -> str:
    """Straight line between the known neighbours by row number; nearest value at the ends."""
    return f"""coalesce({column},
  last_value({column} IGNORE NULLS) OVER b
   + (first_value({column} IGNORE NULLS) OVER a - last_value({column} IGNORE NULLS) OVER b)
   * (rn - last_value(CASE WHEN {column} IS NOT NULL THEN rn END IGNORE NULLS) OVER b)
   / nullif(first_value(CASE WHEN {column} IS NOT NULL THEN rn END IGNORE NULLS) OVER a
            - last_value(CASE WHEN {column} IS NOT NULL THEN rn END IGNORE NULLS) OVER b, 0),
  last_value({column} IGNORE NULLS) OVER b, first_value({column} IGNORE NULLS) OVER a)"""


@query(
    "interpolate",
    f"""WITH {GAPS}, numbered AS (
  SELECT *, row_number() OVER (PARTITION BY "Vehicle_ID" ORDER BY "timestamp", rec_id) AS rn FROM gaps)
SELECT rec_id, {", ".join(r(_interpolated(f'"{c}"'), c) for c in _NUMBERS)}
FROM numbered WINDOW
  b AS (PARTITION BY "Vehicle_ID" ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  a AS (PARTITION BY "Vehicle_ID" ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
)
def interpolate(spark, sf_dir):
    """All numbers of the cleaned rows."""
    gaps = telemetry_gaps(spark, sf_dir).transform(cleaning.fill_ignition).transform(cleaning.split_coordinates)
    rows = lay_out(stage(gaps.select("rec_id", "Vehicle_ID", "timestamp", *_NUMBERS)), TRACK)
    return rounded(cleaning.interpolate(rows, TRACK).select("rec_id", *_NUMBERS))


@query("clean_all", f'WITH {TELEMETRY} SELECT * REPLACE ({r("Latitude", "Latitude")}, {r("Longitude", "Longitude")}) FROM telemetry')
def clean_all(spark, sf_dir):
    rows = telemetry(spark, sf_dir)
    return rows.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in ("Latitude", "Longitude")})


@query(
    "clean_report",
    f"""WITH {TELEMETRY}, n AS (SELECT (SELECT count(*) FROM raw) AS a, (SELECT count(*) FROM telemetry) AS b)
SELECT a AS original_rows, b AS final_rows, a - b AS rows_removed, {r("(a - b) * 100.0 / a", "removal_percentage")} FROM n""",
)
def clean_report(spark, sf_dir):
    return rounded(cleaning.cleaning_report(telemetry_raw(spark, sf_dir), telemetry(spark, sf_dir)))


@query(
    "validate",
    f"""WITH {GAPS}, f AS (
  SELECT CAST(0 AS BIGINT) AS missing_columns, CAST(count(*) = 0 AS BIGINT) AS "empty",
    CAST((count(rec_id) = 0)::INT + (count("Vehicle_ID") = 0)::INT + (count("timestamp") = 0)::INT + (count(total_fuel) = 0)::INT
      + (count(speed_raw) = 0)::INT + (count(driver_name) = 0)::INT + (count(location) = 0)::INT AS BIGINT) AS all_null_columns,
    count(*) - count("timestamp") AS null_times FROM gaps),
back AS (SELECT "timestamp" < lag("timestamp") OVER (PARTITION BY "Vehicle_ID" ORDER BY rec_id) AS back FROM gaps),
issues AS (
  UNPIVOT f ON missing_columns, "empty", all_null_columns, null_times INTO NAME issue VALUE occurrences
  UNION ALL SELECT 'time_travel', count(*) FILTER (WHERE back) FROM back)
SELECT issue, occurrences, CAST(occurrences > 0 AS INTEGER) AS present FROM issues""",
)
def validate(spark, sf_dir):
    """Arrival order is the record id, so the late copies of records step backwards where they survive."""
    return cleaning.validate(
        telemetry_gaps(spark, sf_dir).select("rec_id", "Vehicle_ID", "timestamp", "total_fuel", "speed_raw", "driver_name", "location")
    )


@query(
    "dup_columns",
    f"""WITH {RAW}
SELECT rec_id, coalesce(nullif(total_fuel, '-----'), speed_raw) AS total_fuel, location FROM raw""",
)
def dup_columns(spark, sf_dir):
    """Two columns under one name reduce to the first known value."""
    rows = cleaning.null_markers(telemetry_raw(spark, sf_dir).select("rec_id", "total_fuel", "location"))
    speed = telemetry_raw(spark, sf_dir).select("rec_id", "speed_raw")
    both = rows.join(speed, "rec_id").select("rec_id", "total_fuel", "speed_raw", "location")
    return shaping.drop_duplicate_columns(both, ["rec_id", "total_fuel", "total_fuel", "location"], keep="filled")


def _narrow_int(column: str, width: str) -> str:
    return f"""SELECT '{column}' AS column_name, CASE WHEN min({column}) > -128 AND max({column}) < 127 THEN 'tinyint'
  WHEN min({column}) > -32768 AND max({column}) < 32767 THEN 'smallint'
  WHEN min({column}) > -2147483648 AND max({column}) < 2147483647 THEN 'int' ELSE '{width}' END AS narrow_type FROM lineitem"""


@query(
    "downcast",
    " UNION ALL ".join(
        [_narrow_int(c, "bigint") for c in ("l_orderkey", "l_partkey", "l_suppkey")]
        + [_narrow_int("l_linenumber", "int")]
        + [
            f"SELECT '{c}' AS column_name, CASE WHEN min({c}) > -3.4028234663852886e38 AND max({c}) < 3.4028234663852886e38 "
            "THEN 'float' ELSE 'double' END AS narrow_type FROM lineitem"
            for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
        ]
    ),
)
def downcast(spark, sf_dir):
    return shaping.narrow_types(table(spark, sf_dir, "lineitem"))


_NARROWED = {"l_orderkey": "BIGINT", "l_partkey": "BIGINT", "l_suppkey": "BIGINT", "l_linenumber": "INTEGER"}


@query(
    "downcast_rows",
    "SELECT "
    + ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in _NARROWED)
    + ", "
    + ", ".join(f"CAST(CAST({c} AS FLOAT) AS DOUBLE) AS {c}" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
    + " FROM lineitem",
)
def downcast_rows(spark, sf_dir):
    """The rows in their narrow types, widened again for comparison: what single precision keeps."""
    rows = shaping.downcast(table(spark, sf_dir, "lineitem").select(*_NARROWED, "l_quantity", "l_extendedprice", "l_discount", "l_tax"))
    wide = {f.name: "double" if f.dataType.simpleString() == "float" else "bigint" for f in rows.schema.fields}
    if "double" not in wide.values() or len({f.dataType.simpleString() for f in rows.schema.fields}) < 3:
        raise AssertionError("nothing was narrowed")
    return rows.select(*[F.col(c).cast(t).alias(c) for c, t in wide.items()])


_FILLED = ("total_fuel", "speed_raw")


@query(
    "median_fill",
    f"""WITH {GAPS}
SELECT rec_id, {", ".join(r(f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM gaps))", c) for c in _FILLED)} FROM gaps""",
)
def median_fill(spark, sf_dir):
    rows = stage(telemetry_gaps(spark, sf_dir).select("rec_id", *_FILLED))
    return rounded(shaping.fill_medians(rows, _FILLED))


@query(
    "feature_projection",
    f"""WITH {TELEMETRY}
SELECT rec_id, total_fuel, speed_raw, CAST(ignition_raw AS DOUBLE) AS ignition_raw, CAST(0 AS DOUBLE) AS altitude FROM telemetry""",
)
def feature_projection(spark, sf_dir):
    """Numeric columns without keys and coordinates, filled; a feature the data lacks is zero."""
    matrix, names = shaping.model_matrix(stage(telemetry(spark, sf_dir)))
    return shaping.align_features(matrix, [*names, "altitude"])


@query(
    "column_summary",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{kind}' AS data_type, count(*) AS rows, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS distinct_values FROM orders"
        for c, kind in (
            ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
            ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"),
        )
    ),
)
def column_summary(spark, sf_dir):
    return summaries.column_summary(table(spark, sf_dir, "orders"))


@query(
    "cleaning_stages",
    f"""WITH {TELEMETRY}
SELECT 'raw' AS stage, count(*) AS records, count(DISTINCT "Vehicle_ID") AS vehicles, count(DISTINCT driver_name) AS drivers FROM raw
UNION ALL SELECT 'cleaned', count(*), count(DISTINCT "Vehicle_ID"), count(DISTINCT driver_name) FROM telemetry""",
)
def cleaning_stages(spark, sf_dir):
    """Records, vehicles and drivers before and after cleaning."""
    counted = [
        rows.agg(
            F.lit(name).alias("stage"),
            F.count(F.lit(1)).alias("records"),
            F.count_distinct(ROLES.entity).alias("vehicles"),
            F.count_distinct(ROLES.actor).alias("drivers"),
        )
        for name, rows in (("raw", telemetry_raw(spark, sf_dir)), ("cleaned", telemetry(spark, sf_dir)))
    ]
    return union_all(counted)
