"""Folders that are written, scanned and read back; what was damaged; both prediction tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odoscan.operators import summaries
from odoscan.operators.ordering import shared_folder, stage
from odoscan.plans.registry import query
from odoscan.plans.sql import RAW, SCORED
from odoscan.plans.views import ROLES, scored, telemetry_raw
from odoscan.sources import files, folder, sinks

_EVEN = {"timestamp": " Tiempo", "total_fuel": "Tanque total", "speed_raw": "Velocidad", "driver_name": "Driver", "coordinates": "Coordenadas"}
_ODD = {"timestamp": "Tiempo ", "total_fuel": "Tanque Total", "speed_raw": "Velocidad", "driver_name": "Driver", "location": "Ubicación"}


def _new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/folder-{uuid.uuid4().hex}"


def _layouts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Raw rows in two layouts: even records have coordinates, odd ones have the place and a note with a line break."""
    raw = telemetry_raw(spark, sf_dir).drop("ignition_raw")
    even = raw.filter("rec_id % 2 = 0").drop("location").withColumnsRenamed({**_EVEN, "Vehicle_ID": "Vehicle_ID"})
    odd = raw.filter("rec_id % 2 = 1").drop("coordinates").withColumn("note", F.concat(F.lit('he said "'), F.col("rec_id"), F.lit('",\nand left')))
    return even, odd.withColumnsRenamed(_ODD)


def _damage(directory: str, name: str, content: bytes) -> None:
    """A file that no reader accepts."""
    system, base = files.open_folder(directory)
    with system.open_output_stream(f"{base}/{name}") as out:
        out.write(content)


def _csv_folder(spark: SparkSession, sf_dir: str) -> str:
    directory = _new_folder(spark)
    for suffix, part in zip(("even", "odd"), _layouts(spark, sf_dir), strict=True):
        sinks.write_entity_files(part, directory, suffix=suffix)
    _damage(directory, "V0_broken.csv", b"Tiempo,Velocidad\n2024-01-01 00:00:00,1\n\xff\xfe\xfa,2\n")
    return directory


_LOADED = f"""{RAW}, loaded AS (
  SELECT rec_id, "Vehicle_ID", TRY_CAST("timestamp" AS TIMESTAMP) AS "timestamp", nullif(total_fuel, '-----') AS total_fuel,
    nullif(speed_raw, '-----') AS speed_raw, driver_name, CASE WHEN rec_id % 2 = 1 THEN location END AS location,
    CASE WHEN rec_id % 2 = 0 THEN coordinates END AS coordinates,
    CASE WHEN rec_id % 2 = 1 THEN 'he said "' || rec_id || '",' || chr(10) || 'and left' END AS note
  FROM raw WHERE TRY_CAST("timestamp" AS TIMESTAMP) IS NOT NULL)"""

_SHOWN = ["Vehicle_ID", "timestamp", "total_fuel", "speed_raw", "driver_name", "location", "coordinates", "note"]


@query(
    "folder_scan",
    f"""WITH {_LOADED} SELECT *, "Vehicle_ID" || CASE WHEN rec_id % 2 = 0 THEN '_even0.csv' ELSE '_odd0.csv' END AS file FROM loaded""",
)
def folder_scan(spark, sf_dir):
    """Per-vehicle CSV files of two layouts, and a damaged one, written and read as one table."""
    rows, _ = folder.load_folder(spark, _csv_folder(spark, sf_dir))
    name = F.substring_index("Source_File", "/", -1)
    return rows.select(F.col("rec_id").cast("long").alias("rec_id"), *_SHOWN, name.alias("file"))


@query(
    "folder_files",
    f"""WITH {RAW}
SELECT "Vehicle_ID" || CASE WHEN rec_id % 2 = 0 THEN '_even0.csv' ELSE '_odd0.csv' END AS file, count(*) AS "rows",
  CAST(0 AS BIGINT) AS ragged, false AS damaged FROM raw GROUP BY ALL
UNION ALL SELECT 'V0_broken.csv', 0, 0, true""",
)
def folder_files(spark, sf_dir):
    """What each file of the folder gave; the damaged one gives an error, also for what stands before the damage."""
    report = folder.file_report(*folder.read_folder(spark, _csv_folder(spark, sf_dir)))
    return report.select(F.substring_index("path", "/", -1).alias("file"), "rows", "ragged", F.col("error").isNotNull().alias("damaged"))


@query(
    "folder_metadata",
    f"""WITH {_LOADED}, f AS (SELECT count(*) AS n FROM (SELECT DISTINCT "Vehicle_ID", rec_id % 2 FROM loaded))
SELECT f.n + 1 AS total_files, f.n AS loaded_files, count(*) AS total_records, count(DISTINCT "Vehicle_ID") AS vehicles,
  CAST(1 AS BIGINT) AS errors FROM loaded, f GROUP BY f.n""",
)
def folder_metadata(spark, sf_dir):
    rows, failed = folder.load_folder(spark, _csv_folder(spark, sf_dir))
    return summaries.load_metadata(rows, ROLES, len(failed))


@query("parquet_folder", f"""WITH {_LOADED} SELECT * FROM loaded""")
def parquet_folder(spark, sf_dir):
    """Parquet files of two layouts in one folder; one is damaged, the rest is loaded."""
    directory = _new_folder(spark)
    for part in _layouts(spark, sf_dir):
        entity = part.withColumnRenamed("Vehicle_ID", "vehicle")  # the file's name decides who Vehicle_ID is
        sinks.write_table(entity, f"{directory}/rows.parquet", mode="append")
    _damage(f"{directory}/rows.parquet", "part-99999_damaged.parquet", b"PAR1 this is no footer PAR1")
    rows, failed = folder.load_folder(spark, f"{directory}/rows.parquet", "*.parquet")
    if [f.rsplit("/", 1)[1] for f in failed] != ["part-99999_damaged.parquet"]:
        raise AssertionError(f"the damaged file was not reported: {failed}")
    return rows.select("rec_id", F.col("vehicle").alias("Vehicle_ID"), *_SHOWN[1:])


@query(
    "entity_files",
    f"""WITH {RAW}
SELECT "Vehicle_ID", count(*) AS written, count(*) AS read, CAST(0 AS BIGINT) AS differing FROM raw GROUP BY "Vehicle_ID" """,
)
def entity_files(spark, sf_dir):
    """Files per vehicle beside their manifest: rows written, read back, and files that differ."""
    directory = _new_folder(spark)
    manifest = sinks.write_entity_files(telemetry_raw(spark, sf_dir), directory)
    report = folder.file_report(*folder.read_folder(spark, directory))
    wrong = stage(sinks.differing_files(manifest, report)).select("path", F.lit(1).cast("long").alias("wrong"))
    whole = manifest.select("path", F.col("rows").alias("written")).join(report.select("path", F.col("rows").alias("read")), "path").join(wrong, "path", "left")
    vehicle = F.substring_index(F.substring_index("path", "/", -1), "_", 1)
    return whole.groupBy(vehicle.alias("Vehicle_ID")).agg(
        F.sum("written").alias("written"), F.sum("read").alias("read"), F.coalesce(F.sum("wrong"), F.lit(0).cast("long")).alias("differing")
    )


@query(
    "prediction_files",
    f"""WITH {SCORED}, called AS (SELECT rec_id, "Final_Score", CAST("Final_Score" > 0.9 AS INTEGER) AS "Predicted_Theft" FROM predicted)
SELECT 'all' AS "table", count(*) AS written, count(*) AS read, CAST(sum(rec_id) AS BIGINT) AS ids FROM called
UNION ALL SELECT 'flagged', count(*), count(*), CAST(sum(rec_id) AS BIGINT) FROM called WHERE "Predicted_Theft" = 1""",
)
def prediction_files(spark, sf_dir):
    """Both prediction tables, written once and read back."""
    directory = _new_folder(spark)
    call = F.coalesce((F.col("Final_Score") > 0.9).cast("int"), F.lit(0))
    rows = scored(spark, sf_dir).select("rec_id", "Final_Score").withColumn("Predicted_Theft", call)
    manifest = sinks.prediction_manifest(rows, directory, "thefts.parquet").collect()
    parts = []
    for entry in manifest:
        back = sinks.read_like(rows, entry["path"]) if entry["rows"] else rows.limit(0)
        name = F.lit("flagged" if entry["flagged"] else "all").alias("table")
        parts.append(back.agg(F.count(F.lit(1)).alias("read"), F.sum("rec_id").alias("ids")).select(name, F.lit(entry["rows"]).cast("long").alias("written"), "read", "ids"))
    return parts[0].unionByName(parts[1])


@query("stage_files", f"""WITH {RAW} SELECT * FROM raw""")
def stage_files(spark, sf_dir):
    """A stage of a run, written and continued from."""
    return sinks.write_stage(telemetry_raw(spark, sf_dir), _new_folder(spark), "raw_combined")
