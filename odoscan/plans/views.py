"""Telemetry derived from the ``events`` table: dirty text rows, and cleaned rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odoscan.config import Roles, Settings, Track
from odoscan.functions.calendar import calendar
from odoscan.operators import cleaning, profiles, rules, series
from odoscan.operators.ordering import lay_out, stage

ROLES = Roles()
SETTINGS = Settings()
TRACK = Track()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def telemetry_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a dirty text row; each hundredth record arrives twice.

    Thirty days are compressed to 36 hours so that gaps of every length occur.
    """
    start = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "user_id",
        "event_type",
        "value",
        "cast(get_json_object(props, '$.k') as int) as k",
        f"timestampadd(MICROSECOND, timestampdiff(MICROSECOND, {start}, ts) div 20, {start}) as t",
    )
    rows = events.selectExpr(
        "event_id as rec_id",
        "concat('V', user_id) as Vehicle_ID",
        "case when event_id % 97 = 0 then 'garbage' else cast(t as string) end as timestamp",
        "case when event_id % 61 = 0 then '-----' else cast(value as string) end as total_fuel",
        "case when k < 30 then '0' when event_id % 53 = 0 then '-----' else cast(cast(k * 22 as double) / 10 as string) end as speed_raw",
        "case when event_id % 10 = 0 then null when k < 30 then '0' else '1' end as ignition_raw",
        "case when event_id % 50 = 0 then null else concat('D', user_id % 20) end as driver_name",
        "case when event_id % 40 = 0 then null else concat(event_type, '-', user_id % 7) end as location",
        "case when event_id % 83 = 0 then '95.5,-200.25' when event_id % 89 = 0 then 'n/a' "
        "else concat(cast(cast(k as double) / 10 as string), ',', cast(-70 - cast(k as double) / 10 as string)) end as coordinates",
    )
    copies = F.when(F.col("rec_id") % 100 == 0, F.array(F.lit(0), F.lit(10_000_000))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("_add", F.explode(copies)).withColumn("rec_id", F.col("rec_id") + F.col("_add")).drop("_add")


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(telemetry_raw(spark, sf_dir))


def telemetry_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned rows before the range filter, nulls kept."""
    raw = telemetry_raw(spark, sf_dir)
    typed = raw.transform(cleaning.null_markers).transform(cleaning.parse_numbers).transform(cleaning.parse_time)
    return typed.transform(cleaning.drop_duplicates)


def uncleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At least as many rows of every vehicle as after cleaning, cheap to count."""
    return table(spark, sf_dir, "events").selectExpr("concat('V', user_id) as Vehicle_ID", "explode(array(0, 1)) as copy")


def ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned rows, laid out for series operators."""
    return lay_out(telemetry(spark, sf_dir), TRACK, sized_by=uncleaned(spark, sf_dir))


def stepped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned rows with gap, change, rate and standing flag."""
    return rules.stationary(series.steps(ordered(spark, sf_dir), TRACK))


def featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with the temporal features that the profiles and rules read.

    Written once: what reads them passes over them several times.
    """
    rows = series.runs(calendar(stepped(spark, sf_dir)), TRACK, parts=("stationary", "refuel"))
    return stage(rules.sudden_drop(rows))


def profiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Featured rows with driver and place profiles joined."""
    rows = featured(spark, sf_dir)
    joined = profiles.join_driver(rows, profiles.driver_profile(rows))
    return profiles.join_place(joined, profiles.place_frequency(rows))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Featured rows with stand-in scores that are a fixed function of the record id."""
    mod = lambda k: F.pmod(F.col("rec_id") * k, F.lit(1000)).cast("double") / 1000
    scores = {"Final_Score": mod(1), "Ensemble_Score": mod(3), "Theft_Probability": mod(7)}
    return calendar(stepped(spark, sf_dir)).withColumns(scores)


def labelled(df: DataFrame, noisy: bool = False) -> DataFrame:
    """Label standing rows with a large loss; ``noisy`` flips every thirteenth record."""
    label = cleaning.flag((F.col("speed_raw") == 0) & (F.col("Fuel_Diff") < -40))
    if noisy:
        label = F.when(F.col("rec_id") % 13 == 0, 1 - label).otherwise(label)
    return df.withColumn("Stationary_drain", label)
