"""Profile, place, rule and feature-statistic queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from odoscan.operators import profiles, rules
from odoscan.operators.ordering import stage
from odoscan.plans.registry import query, r, rounded
from odoscan.plans.sql import DRIVERS, FEATURED, PLACES, PROFILED, RULES, STEPS
from odoscan.plans.views import featured, profiled, stepped, telemetry

_DRIVER = [
    "Driver_Fuel_Diff_mean", "Driver_Fuel_Diff_std", "Driver_Fuel_Diff_min", "Driver_Fuel_Diff_max", "Driver_Fuel_Diff_q25",
    "Driver_speed_raw_mean", "Driver_speed_raw_std", "Driver_speed_raw_max", "Driver_Stationary_Duration_mean",
    "Driver_Stationary_Duration_max", "Driver_Is_NightTime_mean", "Driver_Is_Stationary_mean",
]


def _each(columns) -> str:
    return ", ".join(r(f'"{c}"', c) for c in columns)


@query("driver_profile", f"WITH {DRIVERS} SELECT driver_name, {_each(_DRIVER)} FROM drivers")
def driver_profile(spark, sf_dir):
    return rounded(profiles.driver_profile(featured(spark, sf_dir)).select("driver_name", *_DRIVER))


@query(
    "vehicle_profile",
    f"""WITH {FEATURED} SELECT "Vehicle_ID", {r("avg(total_fuel)", "Vehicle_total_fuel_mean")}, {r("stddev_samp(total_fuel)", "Vehicle_total_fuel_std")},
  {r('avg("Fuel_Diff")', "Vehicle_Fuel_Diff_mean")}, {r('stddev_samp("Fuel_Diff")', "Vehicle_Fuel_Diff_std")},
  {r('avg("Is_NightTime")', "Vehicle_Is_NightTime_mean")}, {r('avg("Is_Stationary")', "Vehicle_Is_Stationary_mean")}
FROM featured GROUP BY "Vehicle_ID" """,
)
def vehicle_profile(spark, sf_dir):
    return rounded(profiles.vehicle_profile(featured(spark, sf_dir)))


@query(
    "vehicle_join",
    f"""WITH {FEATURED}, v AS (SELECT "Vehicle_ID", avg(total_fuel) AS m, stddev_samp("Fuel_Diff") AS s FROM featured GROUP BY ALL)
SELECT rec_id, {r("m", "Vehicle_total_fuel_mean")}, {r("s", "Vehicle_Fuel_Diff_std")} FROM featured JOIN v USING ("Vehicle_ID")""",
)
def vehicle_join(spark, sf_dir):
    rows = featured(spark, sf_dir)
    joined = profiles.join_vehicle(rows, profiles.vehicle_profile(rows))
    return rounded(joined.select("rec_id", "Vehicle_total_fuel_mean", "Vehicle_Fuel_Diff_std"))


@query(
    "place_frequency",
    f"""WITH {PLACES} SELECT location, n, {_each(["Location_Risk_Score", "Location_Frequency"])}, "Is_Rare_Location" FROM places""",
)
def place_frequency(spark, sf_dir):
    return rounded(profiles.place_frequency(stage(telemetry(spark, sf_dir).select("rec_id", "location"))))


@query(
    "rare_places",
    f"""WITH {PROFILED} SELECT rec_id, location, {_each(["Location_Risk_Score", "Location_Frequency"])} FROM profiled WHERE "Is_Rare_Location" = 1""",
)
def rare_places(spark, sf_dir):
    rows = stage(telemetry(spark, sf_dir).select("rec_id", "location"))
    joined = profiles.join_place(rows, profiles.place_frequency(rows)).filter("Is_Rare_Location = 1")
    return rounded(joined.select("rec_id", "location", "Location_Risk_Score", "Location_Frequency"))


@query(
    "place_stats",
    f"""WITH {STEPS} SELECT location, {r('avg("Fuel_Diff")', "Location_Fuel_Diff_mean")}, {r('stddev_samp("Fuel_Diff")', "Location_Fuel_Diff_std")},
  {r('avg("Is_Stationary")', "Location_Is_Stationary_mean")}, {r('stddev_samp("Is_Stationary")', "Location_Is_Stationary_std")}
FROM steps WHERE location IS NOT NULL GROUP BY location""",
)
def place_stats(spark, sf_dir):
    return rounded(profiles.place_stats(stepped(spark, sf_dir)))


@query(
    "driver_risk",
    f"""WITH {DRIVERS} SELECT driver_name, CASE WHEN "Driver_Fuel_Diff_min" < -10 THEN 'High'
  WHEN "Driver_Is_NightTime_mean" > 0.3 THEN 'Medium' ELSE 'Low' END AS risk_level FROM drivers""",
)
def driver_risk(spark, sf_dir):
    return profiles.driver_risk(profiles.driver_profile(featured(spark, sf_dir))).select("driver_name", "risk_level")


_DEVIATIONS = ["Fuel_Deviation_From_Driver", "Speed_Deviation_From_Driver"]


@query("driver_deviation", f"WITH {PROFILED} SELECT rec_id, {_each(_DEVIATIONS)} FROM profiled")
def driver_deviation(spark, sf_dir):
    rows = featured(spark, sf_dir)
    return rounded(profiles.join_driver(rows, profiles.driver_profile(rows)).select("rec_id", *_DEVIATIONS))


@query(
    "unusual_behavior",
    f"""WITH {PROFILED}, u AS (SELECT *,
  CAST(coalesce(abs(speed_raw - "Driver_speed_raw_mean") > 2 * "Driver_speed_raw_std", false) AS INTEGER) AS fast,
  CAST(coalesce("Stationary_Duration" > 2 * "Driver_Stationary_Duration_mean", false) AS INTEGER) AS still FROM profiled)
SELECT rec_id, fast AS "Is_Unusual_Speed", still AS "Is_Unusual_Stationary", fast + still AS "Unusual_Behavior_Count",
  CAST(fast + still >= 2 AS INTEGER) AS "Has_Multiple_Unusual",
  {r('("Is_NightTime" + "Is_Rare_Location" + CAST(fast + still >= 2 AS INTEGER)) / 3.0', "Behavioral_Risk_Score")} FROM u""",
)
def unusual_behavior(spark, sf_dir):
    rows = profiles.unusual_behaviour(profiled(spark, sf_dir))
    return rounded(
        rows.select(
            "rec_id", "Is_Unusual_Speed", "Is_Unusual_Stationary", "Unusual_Behavior_Count", "Has_Multiple_Unusual", "Behavioral_Risk_Score"
        )
    )


@query(
    "change_flags",
    f"""WITH {STEPS}, q AS (SELECT quantile_cont(abs("Fuel_Diff"), 0.95) AS a, quantile_cont(abs("Fuel_Diff"), 0.99) AS b FROM steps)
SELECT rec_id, {r('abs("Fuel_Diff")', "Fuel_Change_Magnitude")}, CAST(coalesce(abs("Fuel_Diff") > a, false) AS INTEGER) AS "Is_Large_Change",
  CAST(coalesce(abs("Fuel_Diff") > b, false) AS INTEGER) AS "Is_Extreme_Change" FROM steps, q""",
)
def change_flags(spark, sf_dir):
    rows = rules.change_flags(stage(stepped(spark, sf_dir).select("rec_id", "Fuel_Diff")))
    return rounded(rows.select("rec_id", "Fuel_Change_Magnitude", "Is_Large_Change", "Is_Extreme_Change"))


_RULES = [f"Anomaly_{n}" for n in ("stationary_loss", "night_loss", "rapid_loss", "high_deviation", "sudden_drop", "unusual_location")]


@query("rule_flags", f"""WITH {RULES} SELECT rec_id, {", ".join(f'"{c}"' for c in _RULES)} FROM flagged""")
def rule_flags(spark, sf_dir):
    return rules.rule_flags(profiled(spark, sf_dir)).select("rec_id", *_RULES)


@query("rule_score", f"""WITH {RULES} SELECT rec_id, {r('"Anomaly_Score"', "Anomaly_Score")} FROM ruled""")
def rule_score(spark, sf_dir):
    weighed = stage(rules.weighted_rules(profiled(spark, sf_dir)).select("rec_id", "Anomaly_Score"))
    return rounded(rules.over_maximum(weighed, "Anomaly_Score"))


def _feature_stat(column: str, source: str) -> str:
    """One feature's statistics; a ten-millionth is added first, so that ties are rounded alike in both engines."""
    x = f'CAST("{column}" AS DOUBLE)'
    parts = {
        "mean": f"avg({x})", "std": f"stddev_samp({x})", "min": f"min({x})",
        "q25": f"quantile_cont({x}, 0.25)", "q50": f"quantile_cont({x}, 0.5)", "q75": f"quantile_cont({x}, 0.75)", "max": f"max({x})",
        "missing_pct": f"(count(*) - count({x})) * 100.0 / count(*)", "skewness": f"CASE WHEN min({x}) = max({x}) AND count({x}) >= 3 THEN 0 ELSE skewness({x}) END",
        "kurtosis": f"CASE WHEN min({x}) = max({x}) AND count({x}) >= 4 THEN 0 ELSE kurtosis({x}) END",
    }
    return (
        f"SELECT '{column}' AS feature, CAST(count({x}) AS DOUBLE) + 0.0 AS \"count\", "
        + ", ".join(r(f"{e} + 1e-7", name, 3) for name, e in parts.items())
        + f", count(*) - count({x}) AS missing_count, count(DISTINCT {x}) AS unique_count FROM {source}"
    )
