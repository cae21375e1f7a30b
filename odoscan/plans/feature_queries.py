"""The whole feature build and its statistics, beside the SQL of all its columns."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from odoscan.operators import summaries
from odoscan.operators.features import build_features, catalogue_names
from odoscan.operators.ordering import stage
from odoscan.plans import profile_queries, score_queries, series_queries
from odoscan.plans.registry import ORACLES, query, r, rounded
from odoscan.plans.sql import FEATURED, PROFILED, TELEMETRY
from odoscan.plans.views import table, telemetry, uncleaned

__all__ = ["profile_queries", "score_queries", "series_queries"]  # their SQL is put together here

_DRIVER = profile_queries._DRIVER
_VEHICLE = {
    "Vehicle_total_fuel_mean": "avg(total_fuel)", "Vehicle_total_fuel_std": "stddev_samp(total_fuel)", "Vehicle_Fuel_Diff_mean": 'avg("Fuel_Diff")',
    "Vehicle_Fuel_Diff_std": 'stddev_samp("Fuel_Diff")', "Vehicle_Is_NightTime_mean": 'avg("Is_NightTime")', "Vehicle_Is_Stationary_mean": 'avg("Is_Stationary")',
}
_CYCLES = {"Hour": ('extract(hour FROM "timestamp")', 24), "DayOfWeek": ('(isodow("timestamp") - 1)', 7), "Day": ('day("timestamp")', 31), "Month": ('month("timestamp")', 12)}

_CYCLIC = f"""WITH {TELEMETRY} SELECT rec_id, {", ".join(r(f"{fn}(2 * pi() * {part} / {period})", f"{name}_{fn.capitalize()}")
  for name, (part, period) in _CYCLES.items() for fn in ("sin", "cos"))} FROM telemetry"""
_PLACED = f"""WITH {PROFILED} SELECT rec_id, {", ".join(r(f'"{c}"', c) for c in [*_DRIVER, "Fuel_Deviation_From_Driver",
  "Speed_Deviation_From_Driver", "Location_Risk_Score", "Location_Frequency"])}, "Is_Rare_Location" FROM profiled"""
_VEHICLES = f"""WITH {FEATURED}, v AS (SELECT "Vehicle_ID", {", ".join(f'{e} AS "{c}"' for c, e in _VEHICLE.items())} FROM featured GROUP BY ALL)
SELECT rec_id, {", ".join(r(f'"{c}"', c) for c in _VEHICLE)} FROM featured JOIN v USING ("Vehicle_ID")"""

#: SQL that gives rec_id and some of the features; columns that an earlier one gives are left out.
_PARTS = [
    (ORACLES["gap_diff_rate"], ()), (ORACLES["event_flags"], ()), (ORACLES["stationary_run"], ("Is_Stationary",)), (ORACLES["since_refuel"], ("Is_Refuel",)),
    (ORACLES["calendar"], ("Is_NightTime",)), (_CYCLIC, ()), (ORACLES["gap_category"], ()), (ORACLES["ewma"], ()), (ORACLES["macd"], ()),
    (ORACLES["loss_streak"], ()), (ORACLES["rolling_mean_std"], ()), (ORACLES["rolling_min_max"], ()), (ORACLES["lags"], ()),
    (ORACLES["acceleration"], ()), (ORACLES["cv"], ()), (ORACLES["rolling_range"], ()), (ORACLES["zscore_global"], ()),
    (ORACLES["zscore_local"], ()), (ORACLES["change_flags"], ()), (_PLACED, ()), (_VEHICLES, ()), (ORACLES["unusual_behavior"], ()),
    (ORACLES["rule_flags"], ()), (ORACLES["rule_score"], ()),
]


def _selected(sql: str, without: tuple[str, ...]) -> str:
    left_out = ", ".join(f'"{c}"' for c in without)
    return f"(SELECT * EXCLUDE ({left_out}) FROM ({sql}))" if without else f"({sql})"


#: All features of every row, rounded.
BUILT = "built AS MATERIALIZED (SELECT * FROM " + " JOIN ".join(
    _selected(sql, without) + f" p{i}" + (" USING (rec_id)" if i else "") for i, (sql, without) in enumerate(_PARTS)
) + ")"

#: Features of each set, in the order of the build.
SETS = {
    "temporal": [
        "Time_Diff", "Fuel_Diff", "Fuel_Rate", "Is_Stationary", "Is_Refuel", "Stationary_Duration", "Time_Since_Refuel", "Hour", "DayOfWeek", "Day",
        "Month", "IsWeekend", "Is_NightTime", "TimeOfDay", *[f"{c}_{k}" for c in _CYCLES for k in ("Sin", "Cos")], "Time_Diff_Category", "Is_Sudden_Drop",
    ],
    "statistical": [
        *[f"Fuel_EWMA_{n}" for n in (5, 10, 30)], "Fuel_MACD", "Is_Fuel_Loss", "Consecutive_Losses",
        *[f"{c}_Rolling_{k}_{n}" for n in (5, 10, 30) for c in ("total_fuel", "Fuel_Diff", "Fuel_Rate", "speed_raw") for k in ("Mean", "Std")],
        *[f"{c}_Rolling_{k}_{n}" for n in (5, 10, 30) for c in ("total_fuel", "Fuel_Diff") for k in ("Min", "Max")],
        *[f"{c}_Lag_{n}" for n in (1, 2, 3) for c in ("total_fuel", "Fuel_Diff", "speed_raw")], "Fuel_Acceleration", "Is_Sharp_Deceleration",
        *[f"{c}_CV_{n}" for c in ("total_fuel", "Fuel_Rate") for n in (5, 10, 30)], "Fuel_Range_10", "Fuel_Range_30",
        *[f"{c}_{k}" for c in ("total_fuel", "Fuel_Diff", "Fuel_Rate", "Stationary_Duration") for k in ("ZScore", "HighZScore", "ZScore_Local")],
        "Fuel_Change_Magnitude", "Is_Large_Change", "Is_Extreme_Change",
    ],
    "behavioral": [
        *_DRIVER, "Fuel_Deviation_From_Driver", "Speed_Deviation_From_Driver", "Location_Risk_Score", "Location_Frequency", "Is_Rare_Location", *_VEHICLE,
        "Is_Unusual_Speed", "Is_Unusual_Stationary", "Unusual_Behavior_Count", "Has_Multiple_Unusual", "Behavioral_Risk_Score",
    ],
    "anomaly": [*profile_queries._RULES, "Anomaly_Score"],
}
_ALL = [c for names in SETS.values() for c in names]
_TEXT = ("TimeOfDay", "Time_Diff_Category")


def _built(spark, sf_dir):
    """All features, rounded as in the SQL."""
    built, catalogue = build_features(telemetry(spark, sf_dir), sized_by=uncleaned(spark, sf_dir))
    if {s: sorted(names) for s, names in catalogue.items()} != {s: sorted(names) for s, names in SETS.items()}:
        raise AssertionError("the build has other features than the catalogue")
    rows = built.select("rec_id", *catalogue_names(catalogue))
    digits = {c: 9 if c in ("Time_Diff", "Fuel_Diff", "Fuel_Rate", "Stationary_Duration") else 4 if "_CV_" in c else 6 for c in _ALL}
    doubles = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return rows.withColumns({c: F.round(c, digits[c]) + F.lit(0.0) for c in doubles})


@query("build_features", f"WITH {BUILT} SELECT rec_id, {', '.join(f'\"{c}\"' for c in _ALL)} FROM built")
def build_all_features(spark, sf_dir):
    """The whole feature build, all columns."""
    return _built(spark, sf_dir)


def _described(rows, columns):
    stats = summaries.feature_stats(rows, columns, digits=9)
    doubles = [f.name for f in stats.schema.fields if isinstance(f.dataType, T.DoubleType) and f.name != "count"]
    return rounded(stats.withColumns({c: F.col(c) + 1e-7 for c in doubles}), 3)


_NUMBERS = [c for c in _ALL if c not in _TEXT]


@query("feature_stats", f"WITH {BUILT} " + " UNION ALL ".join(profile_queries._feature_stat(c, "built") for c in _NUMBERS))
def feature_stats(spark, sf_dir):
    """Statistics of every numeric feature."""
    return _described(stage(_built(spark, sf_dir)), _NUMBERS)


_LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("lineitem_stats", " UNION ALL ".join(profile_queries._feature_stat(c, "lineitem") for c in _LINE))
def lineitem_stats(spark, sf_dir):
    """The same statistics of all numbers of the largest table."""
    return _described(table(spark, sf_dir, "lineitem"), _LINE)


@query(
    "features_per_set",
    f"""WITH {BUILT}, c AS ({" UNION ALL ".join(
        f"SELECT '{s}' AS feature_set, count(*) - count(\"{c}\") AS nulls, count(DISTINCT \"{c}\") AS kinds FROM built" for s, names in SETS.items() for c in names)})
SELECT feature_set, count(*) AS n_features, CAST(sum(nulls) AS BIGINT) AS nulls, CAST(sum(kinds) AS BIGINT) AS distinct_values FROM c GROUP BY feature_set""",
)
def features_per_set(spark, sf_dir):
    """Features of each set with their nulls and distinct values, over the built rows."""
    summary = summaries.column_summary(stage(_built(spark, sf_dir).drop("rec_id")))
    of = F.create_map(*[F.lit(x) for s, names in SETS.items() for c in names for x in (c, s)])
    return summary.groupBy(of[F.col("column_name")].alias("feature_set")).agg(
        F.count(F.lit(1)).alias("n_features"), F.sum("nulls").alias("nulls"), F.sum("distinct_values").alias("distinct_values")
    )
