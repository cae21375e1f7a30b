"""Driver, vehicle and place profiles, and what rows look like against them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odoscan.config import Roles, Settings
from odoscan.operators.cleaning import flag
from odoscan.operators.ordering import lookup_join
from odoscan.operators.quantiles import quantiles

#: Parts of a value that are added exactly, and the values small enough for that.
_PARTS, _SMALL = 2.0**20, 2.0**40


def steady_mean(column: str) -> Column:
    """The mean whatever the order of the rows: multiples of 2^-20 are added as whole numbers, then what they leave."""
    x = F.col(column).cast("double")
    whole = F.floor(F.when(F.abs(x) < _SMALL, x) * _PARTS)
    total = F.sum(whole.cast("decimal(20,0)")).cast("double") / _PARTS + F.sum(x - whole / _PARTS)
    return F.when(F.max(F.abs(x)) < _SMALL, total / F.count(x)).otherwise(F.avg(x))


_AGGREGATES = {"mean": steady_mean, "std": F.stddev_samp, "min": F.min, "max": F.max}


def _profile(df: DataFrame, key: str, prefix: str, wanted: dict[str, list[str]]) -> DataFrame:
    aggs = [
        _AGGREGATES[a](c).cast("double").alias(f"{prefix}_{c}_{a}") for c, names in wanted.items() if c in df.columns for a in names
    ]
    known = df.filter(F.col(key).isNotNull())
    return known.groupBy(key).agg(*aggs) if aggs else known.select(key).distinct()


def driver_profile(df: DataFrame, roles: Roles = Roles(), settings: Settings = Settings()) -> DataFrame:
    """One row per driver: twelve statistics of change, speed, standing and night driving."""
    profile = _profile(
        df,
        roles.actor,
        "Driver",
        {
            "Fuel_Diff": ["mean", "std", "min", "max"],
            roles.speed: ["mean", "std", "max"],
            "Stationary_Duration": ["mean", "max"],
            "Is_NightTime": ["mean"],
            "Is_Stationary": ["mean"],
        },
    )
    if "Fuel_Diff" not in df.columns:
        return profile
    quarter = quantiles(df, ["Fuel_Diff"], [0.25], [roles.actor], settings)
    return profile.join(
        quarter.select(roles.actor, F.col("Fuel_Diff")[0].alias("Driver_Fuel_Diff_q25")), roles.actor, "left"
    )


def vehicle_profile(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """One row per vehicle: level, change, night and standing statistics."""
    return _profile(
        df,
        roles.entity,
        "Vehicle",
        {
            roles.level: ["mean", "std"],
            "Fuel_Diff": ["mean", "std"],
            "Is_NightTime": ["mean"],
            "Is_Stationary": ["mean"],
        },
    )


def place_frequency(df: DataFrame, roles: Roles = Roles(), settings: Settings = Settings()) -> DataFrame:
    """One row per place: rows, risk (1 - share of the commonest), share of all rows, rarity.

    Rare means at or below the interpolated 10% quantile of the rows per place.
    Rows without a place count in the denominator of the share.
    """
    counts = df.groupBy(roles.place).agg(F.count(F.lit(1)).alias("n"))
    places = counts.filter(F.col(roles.place).isNotNull())
    total = counts.agg(F.sum("n").alias("n")).scalar()
    most = places.agg(F.max("n").alias("n")).scalar()
    rare = quantiles(places, ["n"], [0.1], settings=settings).select(F.col("n")[0].alias("n")).scalar()
    return places.withColumns(
        {
            "Location_Risk_Score": 1 - F.col("n") / most,
            "Location_Frequency": F.col("n") / total,
            "Is_Rare_Location": flag(F.col("n") <= rare),
        }
    )


def place_stats(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """One row per place: mean and deviation of the level change and of standing."""
    return _profile(df, roles.place, "Location", {"Fuel_Diff": ["mean", "std"], "Is_Stationary": ["mean", "std"]})


def driver_risk(profile: DataFrame, roles: Roles = Roles(), driver: str | None = None) -> DataFrame:
    """Risk level per driver: High beats Medium beats Low."""
    level = (
        F.when(F.col("Driver_Fuel_Diff_min") < -10, "High")
        .when(F.col("Driver_Is_NightTime_mean") > 0.3, "Medium")
        .otherwise("Low")
    )
    rated = profile.withColumn("risk_level", level)
    return rated if driver is None else rated.filter(F.col(roles.actor) == driver)


def _without_clashes(profile: DataFrame, df: DataFrame, key: str) -> DataFrame:
    return profile.drop(*[c for c in profile.columns if c != key and c in df.columns])


def join_driver(df: DataFrame, profile: DataFrame, roles: Roles = Roles(), settings: Settings = Settings()) -> DataFrame:
    """Rows with their driver's profile and their deviation from it."""
    side = _without_clashes(profile, df, roles.actor)
    df = lookup_join(df, side, roles.actor, roles.record, settings.broadcast_rows)
    new = {}
    if {"Fuel_Diff", "Driver_Fuel_Diff_mean"} <= set(df.columns):
        new["Fuel_Deviation_From_Driver"] = (F.col("Fuel_Diff") - F.col("Driver_Fuel_Diff_mean")) / (
            F.col("Driver_Fuel_Diff_std") + 1e-6
        )
    mean, std = f"Driver_{roles.speed}_mean", f"Driver_{roles.speed}_std"
    if not settings.compat and {roles.speed, mean, std} <= set(df.columns):
        new["Speed_Deviation_From_Driver"] = (F.col(roles.speed) - F.col(mean)) / (F.col(std) + 1e-6)
    return df.withColumns(new) if new else df


def join_vehicle(df: DataFrame, profile: DataFrame, roles: Roles = Roles(), settings: Settings = Settings()) -> DataFrame:
    side = _without_clashes(profile, df, roles.entity)
    return lookup_join(df, side, roles.entity, roles.record, settings.broadcast_rows)


def join_place(df: DataFrame, frequency: DataFrame, roles: Roles = Roles(), settings: Settings = Settings()) -> DataFrame:
    """Rows with their place's risk; a row without a place is risky, unseen and not rare."""
    side = frequency.select(roles.place, "Location_Risk_Score", "Location_Frequency", "Is_Rare_Location")
    df = lookup_join(df, side, roles.place, roles.record, settings.broadcast_rows)
    return df.withColumns(
        {
            "Location_Risk_Score": F.coalesce("Location_Risk_Score", F.lit(1.0)),
            "Location_Frequency": F.coalesce("Location_Frequency", F.lit(0.0)),
            "Is_Rare_Location": F.coalesce("Is_Rare_Location", F.lit(0)),
        }
    )


def unusual_behaviour(df: DataFrame, roles: Roles = Roles(), settings: Settings = Settings()) -> DataFrame:
    """Flags for unusual speed and standing, their count, and the mean risk of the row."""
    have = set(df.columns)
    mean, std = f"Driver_{roles.speed}_mean", f"Driver_{roles.speed}_std"
    flags = {}
    if not settings.compat and {roles.speed, mean, std} <= have:
        flags["Is_Unusual_Speed"] = flag(F.abs(F.col(roles.speed) - F.col(mean)) > 2 * F.col(std))
    if {"Stationary_Duration", "Driver_Stationary_Duration_mean"} <= have:
        flags["Is_Unusual_Stationary"] = flag(F.col("Stationary_Duration") > F.col("Driver_Stationary_Duration_mean") * 2)
    if flags:
        df = df.withColumns(flags)
        df = df.withColumn("Unusual_Behavior_Count", sum([F.col(c) for c in flags], F.lit(0)))
        df = df.withColumn("Has_Multiple_Unusual", flag(F.col("Unusual_Behavior_Count") >= 2))
    factors = [c for c in ("Is_NightTime", "Is_Rare_Location", "Has_Multiple_Unusual") if c in df.columns]
    if not factors:
        return df
    return df.withColumn("Behavioral_Risk_Score", sum([F.col(c) for c in factors], F.lit(0)) / F.lit(len(factors)))
