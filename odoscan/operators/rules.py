"""Event flags, change flags and the weighted rule score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odoscan.config import Roles, Settings
from odoscan.operators.cleaning import flag
from odoscan.operators.quantiles import quantiles


def stationary(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    return df.withColumn("Is_Stationary", flag(F.col(roles.speed) == 0))


def sudden_drop(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    dropped = (F.col("Fuel_Diff") < settings.sudden_drop_level) & (F.col("Time_Diff") < settings.sudden_drop_minutes)
    return df.withColumn("Is_Sudden_Drop", flag(dropped))


def change_flags(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Size of the level change, and flags above its 95% and 99% quantiles."""
    size = F.abs("Fuel_Diff")
    cuts = quantiles(df.select(size.alias("size")), ["size"], [0.95, 0.99], settings=settings).scalar()
    return df.withColumns(
        {"Fuel_Change_Magnitude": size, "Is_Large_Change": flag(size > cuts[0]), "Is_Extreme_Change": flag(size > cuts[1])}
    )


def rule_conditions(df: DataFrame, settings: Settings = Settings()) -> dict[str, Column]:
    """Condition per rule. A rule whose inputs are absent never fires."""
    still = F.col("Is_Stationary") == 1
    change = F.col("Fuel_Diff")
    risk = F.col("Location_Risk_Score")
    rules = {
        "stationary_loss": (("Is_Stationary", "Fuel_Diff"), still & (change < -settings.stationary_loss_threshold)),
        "night_loss": (("Is_NightTime", "Fuel_Diff"), (F.col("Is_NightTime") == 1) & (change < -settings.night_loss_threshold)),
        "rapid_loss": (("Fuel_Rate", "Is_Stationary"), (F.col("Fuel_Rate") < settings.rapid_loss_rate) & still),
        "high_deviation": (("Fuel_Deviation_From_Driver",), F.abs(F.col("Fuel_Deviation_From_Driver")) > 3),
        "sudden_drop": (("Is_Sudden_Drop",), F.col("Is_Sudden_Drop") == 1),
        "unusual_location": (("Location_Risk_Score",), risk < 0.1 if settings.place_rule == "lt" else risk > 0.9),
    }
    return {name: condition if set(needs) <= set(df.columns) else F.lit(False) for name, (needs, condition) in rules.items()}


def rule_flags(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return df.withColumns({f"Anomaly_{name}": flag(c) for name, c in rule_conditions(df, settings).items()})


def weighted_rules(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Rule flags and their weighted sum, not yet normalised."""
    names = list(rule_conditions(df, settings))
    weighted = [F.col(f"Anomaly_{n}") * F.lit(settings.rule_weights.get(n, 1.0)) for n in names]
    return rule_flags(df, settings).withColumn("Anomaly_Score", sum(weighted, F.lit(0.0)))


def rule_score(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Weighted sum of the rule flags over its largest value in the table."""
    return over_maximum(weighted_rules(df, settings), "Anomaly_Score")


def over_maximum(df: DataFrame, column: str) -> DataFrame:
    """Divide a score by its maximum, unless that is zero or less."""
    top = df.agg(F.max(column).alias("top")).scalar()
    return df.withColumn(column, F.when(top > 0, F.col(column) / top).otherwise(F.col(column)))
