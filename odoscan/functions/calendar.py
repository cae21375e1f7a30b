"""Calendar columns of an event time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odoscan.config import Roles, Settings


def calendar(df: DataFrame, roles: Roles = Roles(), settings: Settings = Settings()) -> DataFrame:
    """Hour, weekday (Monday = 0), day, month, weekend and night flags, time of day."""
    time = F.col(roles.time)
    hour = F.hour(time)
    weekday = F.weekday(time)
    night_from, night_to = settings.night_hours
    part = (
        F.when(hour <= 6, "Night").when(hour <= 12, "Morning").when(hour <= 18, "Afternoon").when(hour <= 24, "Evening")
    )
    return df.withColumns(
        {
            "Hour": hour,
            "DayOfWeek": weekday,
            "Day": F.dayofmonth(time),
            "Month": F.month(time),
            "IsWeekend": weekday.isin(5, 6).cast("int"),
            "Is_NightTime": ((hour >= night_from) | (hour <= night_to)).cast("int"),
            "TimeOfDay": part,
        }
    )


def cyclical(df: DataFrame) -> DataFrame:
    """Sine and cosine of each calendar column over its period."""
    new: dict[str, Column] = {}
    for name, period in (("Hour", 24), ("DayOfWeek", 7), ("Day", 31), ("Month", 12)):
        angle = F.lit(2.0) * F.pi() * F.col(name) / F.lit(period)
        new[f"{name}_Sin"] = F.sin(angle)
        new[f"{name}_Cos"] = F.cos(angle)
    return df.withColumns(new)


def gap_category(df: DataFrame) -> DataFrame:
    """Length class of the gap to the previous row; none for zero, negative or unknown gaps."""
    gap = F.col("Time_Diff")
    label = (
        F.when(gap <= 0, None)
        .when(gap <= 5, "Very_Short")
        .when(gap <= 15, "Short")
        .when(gap <= 30, "Medium")
        .when(gap <= 60, "Long")
        .when(gap > 60, "Very_Long")
    )
    return df.withColumn("Time_Diff_Category", label)
