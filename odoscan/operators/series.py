"""Per-entity features over rows in time order.

Every function takes a plain frame or one prepared by ``ordering.lay_out``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from odoscan.config import Roles, Settings, Track
from odoscan.operators.cleaning import flag
from odoscan.operators.ordering import bounded, look_around, lookup_join, position

MINUTE = 60_000_000.0
HOUR = 3_600_000_000.0


def micros_between(start: Column, end: Column) -> Column:
    """Microseconds between two zoneless times, without a detour through the session's time zone."""
    span = end - start

    def part(unit: str) -> Column:
        return F.extract(F.lit(unit), span)

    minutes = (part("DAY").cast("long") * 24 + part("HOUR")) * 60 + part("MINUTE")
    return minutes * 60_000_000 + (part("SECOND") * 1_000_000).cast("long")


# --- steps between neighbouring rows ---------------------------------------


def add_steps(df: DataFrame, window: WindowSpec, roles: Roles) -> DataFrame:
    """Minutes and level change since the previous row, and their ratio."""
    gap = micros_between(F.lag(roles.time).over(window), F.col(roles.time)) / F.lit(MINUTE)
    change = F.col(roles.level) - F.lag(roles.level).over(window)
    df = df.withColumns({"Time_Diff": gap, "Fuel_Diff": change})
    return df.withColumn("Fuel_Rate", F.coalesce(F.try_divide("Fuel_Diff", "Time_Diff"), F.lit(0.0)))


def steps(df: DataFrame, track: Track, roles: Roles = Roles()) -> DataFrame:
    return bounded(df, track, 1, lambda d, w: add_steps(d, w, roles))


def add_acceleration(df: DataFrame, window: WindowSpec) -> DataFrame:
    """Change of the rate since the previous row; sharp when below -0.1."""
    df = df.withColumn("Fuel_Acceleration", F.col("Fuel_Rate") - F.lag("Fuel_Rate").over(window))
    return df.withColumn("Is_Sharp_Deceleration", flag(F.col("Fuel_Acceleration") < -0.1))


def acceleration(df: DataFrame, track: Track) -> DataFrame:
    return bounded(df, track, 1, add_acceleration)


def add_lags(df: DataFrame, window: WindowSpec, columns: Sequence[str], lags: Sequence[int]) -> DataFrame:
    return df.withColumns({f"{c}_Lag_{n}": F.lag(c, n).over(window) for n in lags for c in columns})


def lagged(df: DataFrame, track: Track, columns: Sequence[str], lags: Sequence[int] = (1, 2, 3)) -> DataFrame:
    return bounded(df, track, max(lags), lambda d, w: add_lags(d, w, columns, lags))


# --- rolling statistics ------------------------------------------------------


def add_rolling(
    df: DataFrame, window: WindowSpec, columns: Sequence[str], extremes: Sequence[str], sizes: Sequence[int]
) -> DataFrame:
    """Mean and sample deviation per column, and min/max of ``extremes``, over the last n rows."""
    new = {}
    for n in sizes:
        recent = window.rowsBetween(-(n - 1), 0)
        for c in columns:
            new[f"{c}_Rolling_Mean_{n}"] = F.avg(c).over(recent)
            new[f"{c}_Rolling_Std_{n}"] = F.stddev_samp(c).over(recent)
        for c in extremes:
            new[f"{c}_Rolling_Min_{n}"] = F.min(c).over(recent)
            new[f"{c}_Rolling_Max_{n}"] = F.max(c).over(recent)
    return df.withColumns(new)


def rolling(
    df: DataFrame, track: Track, columns: Sequence[str], extremes: Sequence[str] = (), sizes: Sequence[int] = (5, 10, 30)
) -> DataFrame:
    return bounded(df, track, max(sizes) - 1, lambda d, w: add_rolling(d, w, columns, extremes, sizes))


def rolling_range(df: DataFrame, level: str, sizes: Sequence[int] = (10, 30)) -> DataFrame:
    """Spread of the level in the recent window, from its rolling extremes."""
    return df.withColumns(
        {f"Fuel_Range_{n}": F.col(f"{level}_Rolling_Max_{n}") - F.col(f"{level}_Rolling_Min_{n}") for n in sizes}
    )


def variation(df: DataFrame, columns: Sequence[str], sizes: Sequence[int] = (5, 10, 30)) -> DataFrame:
    """Coefficient of variation from the rolling mean and deviation."""
    return df.withColumns(
        {
            f"{c}_CV_{n}": F.col(f"{c}_Rolling_Std_{n}") / (F.abs(F.col(f"{c}_Rolling_Mean_{n}")) + 1e-6)
            for c in columns
            for n in sizes
        }
    )


# --- runs and time since an event --------------------------------------------


def runs(
    df: DataFrame,
    track: Track,
    roles: Roles = Roles(),
    settings: Settings = Settings(),
    parts: Sequence[str] = ("stationary", "refuel", "losses"),
) -> DataFrame:
    """Stationary minutes, hours since the last refuel, and the loss streak.

    All three are distances to the latest row of some kind, so one look-back
    serves them: a stationary run started after the row before its first row, a
    refuel lies strictly earlier, a streak counts from the last row without loss.
    """
    upto, before, helpers = {}, {}, []
    if "stationary" in parts:
        def mark_runs(frame: DataFrame, window: WindowSpec) -> DataFrame:
            previous = F.lag(roles.time).over(window)
            changed = F.col("Is_Stationary") != F.lag("Is_Stationary").over(window)
            start = F.when(previous.isNull(), F.col(roles.time)).when(changed, previous)
            return frame.withColumns({"_previous": previous, "_start": start})

        df = bounded(df, track, 1, mark_runs)
        upto["_run_start"] = F.col("_start")
        helpers += ["_previous", "_start", "_run_start"]
    if "losses" in parts:
        df = df.withColumns({"Is_Fuel_Loss": flag(F.col("Fuel_Diff") < 0), "_at": position(df, track)})
        upto["_no_loss"] = F.when(F.col("Is_Fuel_Loss") == 0, F.col("_at"))
        helpers += ["_at", "_no_loss"]
    if "refuel" in parts:
        df = df.withColumn("Is_Refuel", flag(F.col("Fuel_Diff") > settings.refuel_threshold))
        before["_refuel"] = F.when(F.col("Is_Refuel") == 1, F.col(roles.time))
        helpers.append("_refuel")
    df = look_around(df, track, last=upto, before=before)
    new = {}
    if "stationary" in parts:
        lasted = micros_between(F.col("_run_start"), F.col(roles.time)) / F.lit(MINUTE)
        new["Stationary_Duration"] = F.when(F.col("_previous").isNotNull(), lasted * F.col("Is_Stationary"))
    if "refuel" in parts:
        since = micros_between(F.col("_refuel"), F.col(roles.time)) / F.lit(HOUR)
        new["Time_Since_Refuel"] = F.coalesce(since, F.lit(0.0))
    if "losses" in parts:
        streak = F.col("_at") - F.coalesce(F.col("_no_loss"), F.lit(-1))
        new["Consecutive_Losses"] = F.when(F.col("Is_Fuel_Loss") == 1, streak).otherwise(0).cast("int")
    return df.withColumns(new).drop(*helpers)


# --- z-scores ------------------------------------------------------------------


def _filled_deviation(value: Column, stats: Column) -> Column:
    """|z| after filling nulls with the mean: filling shrinks the deviation to sqrt(known/all)."""
    sigma = F.sqrt(stats["known"] * stats["var"] / stats["rows"])
    z = F.abs(F.try_divide(F.coalesce(value, stats["mean"]) - stats["mean"], sigma))
    return F.when(stats["std"] > 0, z).otherwise(F.lit(0.0))


def _deviation_stats(column: str) -> Column:
    return F.struct(
        F.avg(column).alias("mean"),
        F.var_pop(column).alias("var"),
        F.stddev_samp(column).alias("std"),
        F.count(column).alias("known"),
        F.count(F.lit(1)).alias("rows"),
    ).alias(column)


def zscore_global(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """|z| against the whole table, and a flag above 3. The statistics are one scalar row."""
    stats = df.agg(F.struct(*[_deviation_stats(c) for c in columns]).alias("stats")).scalar()
    df = df.withColumns({f"{c}_ZScore": _filled_deviation(F.col(c), stats[c]) for c in columns})
    return df.withColumns({f"{c}_HighZScore": flag(F.col(f"{c}_ZScore") > 3) for c in columns})


def zscore_local(df: DataFrame, columns: Sequence[str], roles: Roles = Roles(), settings: Settings = Settings()) -> DataFrame:
    """|z| within the entity: aggregate, then look up, so no entity has to fit one task."""
    stats = df.groupBy(roles.entity).agg(F.struct(*[_deviation_stats(c) for c in columns]).alias("_stats"))
    joined = lookup_join(df, stats, roles.entity, roles.record, settings.broadcast_rows)
    return joined.withColumns(
        {f"{c}_ZScore_Local": _filled_deviation(F.col(c), F.col("_stats")[c]) for c in columns}
    ).drop("_stats")
