"""The feature build: temporal, behavioral, statistical sets and the rule score."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odoscan.config import Roles, Settings, Track
from odoscan.functions.calendar import calendar, cyclical, gap_category
from odoscan.operators import profiles, rules, series, smoothing
from odoscan.operators.ordering import bounded, clear_layout, lay_out, stage

SETS = ("temporal", "behavioral", "statistical")


def temporal_series(df: DataFrame, track: Track, roles: Roles, settings: Settings) -> DataFrame:
    """Steps, standing runs and refuels: the temporal features that need row order."""
    if roles.time not in df.columns or roles.level not in df.columns:
        return df
    df = series.steps(df, track, roles)
    parts = ["refuel"]
    if roles.speed in df.columns:
        df = rules.stationary(df, roles)
        parts.append("stationary")
    return series.runs(df, track, roles, settings, parts)


def temporal_rows(df: DataFrame, roles: Roles, settings: Settings) -> DataFrame:
    """Temporal features of the row alone."""
    if roles.time not in df.columns:
        return df
    df = cyclical(calendar(df, roles, settings))
    return rules.sudden_drop(gap_category(df), settings) if "Time_Diff" in df.columns else df


def statistical_series(df: DataFrame, track: Track, roles: Roles, settings: Settings) -> DataFrame:
    """Weighted, streak, rolling and lagged features: everything that needs row order.

    The few look-backs of unlimited length come first, while rows are narrow.
    """
    if roles.level not in df.columns:
        return df
    spans = {f"Fuel_EWMA_{n}": n for n in settings.rolling_windows} | {"_fast": 12, "_slow": 26}
    df = smoothing.weighted_means(df, track, roles.level, spans)
    df = df.withColumn("Fuel_MACD", F.col("_fast") - F.col("_slow")).drop("_fast", "_slow")
    if "Fuel_Diff" in df.columns:
        df = series.runs(df, track, roles, settings, ["losses"])
    measured = [c for c in (roles.level, "Fuel_Diff", "Fuel_Rate", roles.speed) if c in df.columns]
    extremes = [c for c in (roles.level, "Fuel_Diff") if c in df.columns]
    delayed = [c for c in (roles.level, "Fuel_Diff", roles.speed) if c in df.columns]
    sizes = settings.rolling_windows

    def look_back(frame, window):
        frame = series.add_rolling(frame, window, measured, extremes, sizes)
        frame = series.add_lags(frame, window, delayed, settings.lags)
        return series.add_acceleration(frame, window) if "Fuel_Rate" in frame.columns else frame

    df = bounded(df, track, max(max(sizes) - 1, max(settings.lags)), look_back)
    df = series.variation(df, [c for c in (roles.level, "Fuel_Rate") if c in df.columns], sizes)
    if not settings.compat:
        df = series.rolling_range(df, roles.level, [n for n in (10, 30) if n in sizes])
    return df


def behavioral(df: DataFrame, roles: Roles, settings: Settings) -> DataFrame:
    base = df
    if roles.actor in df.columns:
        df = profiles.join_driver(df, profiles.driver_profile(base, roles, settings), roles, settings)
    if roles.place in df.columns:
        df = profiles.join_place(df, profiles.place_frequency(base, roles, settings), roles, settings)
    if roles.entity in df.columns:
        df = profiles.join_vehicle(df, profiles.vehicle_profile(base, roles), roles, settings)
    return profiles.unusual_behaviour(df, roles, settings)


def statistical_tables(df: DataFrame, roles: Roles, settings: Settings) -> DataFrame:
    """Z-scores and change flags: everything measured against a whole table or entity."""
    columns = [c for c in (roles.level, "Fuel_Diff", "Fuel_Rate", "Stationary_Duration") if c in df.columns]
    if columns:
        df = series.zscore_local(series.zscore_global(df, columns), columns, roles, settings)
    return rules.change_flags(df, settings) if "Fuel_Diff" in df.columns else df


def build_features(
    df: DataFrame, roles: Roles = Roles(), settings: Settings = Settings(), sets: Sequence[str] = SETS, sized_by: DataFrame | None = None
) -> tuple[DataFrame, dict[str, list[str]]]:
    """All features of the chosen sets, and the catalogue set -> column names.

    Row-order features come first, on one layout of the series. That result is
    written once; the profiles, statistics and quantiles then read only the
    columns they need from it. The rule flags are written too, so that the
    largest rule score is a scan of one column. ``sized_by`` is as in ``lay_out``: without
    it the rows are computed once more to find the longest series.
    """
    unknown = set(sets) - set(SETS)
    if unknown:
        raise ValueError(f"unknown feature sets: {sorted(unknown)}")
    track = roles.track(settings)
    df = lay_out(df, track, sized_by)
    catalogue: dict[str, list[str]] = {}

    def step(name, frame, compute):
        made = compute(frame)
        new = [c for c in made.columns if c not in frame.columns]
        catalogue.setdefault(name, []).extend(new)
        return made

    if "temporal" in sets:
        df = step("temporal", df, lambda d: temporal_series(d, track, roles, settings))
    if "statistical" in sets:
        df = step("statistical", df, lambda d: statistical_series(d, track, roles, settings))
    if "temporal" in sets:
        df = step("temporal", df, lambda d: temporal_rows(d, roles, settings))
    df = stage(clear_layout(df))
    if "behavioral" in sets:
        df = step("behavioral", df, lambda d: behavioral(d, roles, settings))
    if "statistical" in sets:
        df = step("statistical", df, lambda d: statistical_tables(d, roles, settings))
    df = step("anomaly", df, lambda d: rules.weighted_rules(d, settings))
    return rules.over_maximum(stage(df), "Anomaly_Score"), catalogue


def catalogue_names(catalogue: dict[str, list[str]], sets: Sequence[str] | None = None) -> list[str]:
    """Feature names of the chosen sets, in order, without repeats."""
    return list(dict.fromkeys(reduce(lambda a, b: a + b, [catalogue.get(s, []) for s in sets or catalogue], [])))
