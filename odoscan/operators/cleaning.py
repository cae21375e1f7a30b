"""From raw text rows to typed, de-duplicated, in-range rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odoscan.config import Roles, Settings, Track
from odoscan.operators.ordering import bounded, lay_out, look_around, position


def flag(condition: Column) -> Column:
    """0/1 integer; an unknown condition counts as 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def null_markers(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Replace missing-value markers by null in every text column."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    changed = {}
    for name in text:
        value = F.col(f"`{name}`")
        changed[name] = F.when(value.isin(list(settings.missing_markers)), None).otherwise(value)
    return df.withColumns(changed) if changed else df


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: how many nulls it holds. A single pass."""
    columns = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "null_count")


def parse_time(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Coerce the event time; rows whose time does not parse are dropped."""
    if roles.time not in df.columns:
        return df
    return df.withColumn(roles.time, F.col(roles.time).try_cast("timestamp_ntz")).filter(F.col(roles.time).isNotNull())


def parse_numbers(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Coerce the measures to double; text that is no number, and NaN, become null."""
    present = [c for c in settings.numeric_columns if c in df.columns]
    return df.withColumns(
        {c: F.nullif(F.col(f"`{c}`").try_cast("double"), F.lit(float("nan"))) for c in present}
    ) if present else df


def fill_ignition(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Missing ignition is off when the vehicle stands or its speed is unknown, else on."""
    if roles.ignition not in df.columns or roles.speed not in df.columns:
        return df
    speed = F.col(roles.speed).try_cast("double")
    guess = F.when(speed.isNull() | (speed == 0), 0).otherwise(1)
    known = F.col(roles.ignition).try_cast("double").cast("int")
    return df.withColumn(roles.ignition, F.coalesce(known, guess))


def split_coordinates(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """``"lat,lon"`` text into two doubles; values outside the globe become null."""
    if roles.coordinates not in df.columns:
        return df
    parts = F.split(roles.coordinates, ",")

    def part(i: int, bound: int) -> Column:
        value = F.try_element_at(parts, F.lit(i)).try_cast("double")
        return F.when(value.between(-bound, bound), value)

    return df.withColumns({"Latitude": part(1, 90), "Longitude": part(2, 180)})


def drop_duplicates(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Keep the earliest record of each (entity, time, level); null levels are equal.

    An aggregation, not a ranking: copies collapse before the shuffle, so any
    number of copies of one row costs each task one row.
    """
    keys = [c for c in (roles.entity, roles.time, roles.level) if c in df.columns]
    if not keys:
        return df
    rest = [c for c in df.columns if c not in keys]
    earliest = F.min_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.col(roles.record))
    kept = df.groupBy(*keys).agg(earliest.alias("_kept"))
    return kept.select(
        *[F.col(f"`{c}`") if c in keys else F.col("_kept").getField(c).alias(c) for c in df.columns]
    )


def filter_ranges(df: DataFrame, roles: Roles = Roles(), settings: Settings = Settings(), keep_nulls: bool = False) -> DataFrame:
    """Keep plausible speeds and levels. Null measures go too unless ``keep_nulls``."""
    for column, (low, high) in ((roles.speed, settings.speed_bounds), (roles.level, settings.level_bounds)):
        if column in df.columns:
            inside = F.col(column).between(low, high)
            df = df.filter(inside | F.col(column).isNull() if keep_nulls else inside)
    return df


def clean(df: DataFrame, roles: Roles = Roles(), settings: Settings = Settings(), keep_nulls: bool = False) -> DataFrame:
    """All cleaning steps. Numbers are parsed before ignition so that text zeros count as zero."""
    return (
        df.transform(null_markers, settings)
        .transform(parse_numbers, settings)
        .transform(fill_ignition, roles)
        .transform(parse_time, roles)
        .transform(split_coordinates, roles)
        .transform(drop_duplicates, roles)
        .transform(filter_ranges, roles, settings, keep_nulls)
    )


def cleaning_report(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """One row: rows before and after, rows removed, and their percentage."""
    before = raw.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = cleaned.agg(F.count(F.lit(1)).alias("final_rows")).withColumn("original_rows", before)
    removed = F.col("original_rows") - F.col("final_rows")
    return counts.select(
        "original_rows",
        "final_rows",
        removed.alias("rows_removed"),
        (F.try_divide(removed, F.col("original_rows")) * 100).alias("removal_percentage"),
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def interpolate(
    df: DataFrame, track: Track, columns: Sequence[str] | None = None, keep_out: Sequence[str] = ("rec_id", "Stationary_drain")
) -> DataFrame:
    """Fill nulls on the straight line (by row position) between known neighbours.

    The ends take the nearest known value; a series without any stays null.
    """
    if columns is None:
        columns = [c for c in numeric_columns(df) if c not in keep_out and not c.startswith("_")]
    df = df.withColumn("_at", position(df, track))
    known = {c: F.when(F.col(c).isNotNull(), F.struct(F.col(c).cast("double").alias("v"), F.col("_at").alias("p"))) for c in columns}
    df = look_around(
        df, track, last={f"_before_{c}": e for c, e in known.items()}, ahead={f"_after_{c}": e for c, e in known.items()}
    )

    def filled(c: str) -> Column:
        a, b = F.col(f"_before_{c}"), F.col(f"_after_{c}")
        share = F.try_divide(F.col("_at") - a["p"], b["p"] - a["p"])
        line = a["v"] + (b["v"] - a["v"]) * share
        return F.coalesce(F.col(c).cast("double"), line, a["v"], b["v"])

    helpers = [f"_{side}_{c}" for c in columns for side in ("before", "after")]
    return df.withColumns({c: filled(c) for c in columns}).drop("_at", *helpers)


def validate(
    df: DataFrame, roles: Roles = Roles(), settings: Settings = Settings(), required: Sequence[str] | None = None
) -> DataFrame:
    """One row per kind of issue: its name, how often it occurs, and whether it occurs at all.

    Backward steps are looked for in arrival order (by record id).
    """
    required = required or (roles.entity, roles.time, roles.level)
    spark = df.sparkSession
    missing = len([c for c in required if c not in df.columns])
    found = [F.lit(missing).cast("long").alias("missing_columns"), flag(F.count(F.lit(1)) == 0).cast("long").alias("empty")]
    all_null = [flag((F.count(F.col(f"`{c}`")) == 0) & (F.count(F.lit(1)) > 0)) for c in df.columns]
    found.append(sum(all_null[1:], all_null[0]).cast("long").alias("all_null_columns"))
    kinds = ["missing_columns", "empty", "all_null_columns"]
    issues = df
    if roles.time in df.columns:
        found.append(F.count_if(F.col(roles.time).isNull()).alias("null_times"))
        kinds.append("null_times")
    counts = issues.agg(*found).unpivot([], kinds, "issue", "occurrences")
    if roles.time in df.columns and roles.entity in df.columns:
        counts = counts.unionByName(backward_steps(df, roles, settings))
    return counts.withColumn("present", flag(F.col("occurrences") > 0))


def backward_steps(df: DataFrame, roles: Roles, settings: Settings) -> DataFrame:
    """How many rows carry an earlier time than the row that arrived before them."""
    arrival = Track(roles.entity, (roles.record,), settings.block_rows)
    rows = lay_out(df.select(roles.entity, roles.time, roles.record), arrival)

    def step(frame, window):
        return frame.withColumn("_back", F.col(roles.time) < F.lag(roles.time).over(window))

    back = bounded(rows, arrival, 1, step)
    return back.agg(F.count_if("_back").alias("occurrences")).select(F.lit("time_travel").alias("issue"), "occurrences")
