"""Folders of per-vehicle files, read as one table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odoscan.config import Roles, Settings
from odoscan.operators.cleaning import null_markers, parse_time
from odoscan.operators.ordering import stage
from odoscan.operators.shaping import drop_duplicate_columns
from odoscan.sources.files import ERROR, HEADERS, RAGGED, FolderSource, canonical_names

__all__ = ["canonical_names", "file_report", "folder_columns", "load_folder", "normalise_headers", "read_folder", "read_headers", "read_table", "union_all"]


def normalise_headers(df: DataFrame, aliases: dict[str, str] | None = None, keep: str = "first") -> DataFrame:
    """Canonical column names; columns that become the same are reduced to one."""
    return drop_duplicate_columns(df, canonical_names(df.columns, aliases), keep)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Outer union by column name; absent columns are null."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first


def _reader(spark: SparkSession, directory: str, pattern: str, **options):
    spark.dataSource.register(FolderSource)
    return spark.read.format(FolderSource.name()).options(pattern=pattern, **options)


def read_headers(spark: SparkSession, directory: str, pattern: str = "*.csv") -> DataFrame:
    """One row per file: path, number, bytes, names and types of its columns, and the error if it cannot be read.

    Tasks read the header record or the footer of their files, nothing else.
    """
    return _reader(spark, directory, pattern, what="headers").schema(HEADERS).load(directory)


def folder_columns(headers: DataFrame) -> dict[str, str]:
    """Names and types of the folder's table: all columns of all layouts, by first file; differing types become text.

    Only the distinct columns reach the driver.
    """
    cells = headers.filter("error is null").select("file", F.posexplode(F.arrays_zip("names", "types")).alias("at", "c"))
    found = cells.groupBy("c.names", "c.types").agg(F.min(F.struct("file", "at")).alias("first")).collect()
    columns: dict[str, str] = {}
    for row in sorted(found, key=lambda r: r["first"]):
        name = canonical_names([row["names"]])[0]
        columns[name] = row["types"] if columns.get(name, row["types"]) == row["types"] else "string"
    return columns


def read_folder(
    spark: SparkSession, directory: str, pattern: str = "*.csv", roles: Roles = Roles(), keep: str = "first", group_bytes: int = 128 << 20
) -> tuple[DataFrame, DataFrame]:
    """(rows, errors): all rows of all readable files, written once, and (path, error) of the others.

    A file counts as a whole: one that turns out to be damaged in its middle gives no row. The rows
    carry the entity in the file's name, its path, a record number unless the files have one, and
    ``RAGGED`` for records of another length than their header.
    """
    try:
        headers = stage(read_headers(spark, directory, pattern))
    except Exception as error:
        if "directory not found" in str(error):
            raise ValueError(f"directory not found: {directory}") from error
        raise
    known, readable = headers.agg(F.count(F.lit(1)), F.count_if(F.col("error").isNull())).first()
    if not known:
        raise ValueError(f"no files matching {pattern!r} in {directory}")
    if not readable:
        raise ValueError("no valid data files were loaded")
    columns = folder_columns(headers)
    columns |= {roles.entity: "string", roles.source: "string"}  # the file's name decides
    columns.setdefault(roles.record, "bigint")
    schema = ", ".join(f"`{name}` {kind}" for name, kind in {**columns, RAGGED: "boolean", ERROR: "string"}.items())
    named = {"entity": roles.entity, "source": roles.source, "record": roles.record}
    reader = _reader(spark, directory, pattern, keep=keep, groupBytes=group_bytes, **named)
    read = stage(reader.schema(schema).load(directory))
    errors = read.filter(F.col(ERROR).isNotNull()).select(F.col(roles.source).alias("path"), F.col(ERROR).alias("error"))
    rows = read.filter(F.col(ERROR).isNull()).drop(ERROR)
    if not errors.isEmpty():
        # Broadcast, as the planner holds the list of files anyway: dealt by path, a file's rows would meet in one task.
        damaged = F.broadcast(errors.select(F.col("path").alias("_path")))
        rows = rows.join(damaged, F.col(roles.source) == F.col("_path"), "left_anti")
    return rows, errors


def file_report(rows: DataFrame, errors: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """One row per file: path, rows, ragged rows, error."""
    read = rows.groupBy(F.col(roles.source).alias("path")).agg(F.count(F.lit(1)).alias("rows"), F.count_if(RAGGED).alias("ragged"))
    none = F.lit(0).cast("long")
    return read.withColumn("error", F.lit(None).cast("string")).unionByName(errors.select("path", none.alias("rows"), none.alias("ragged"), "error"))


def load_folder(
    spark: SparkSession,
    directory: str,
    pattern: str = "*.csv",
    roles: Roles = Roles(),
    settings: Settings = Settings(),
) -> tuple[DataFrame, list[str]]:
    """Read a folder, null the missing markers and parse times; also the paths that could not be read.

    Records are numbered by file and place in it, so the numbers depend on the files alone.
    """
    rows, errors = read_folder(spark, directory, pattern, roles)
    df = parse_time(null_markers(rows.drop(RAGGED), settings), roles)
    return df, sorted(r["path"] for r in errors.select("path").collect())


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """One CSV or Parquet path, chosen by its extension."""
    if path.endswith(".csv"):
        return spark.read.option("header", True).csv(path)
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    raise ValueError(f"unsupported file type: {path}")
