"""Session defaults for tests and benchmarks; a cluster brings its own session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, name: str = "odoscan") -> SparkSession:
    session = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        # Small test tables should still keep every local core busy.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
        .config("spark.sql.files.openCostInBytes", "131072")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def ship_package(spark: SparkSession) -> str:
    """Send this package to the executors, for clusters on which it is not installed."""
    import shutil
    import tempfile
    from pathlib import Path

    package = Path(__file__).resolve().parent
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='odoscan-')}/odoscan", "zip", package.parent, package.name)
    spark.sparkContext.addPyFile(archive)  # from the driver's disk; executors fetch their own copy
    return archive
