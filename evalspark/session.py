"""Sessions: local ones for tests and bench, and what Python workers need of any session."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession


def importable(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package where the driver found it by its own path."""
    root = str(Path(__file__).resolve().parent.parent)
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark


def local_session(cpus: int = 8, partitions: int = 8, memory: str = "8g", warehouse: str | None = None) -> SparkSession:
    """A session on this machine, for tests and bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("evalspark")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if warehouse:
        builder = builder.config("spark.sql.warehouse.dir", warehouse)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return importable(spark)
