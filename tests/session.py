"""Local session for tests and measurements."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: str = "8", warehouse: str | None = None) -> SparkSession:
    warehouse = warehouse or tempfile.mkdtemp(prefix="warehouse-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("gridiron")
        .config("spark.sql.shuffle.partitions", "8" if cpus == "*" else cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", os.path.join(warehouse, "tables"))
        # Small inputs: let eight cores share what would otherwise become one or two tasks.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128KB")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
