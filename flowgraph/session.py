"""The session settings this package is tuned for. A cluster caller may pass any session of its own."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "flowgraph") -> SparkSession:
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("FLOWGRAPH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(2 * max(4, cores)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Two sides partitioned by a block of steps stay where they are in joins on (block, node).
        .config("spark.sql.requireAllClusterKeysForCoPartition", "false")
        .getOrCreate()
    )
