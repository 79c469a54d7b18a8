"""Local session used by tests, the check tool and the bench."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: str | int = 8, memory: str = "8g") -> SparkSession:
    os.environ.setdefault("PYSPARK_PYTHON", "python")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("quillon")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="quillon-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
