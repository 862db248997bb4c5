"""Spark sessions with the settings the engine is written for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

#: Session settings that results depend on (UTC clock, ANSI errors) or that plans need.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cpus: int | None = None, name: str = "lattica", memory: str = "8g") -> SparkSession:
    """A session on this machine; on a cluster use the session of the job."""
    cpus = cpus or os.cpu_count() or 4
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    more = {"spark.driver.memory": memory, "spark.sql.shuffle.partitions": str(cpus), "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    for key, value in (SETTINGS | more).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
