"""Session settings that the jobs rely on; a cluster's own session works as well."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

LOCAL_SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.driver.memory": "8g",
    "spark.sql.shuffle.partitions": "8",
}


def local_session(cpus: int | str = "*", app_name: str = "labelflow") -> SparkSession:
    """Session for tests, the bench and laptop use."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app_name)
    for key, value in {**SETTINGS, **LOCAL_SETTINGS}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def session(app_name: str = "labelflow") -> SparkSession:
    """Session of a submitted job: master, memory and partitions come from the submit command."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
