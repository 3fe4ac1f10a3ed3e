"""Spark session with the settings that the plans of this library rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Later keys win when maps are merged, as in a JSON object; times are UTC.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "lanemesh", master: str | None = None, **conf: str) -> SparkSession:
    """A session with REQUIRED set; `conf` keys use `__` in place of dots."""
    builder = SparkSession.builder.appName(app).config(map=REQUIRED)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
