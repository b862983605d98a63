"""Sessions with the settings that the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Set on any session that runs the engine's queries.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def get_session(name: str = "tidelog", master: str | None = None, **conf: str) -> SparkSession:
    b = SparkSession.builder.appName(name)
    if master:
        b = b.master(master)
    for k, v in (SETTINGS | {k.replace("__", "."): v for k, v in conf.items()}).items():
        b = b.config(k, v)
    return b.getOrCreate()
