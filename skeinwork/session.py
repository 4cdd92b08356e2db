"""Spark sessions with the settings the engine relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_session(app: str = "skeinwork", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; a running session is reused."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    master = master or os.environ.get("SKEINWORK_MASTER")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
