"""Session for local runs, tests and the benchmark."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", name: str = "tagloom") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.checkpoint.dir", os.environ.get("TAGLOOM_CHECKPOINTS", f"{tempfile.gettempdir()}/tagloom-checkpoints"))
        .config("spark.driver.memory", os.environ.get("TAGLOOM_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session for the jobs run inside; those from before come back after it."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
