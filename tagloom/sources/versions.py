"""Groups of tables that change together: readers see a whole version or the one before.

A version is a folder of its own; it counts from the moment its marker exists.
Markers are numbered and created only if absent, so of two writers that started
from one version the second fails. A write that stops halfway leaves a folder
without marker, which nobody reads and ``drop_versions`` removes.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

DONE, DATA = "_done", "_data"


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, place = _place(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def _folder_of(spark: SparkSession, root: str, version: int) -> str | None:
    """The folder that a marker names; None while it is being written."""
    fs, place = _place(spark, f"{root}/{DONE}/{version:012d}")
    stream = fs.open(place)
    try:
        name = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    return name or None


def published_version(spark: SparkSession, root: str) -> int | None:
    versions = [int(n) for n in _names(spark, f"{root}/{DONE}") if n.isdigit()]
    return next((v for v in reversed(versions) if _folder_of(spark, root, v)), None)


def read_published(spark: SparkSession, root: str, table: str, version: int | None = None) -> DataFrame:
    """A table of the latest version, or of a given one."""
    version = published_version(spark, root) if version is None else version
    if version is None:
        raise FileNotFoundError(f"nothing is published in {root}")
    return spark.read.parquet(f"{root}/{DATA}/{_folder_of(spark, root, version)}/{table}")


def publish(tables: Mapping[str, DataFrame], root: str, based_on: int | None = None) -> int:
    """Write all tables of a group as its next version and return that version's number.

    The tables may be computed from the version before, whose files stay.
    ``based_on`` is the version they were computed from (the latest unless
    given); if another one has been published since, nothing changes and this fails.
    """
    spark = next(iter(tables.values())).sparkSession
    latest = published_version(spark, root)
    base = latest if based_on is None else based_on
    folder = str(uuid.uuid4())
    for name, df in tables.items():
        df.write.parquet(f"{root}/{DATA}/{folder}/{name}")
    number = (base or 0) + 1
    fs, marker = _place(spark, f"{root}/{DONE}/{number:012d}")
    try:
        stream = fs.create(marker, False)
    except Exception as error:
        raise RuntimeError(f"version {number} of {root} was published by another writer") from error
    try:
        stream.write(bytearray(folder.encode()))
    finally:
        stream.close()
    return number


def drop_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove all but the latest versions, and what stopped writes have left; no write may be under way."""
    markers = [int(n) for n in _names(spark, f"{root}/{DONE}") if n.isdigit()]
    kept = {v: f for v in markers if (f := _folder_of(spark, root, v))}
    kept = dict(list(kept.items())[-keep:])
    gone = [n for n in _names(spark, f"{root}/{DATA}") if n not in kept.values()]
    for v in set(markers) - set(kept):
        fs, marker = _place(spark, f"{root}/{DONE}/{v:012d}")
        fs.delete(marker, False)
    for name in gone:
        fs, place = _place(spark, f"{root}/{DATA}/{name}")
        fs.delete(place, True)
    return gone
