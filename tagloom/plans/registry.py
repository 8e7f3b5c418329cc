"""Registry of queries: a builder over the inputs and the equivalent plain SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from tagloom.plans.inputs import Inputs, with_inputs

START, END = date(2024, 1, 3), date(2024, 1, 27)
AS_OF, TODAY = date(2024, 1, 30), date(2024, 1, 31)
NOW = datetime(2024, 1, 31, 6, 0, 0)
TENANT = {"hall_id": 1, "hall_name": "hall", "domain_id": 1, "domain_name": "domain"}
USER = "hall_id, domain_id, user_id"
NAMED = f"{USER}, user_name, register_date"


@dataclass
class Query:
    build: Callable[[Inputs], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None, parts: dict[str, str] | None = None):
    """Register a builder. ``parts`` are named sub-statements of ``sql``, in order of use."""

    def register(build):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(build, None if sql is None else with_inputs(sql, "TIMESTAMP", parts))
        return build

    return register


def run(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: REGISTRY[name].build(Inputs(spark, folder))
