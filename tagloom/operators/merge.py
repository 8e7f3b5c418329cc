"""Keyed writes as pure table transformations: (target, source) to new target.

Keys are unique on both sides, as in the stores these replace; each merge is
one join on the key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _merged(target: DataFrame, source: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Source values where the key is in the source, else the target's."""
    given = [c for c in source.columns if c not in keys]
    renamed = source.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in given], F.lit(True).alias("_given"))
    value = lambda c: F.when(F.col("_given"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
    return target.join(renamed, list(keys), how).select(
        *[value(c) if c in given else F.col(c) for c in target.columns])


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert new keys, update the given columns of existing ones."""
    return _merged(target, source, keys, "full_outer")


def update(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Update existing keys only."""
    return _merged(target, source, keys, "left")


def replace(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete and insert: columns the source lacks become NULL."""
    return target.join(source.select(*keys), list(keys), "left_anti").unionByName(source, allowMissingColumns=True)


def insert(target: DataFrame, source: DataFrame) -> DataFrame:
    return target.unionByName(source, allowMissingColumns=True)


def insert_ignore(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert; existing keys keep their row."""
    return insert(target, source.join(target.select(*keys), list(keys), "left_anti"))


def delete_keys(target: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.join(keys_df.select(*keys).distinct(), list(keys), "left_anti")


def delete_key_range(target: DataFrame, keys: Sequence[str], low: Sequence, high: Sequence) -> DataFrame:
    """Delete the closed range of composite keys."""
    key = F.struct(*[F.col(k) for k in keys])

    def bound(values):
        return F.struct(*[F.lit(v).cast(target.schema[k].dataType).alias(k) for k, v in zip(keys, values)])

    return target.filter(~key.between(bound(low), bound(high)))


def update_where(target: DataFrame, condition: Column, assignments: Mapping[str, Column]) -> DataFrame:
    hit = F.coalesce(condition, F.lit(False))
    return target.select(*[
        F.when(hit, assignments[c]).otherwise(F.col(c)).alias(c) if c in assignments else F.col(c)
        for c in target.columns])


def delete_where(target: DataFrame, condition: Column) -> DataFrame:
    return target.filter(~F.coalesce(condition, F.lit(False)))
