"""Column expressions. Stored timestamps are zone-less and hold UTC."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date, datetime, timedelta
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions import codes as C
from tagloom.functions.codes import TENANT_KEYS


def day(value: date | str) -> Column:
    return F.lit(str(value)).cast("date")


def moment(value: datetime | str) -> Column:
    """Zone-less time; a plain literal would be read in the session zone."""
    return F.lit(str(value)).cast("timestamp_ntz")


def days_before(value: date, n: int) -> Column:
    return day(value - timedelta(days=n))


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(or_, conditions, F.lit(False))


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def holds(condition: Column) -> Column:
    """A comparison with NULL counts as false."""
    return F.coalesce(condition, F.lit(False))


def zero_if_null(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0)).alias(column)


def between_zones(ts: Column, source: str, target: str) -> Column:
    return F.convert_timezone(F.lit(source), F.lit(target), ts)


def tenant_date(ts: Column) -> Column:
    """Calendar day of a UTC timestamp as the tenants count it (New York)."""
    return between_zones(ts.cast("timestamp_ntz"), "UTC", "America/New_York").cast("date")


def ingest_timestamp(ts: Column) -> Column:
    """Source clocks run 12 hours behind Taipei; stored as UTC."""
    return between_zones(ts + F.expr("INTERVAL 12 HOURS"), "Asia/Taipei", "UTC")


def code_for(column: Column, codes: Mapping, default) -> Column:
    return reduce(lambda acc, kv: F.when(column == kv[0], kv[1]).otherwise(acc), codes.items(), F.lit(default))


def band_by_threshold(reaches, bands: Mapping, default: int = 0) -> Column:
    """Code of the highest threshold reached; ``reaches(t)`` tests one threshold."""
    result = F.lit(default)
    for threshold in sorted(bands):
        result = F.when(reaches(threshold), bands[threshold]).otherwise(result)
    return result


def contains_any(column: Column, words: Iterable[str]) -> Column:
    return any_of(column.contains(w) for w in words)


def mask_prefix(column: str, keep: int, suffix: str = "*****") -> Column:
    return F.concat(F.substring(column, 1, keep), F.lit(suffix)).alias(column)


def base24_to_long(text: Column) -> Column:
    """Client ids are base-24 text; anything else decodes to 0."""
    clean = F.replace(text, F.lit("'"), F.lit(""))
    return F.when(
        clean.rlike("^[0-9a-nA-N]{1,13}$"), F.try_to_number(F.conv(clean, 24, 10), F.lit("9" * 20)).cast("long")
    ).otherwise(F.lit(0).cast("long"))


def ip_to_long(ip: Column) -> Column:
    parts = F.split(ip, r"\.")
    octet = lambda i: F.get(parts, F.lit(i)).try_cast("long")
    return octet(0) * 16777216 + octet(1) * 65536 + octet(2) * 256 + octet(3)


def iso_date(text: Column) -> Column:
    """``Y/M/D`` or unpadded dates to DATE; unreadable text to NULL."""
    parts = F.split(F.replace(text, F.lit("/"), F.lit("-")), "-")
    part = lambda i, n: F.lpad(F.get(parts, F.lit(i)), n, "0")
    return F.concat_ws("-", part(0, 4), part(1, 2), part(2, 2)).try_cast("date")


def tenant_columns(df: DataFrame, tenant: Mapping) -> DataFrame:
    """Prefix the tenant constants, in their fixed positions."""
    names = ["hall_id", "hall_name", "domain_id", "domain_name"]
    constants = [F.lit(tenant[n]).alias(n) for n in names if n in tenant]
    return df.select(*constants, *[c for c in df.columns if c not in tenant])


def _amount(column: Column, name: str, kind: T.DataType) -> Column:
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return column
    if isinstance(kind, T.DecimalType):
        digits = max(2, kind.scale)
        size = max(16, kind.precision - kind.scale) + digits
        return column.cast(f"decimal({size},{digits})") if size <= 38 else column
    if isinstance(kind, T.IntegralType):
        return column.cast("decimal(22,2)")
    if name != "balance":
        return column.cast("double")
    rounded = column.cast("decimal(18,2)")
    lost = F.concat(F.lit("a balance has more than two decimals: "), column).cast("string")
    return F.when(column.cast("decimal(38,18)") != rounded, F.raise_error(lost)).otherwise(rounded)


def conform_types(df: DataFrame) -> DataFrame:
    """Cast loaded columns by name: whole numbers (NULL is 0), text, amounts, dates and times.

    Amounts keep their digits: exact numbers have two decimals or more, floating
    ones stay so, text becomes floating. A balance given as text has two decimals;
    one with more digits is an error and not rounded.
    """
    def conformed(name: str) -> Column:
        column = F.col(name)
        if name in C.WHOLE_COLUMNS:
            column = F.coalesce(column.cast("long"), F.lit(0))
        elif name in C.TEXT_COLUMNS:
            column = column.cast("string")
        elif name in C.AMOUNT_COLUMNS:
            column = _amount(column, name, df.schema[name].dataType)
        elif name == "data_date":
            column = column.cast("date")
        elif name == "register_date":
            column = column.cast("timestamp_ntz")
        return column.alias(name)

    return df.select(*[conformed(c) for c in df.columns])


def of_tenant(tenant) -> Column:
    """Rows of one tenant, given by its ``hall_id`` and ``domain_id``."""
    return all_of(F.col(k) == tenant[k] for k in TENANT_KEYS)
