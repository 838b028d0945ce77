"""Times as UTC ``timestamp_ntz``, whatever the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ZONE = r"(?:[Zz]|[+-]\d{2}(?::?\d{2})?)$"


def _instant_to_ntz(instant: Column) -> Column:
    micros = F.unix_micros(instant).cast("decimal(20,0)")
    seconds = (micros / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def utc_time(text: Column) -> Column:
    """ISO-8601 text with any zone as the UTC time; text without zone is UTC, other text null."""
    trimmed = F.regexp_replace(F.trim(text), r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2})(?=$|[Zz+-])", "$1:00")
    zoned = F.when(trimmed.rlike(_ZONE), trimmed).otherwise(F.concat(trimmed, F.lit("Z")))
    parsed = F.when(trimmed.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}"), zoned.try_cast("timestamp"))
    return _instant_to_ntz(parsed)


def as_utc(df: DataFrame, name: str) -> Column:
    """Column ``name`` of ``df`` as UTC time, be it text, ``timestamp`` or ``timestamp_ntz``."""
    kind = dict(df.dtypes)[name]
    if kind == "string":
        return utc_time(F.col(name))
    return _instant_to_ntz(F.col(name)) if kind == "timestamp" else F.col(name)
