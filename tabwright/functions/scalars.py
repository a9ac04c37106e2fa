"""Column expressions shared by the operators; all of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: characters that may stay in an identifier.
IDENTIFIER_CHARS = "a-zA-Z0-9_"

HASH_RANGE = float(2**32)


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, 0.0 when the denominator is 0 or either is null."""
    return F.coalesce(F.try_divide(numerator, denominator).cast("double"), F.lit(0.0))


def sanitize_identifier(address: Column) -> Column:
    """The part of ``address`` before the first ``@``, other characters made ``_``."""
    local_part = F.split_part(address, F.lit("@"), F.lit(1))
    return F.regexp_replace(local_part, f"[^{IDENTIFIER_CHARS}]", "_")


def hash_bucket(*parts: Column) -> Column:
    """A bigint in [0, 2^32) that depends on the parts' text only.

    md5 is used because any SQL engine can reproduce it; it does not depend on
    partitioning, row order or retries.
    """
    text = F.concat_ws(":", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_uniform(*parts: Column) -> Column:
    """A double in [0, 1) that depends on the parts' text only."""
    return hash_bucket(*parts) / F.lit(HASH_RANGE)


def logistic(score: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))


def col_of(name: str) -> Column:
    """A column by its exact name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_number(column: Column) -> Column:
    """The column as double with NaN read as missing."""
    number = column.cast("double")
    return F.when(~F.isnan(number), number)


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN in a floating-point column."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def seconds_of(name: str, data_type: T.DataType) -> Column:
    """A time or number column as a double that keeps its order.

    Zone-less timestamps are taken apart by calendar field, so that the session's
    time zone and its clock changes have no say in the order.
    """
    ts = F.col(name)
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(ts).cast("double") / F.lit(1e6)
    if isinstance(data_type, T.DateType):
        return F.unix_date(ts).cast("double") * F.lit(86400.0)
    if isinstance(data_type, T.TimestampNTZType):
        day = F.unix_date(ts.cast("date")).cast("double") * F.lit(86400.0)
        return (
            day
            + F.hour(ts).cast("double") * F.lit(3600.0)
            + F.minute(ts).cast("double") * F.lit(60.0)
            + F.date_part(F.lit("SECOND"), ts).cast("double")
        )
    return ts.cast("double")
