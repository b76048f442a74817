"""Time-column helpers that keep TIMESTAMP_NTZ arithmetic exact.

All series maths runs on whole microseconds since the epoch (``bigint``):
differences, steps and grids are integer arithmetic, so no session time
zone or floating point enters. ``date_trunc`` is avoided on purpose: it
returns a zone-aware TIMESTAMP and would re-bucket wall times around DST.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


US_PER_SECOND = 1_000_000
US_PER_HOUR = 3_600 * US_PER_SECOND
US_PER_DAY = 86_400 * US_PER_SECOND

TEMPORAL_TYPES = (T.TimestampNTZType, T.TimestampType, T.DateType)


def col_(c) -> Column:
    """A column by its exact name (dots and blanks included), or as given."""
    return F.col(q(c)) if isinstance(c, str) else c


def as_ntz(c, dtype: T.DataType | None = None) -> Column:
    """Any temporal column as TIMESTAMP_NTZ (dates at midnight)."""
    c = col_(c)
    if dtype is None or isinstance(dtype, T.TimestampNTZType):
        return c if dtype is not None else c.cast("timestamp_ntz")
    return c.cast("timestamp_ntz")


def micros(c) -> Column:
    """Microseconds since 1970-01-01 00:00 of an NTZ timestamp (bigint).

    Built from the date and the clock fields: unlike ``timestampdiff``, which
    goes through the session time zone, no wall time is skipped or doubled.
    """
    c = col_(c)
    whole = (F.unix_date(F.to_date(c)).cast("bigint") * 86_400 + F.hour(c) * 3_600 + F.minute(c) * 60)
    return whole * US_PER_SECOND + (F.extract(F.lit("SECOND"), c) * US_PER_SECOND).cast("bigint")


def nan_to_null(c) -> Column:
    """NaN is a missing reading: map it to NULL (Spark aggregates count NaN)."""
    c = col_(c)
    return F.when(~F.isnan(c), c)


def any_present(values) -> Column:
    """True when at least one value column holds a real (non-NaN) number."""
    values = list(values)
    if not values:
        return F.lit(True)
    return F.coalesce(*[nan_to_null(v) for v in values]).isNotNull()


def is_temporal(dt: T.DataType) -> bool:
    return isinstance(dt, TEMPORAL_TYPES)


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType)


def discover_roles(df: DataFrame, keys=(), ts: str | None = None,
                   values=None) -> tuple[str, list[str]]:
    """Find the time column and the numeric value columns by type.

    Exactly one temporal column outside ``keys`` is required unless ``ts`` is
    given; value columns default to every numeric column outside ``keys``.
    """
    keys = set(keys)
    fields = [f for f in df.schema.fields if f.name not in keys]
    if ts is None:
        temporal = [f.name for f in fields if is_temporal(f.dataType)]
        if len(temporal) != 1:
            raise TypeError(f"need exactly one temporal column, found {temporal}")
        ts = temporal[0]
    if values is None:
        values = [f.name for f in fields if f.name != ts and is_numeric(f.dataType)]
    else:
        values = [values] if isinstance(values, str) else list(values)
    if not values:
        raise TypeError("no numeric value column found")
    return ts, values


def dtype_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


# ---- SQL-text forms (one JVM call per expression when building plans)

EPOCH_SQL = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def q(name: str) -> str:
    """Back-quote a column name for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def micros_sql(ts: str) -> str:
    """Micros since the epoch of a temporal column (DATE too); see :func:`micros`."""
    t = f"CAST({q(ts)} AS TIMESTAMP_NTZ)"
    return (f"((CAST(unix_date(to_date({t})) AS BIGINT) * 86400 + hour({t}) * 3600 + minute({t}) * 60) "
            f"* {US_PER_SECOND} + CAST(extract(SECOND FROM {t}) * {US_PER_SECOND} AS BIGINT))")


def from_micros_sql(expr: str) -> str:
    """Inverse of :func:`micros_sql`: whole days and the rest of the day added to the epoch."""
    rest = f"pmod({expr}, {US_PER_DAY})"
    return (f"({EPOCH_SQL} + make_dt_interval(CAST((({expr}) - {rest}) div {US_PER_DAY} AS INT), 0, 0, "
            f"CAST({rest} / {US_PER_SECOND} AS DECIMAL(18, 6))))")


def nan_to_null_sql(c: str) -> str:
    return f"CASE WHEN NOT isnan({q(c)}) THEN {q(c)} END"


def present_sql(values) -> str:
    """At least one value column holds a real (non-NaN) number."""
    values = [values] if isinstance(values, str) else list(values)
    if not values:
        return "true"
    return "coalesce(" + ", ".join(nan_to_null_sql(v) for v in values) + ") IS NOT NULL"


def bucket_sql(ts: str, period: str, label: str = "start") -> str:
    """Start or end of the hour / day / month that holds ``ts`` as TIMESTAMP_NTZ."""
    t = f"CAST({q(ts)} AS TIMESTAMP_NTZ)"
    day, end = f"to_date({t})", label == "end"
    if period == "hour":
        return f"(CAST({day} AS TIMESTAMP_NTZ) + make_dt_interval(0, hour({t}) + {int(end)}, 0, 0))"
    if period == "day":
        return f"CAST({f'date_add({day}, 1)' if end else day} AS TIMESTAMP_NTZ)"
    if period == "month":
        d = f"trunc({day}, 'month')"
        return f"CAST({f'add_months({d}, 1)' if end else d} AS TIMESTAMP_NTZ)"
    raise ValueError(f"unknown period {period!r}; use hour, day or month")
