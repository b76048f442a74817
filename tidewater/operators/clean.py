"""Row filters on series frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import any_present, discover_roles, nan_to_null, q


def trim_ts(df: DataFrame, keys=(), ts: str | None = None, values=None,
            ordered: bool = False) -> DataFrame:
    """drop rows whose value columns are all missing; time column first."""
    keys = list(keys)
    ts, values = discover_roles(df, keys, ts, values)
    names = [F.col(q(c)) for c in [*keys, ts]]
    out = df.filter(any_present(values)).select(*names, *[nan_to_null(v).alias(v) for v in values])
    return out.orderBy(*names) if ordered else out


def drop_any_null(df: DataFrame, subset=None) -> DataFrame:
    """drop rows with a NULL in any (or any listed) column."""
    return df.na.drop("any", subset=subset)


def value_present(df: DataFrame, value: str = "Value") -> DataFrame:
    """keep rows whose value is a real number (NULL and NaN dropped)."""
    return df.filter(nan_to_null(value).isNotNull())
