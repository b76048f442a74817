"""Long <-> wide reshaping.

A wide table has one time column and one numeric column per site; its
schema depends on the data, so the site names are the only values ever
brought to the driver, and their number is checked first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import (as_ntz, discover_roles, dtype_of, nan_to_null,
                                  q)
from .pad import na_ts_insert

#: Columns of one wide table; more names make several tables (see ``name_groups``).
WIDE_COLUMNS = 1_000


def pivot_names(long: DataFrame, on: str) -> list:
    """Sorted distinct values of ``on``: the columns of a wide table, and so part of its schema."""
    return sorted(r[0] for r in long.select(on).distinct().collect() if r[0] is not None)


def name_groups(names: list, size: int = WIDE_COLUMNS) -> list[list]:
    """Names cut into runs of ``size``: one wide table each."""
    return [names[i:i + size] for i in range(0, len(names), size)] or [[]]


def to_wide(long: DataFrame, index: str = "TimeStamp", on: str = "Name", value: str = "Value",
            names=None, keys=()) -> DataFrame:
    """One row per time (per ``keys``), one column per ``on`` value.

    Names are passed to ``pivot`` explicitly (sorted), so Spark does not run
    its own distinct job and the column order is stable.
    """
    names = pivot_names(long, on) if names is None else list(names)
    return (long.groupBy(*keys, index).pivot(on, names)
                .agg(F.max(nan_to_null(value))))


def unpivot_long(wide: DataFrame, index: str | None = None, site: str = "Site",
                 value_name: str = "Value", drop_nulls: bool = True) -> DataFrame:
    """Wide -> long; missing cells are dropped (as SQL UNPIVOT does)."""
    index, cols = discover_roles(wide, (), index, None)
    long = wide.select(F.col(q(index)), *[nan_to_null(c).cast("double").alias(c) for c in cols])
    long = long.unpivot([F.col(q(index))], [F.col(q(c)) for c in cols], site, value_name)
    return long.filter(F.col(value_name).isNotNull()) if drop_nulls else long


def ts_melt(wide: DataFrame, index: str | None = None, site: str = "Site",
            value_name: str = "Value") -> DataFrame:
    """Long form where every site is padded at its own step."""
    index, _ = discover_roles(wide, (), index, None)
    long = unpivot_long(wide, index, site, value_name)
    return na_ts_insert(long, [site], index, [value_name]).select(site, index, value_name)


def ts_2_list(wide: DataFrame, index: str | None = None, site: str = "Site",
              value_name: str = "Value") -> DataFrame:
    """One padded series per site, keyed by ``site`` (not a driver list).

    Write it with ``sinks.write_per_site`` to get one folder per site.
    """
    return ts_melt(wide, index, site, value_name)


def daily_normalise(df: DataFrame, ts: str, daily: bool) -> DataFrame:
    """A daily table at 00:00 gets a DATE column ``Date``, else ``Time``."""
    if daily:
        return df.withColumn(ts, F.to_date(ts)).withColumnRenamed(ts, "Date")
    return df.withColumn(ts, as_ntz(ts, dtype_of(df, ts))).withColumnRenamed(ts, "Time")


def concat_frames(*frames: DataFrame) -> DataFrame:
    """Vertical concatenation by column name; columns missing from a
    frame are NULL (a "diagonal" concat)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


__all__ = ["to_wide", "unpivot_long", "ts_melt", "ts_2_list", "daily_normalise",
           "pivot_names", "name_groups", "concat_frames"]
