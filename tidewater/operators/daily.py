"""A9 ``hourly_2_daily`` with the X1 aggregate surface.

An hourly reading is labelled by the end of its hour, so a 00:00 value
belongs to the previous day; ``day_starts_at = h`` moves the boundary:
``Date = date(ts - (1 + h) hours)``, i.e. day D covers (D h:00, D+1 h:00].
A day is kept when its non-missing readings / 24 reach ``prop``; the
aggregate runs over the non-missing readings, and the daily result is
padded with :func:`na_ts_insert` (regular daily steps only).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import discover_roles, nan_to_null_sql, q
from .joins import materialise
from .pad import na_ts_insert

_NAMED = {
    "mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max,
    "median": F.median, "std": F.stddev_samp, "count": F.count,
}


def resolve_agg(agg):
    """Return (name, Column -> Column) for a name, a callable or a pandas UDF."""
    if isinstance(agg, str):
        if agg not in _NAMED:
            raise ValueError(f"unknown aggregate {agg!r}; choose from {sorted(_NAMED)}")
        return agg, _NAMED[agg]
    if callable(agg):
        name = getattr(agg, "__name__", None) or getattr(getattr(agg, "func", None), "__name__", "agg")
        return name, agg
    raise TypeError("agg must be a name or a callable Column -> Column")


def _is_pandas_agg(agg) -> bool:
    return getattr(agg, "evalType", None) is not None


def hourly_2_daily(df: DataFrame, keys=(), ts: str | None = None, value: str | None = None,
                   day_starts_at: int = 0, agg="mean", prop: float = 1.0,
                   pad: bool = True, pad_step_s: int | None = None) -> DataFrame:
    """Columns ``keys + ['Date', 'Agg_<name>']``; one row per kept or padded day.

    ``pad_step_s=86400`` pads every series daily between its first and last
    kept day (the R dialect) instead of at the step detected from the kept
    days.
    """
    if not isinstance(day_starts_at, int) or isinstance(day_starts_at, bool) \
            or not 0 <= day_starts_at <= 23:
        raise ValueError(f"a day starts at a whole hour from 0 to 23, not {day_starts_at!r}")
    if not 0 <= prop <= 1:
        raise ValueError(f"the share of hours a day needs lies between 0 and 1, not {prop!r}")
    keys = list(keys)
    ts, values = discover_roles(df, keys, ts, value)
    value = values[0]
    name, fn = resolve_agg(agg)
    out_col = f"Agg_{name}"
    day = f"to_date(CAST({q(ts)} AS TIMESTAMP_NTZ) - make_dt_interval(0, {1 + day_starts_at}, 0, 0))"
    base = df.selectExpr(*[q(k) for k in keys], f"{day} AS Date", f"{nan_to_null_sql(value)} AS __v")
    agg_col: Column = fn(F.col("__v"))
    keep = f"__n > 0 AND __n / 24.0 >= {float(prop)!r}"
    if _is_pandas_agg(agg):
        # a pandas aggregate cannot share an aggregation with count():
        # find the covered days first, then aggregate only those
        covered = base.groupBy(*keys, "Date").agg(F.count("__v").alias("__n")).filter(keep)
        daily = (base.filter("__v IS NOT NULL")
                     .join(covered.drop("__n"), [*keys, "Date"], "left_semi")
                     .groupBy(*keys, "Date").agg(agg_col.alias(out_col)))
    else:
        daily = (base.groupBy(*keys, "Date")
                     .agg(F.count("__v").alias("__n"), agg_col.alias(out_col))
                     .filter(keep).drop("__n"))
    if not pad:
        return daily
    # The daily table is small (series x days) and padding reads it three
    # times (extent, gaps, grid join): compute it once so the (large)
    # hourly input is scanned a single time.
    daily = materialise(daily).df
    return na_ts_insert(daily, keys, "Date", [out_col], step_s=pad_step_s)
