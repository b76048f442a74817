"""A10 ``ts_info``: availability of each site (Start, End, Length_yr, Completion_%).

``Length_yr = (End - Start) / 365.2422 days``. For a regular frame with step
``s`` (in days) the record is widened by one step and
``Completion_% = n * s / (days + s) * 100`` where ``n`` counts the present
readings. An irregular frame gets no completion. The step is frame-wide by
default (as for a wide table: times where any site has a value); use
``scope='series'`` for one step per site.

Without ``frame_keys`` the frame's step decides the schema, as in the
reference: no step (fewer than two times) gives an empty result, an
irregular frame has no ``Completion_%`` column. With ``frame_keys`` (many
frames at once) the column is always there and NULL where irregular.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timecols import (US_PER_SECOND, as_ntz, discover_roles,
                                  dtype_of, micros, nan_to_null)
from .joins import SmallTable, join_keyed
from .step import step_table

# Fixed value: days per year used for record lengths.
DAYS_PER_YEAR = 365.2422


def ts_info(df: DataFrame, site: str = "Site", ts: str | None = None, value: str | None = None,
            scope: str = "frame", frame_keys=(), min_step_s: int = 60) -> DataFrame:
    frame_keys = list(frame_keys)
    keys = frame_keys + [site]
    ts, values = discover_roles(df, keys, ts, value)
    value = values[0]
    t = as_ntz(ts, dtype_of(df, ts))
    v = nan_to_null(value)
    step_keys = keys if scope == "series" else frame_keys
    st = step_table(df.select(*keys, ts, v.alias(value)), step_keys, ts, [value], min_step_s)

    if scope == "frame" and not frame_keys:
        row = st.df.select("step_us").first()
        step = row["step_us"] if row else None
        if step is None:
            return df.sparkSession.createDataFrame(
                [], T.StructType([T.StructField(site, df.schema[site].dataType),
                                  T.StructField("Start", T.TimestampNTZType()),
                                  T.StructField("End", T.TimestampNTZType()),
                                  T.StructField("Length_yr", T.DoubleType()),
                                  T.StructField("Completion_%", T.DoubleType())]))
        with_completion = step > 0
    else:
        with_completion = True

    p = v.isNotNull()
    per_site = df.groupBy(*keys).agg(
        F.min(F.when(p, t)).alias("Start"), F.max(F.when(p, t)).alias("End"),
        F.count(v).alias("__n"))
    per_site = join_keyed(per_site, SmallTable(st.df.select(*step_keys, "step_us"), st.rows),
                          step_keys, "left")
    span_days = (micros("End") - micros("Start")) / F.lit(86_400.0 * US_PER_SECOND)
    step_day = F.col("step_us") / F.lit(86_400.0 * US_PER_SECOND)
    regular = F.col("step_us") > 0
    length = span_days / F.lit(DAYS_PER_YEAR)
    out = per_site.select(
        *keys, "Start", "End",
        F.when(regular, length + step_day / F.lit(DAYS_PER_YEAR)).otherwise(length).alias("Length_yr"),
        F.when(regular, F.col("__n") * step_day / (span_days + step_day) * 100.0).alias("Completion_%"))
    return out if with_completion else out.drop("Completion_%")
