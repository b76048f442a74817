"""A1 ``data_range_summary`` (+ A16 extended statistics) and A12 counts.

One row per series: representative attributes, first/last time with a
value, min/max rounded to 3 digits and the time of each extreme (earliest
time on ties). ``min_by``/``max_by`` over a ``(value, time)`` struct keeps
this a single partial+final hash aggregate: a hot series is reduced
map-side, never gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import nan_to_null, q
from .joins import join_keyed

# Percentiles of the extended summary: column name and share.
EXT_PERCENTILES = {"25%": 0.25, "Median": 0.5, "75%": 0.75}


def quantiles(df: DataFrame, keys, value: str, shares: dict, parts: int | None = None) -> DataFrame:
    """Exact interpolated quantiles of a numeric column without missing values.

    Equal values are counted first (map-side combined), and the counts are
    range-partitioned on (series, value), so a hot series is spread evenly.
    Running counts inside a partition start from the sums of the partitions
    before (a table of one row per partition and series); the two values that
    bracket each rank are then picked by an aggregate. No series is buffered.
    """
    keys = list(keys)
    K = [q(k) for k in keys]
    by = ", ".join(K)
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.selectExpr(*K, f"{q(value)} AS __v").groupBy(*K, "__v").agg(F.count("*").alias("__c"))
    # written once: running counts and their starts must see the same partitions
    ranged = counts.repartitionByRange(parts, *K, "__v").withColumn("__p", F.spark_partition_id()).persist()
    starts = ranged.groupBy(*K, "__p").agg(F.sum("__c").alias("__s")).selectExpr(
        *K, "__p", f"sum(__s) OVER (PARTITION BY {by} ORDER BY __p) - __s AS __start",
        f"sum(__s) OVER (PARTITION BY {by}) AS __n")
    run = join_keyed(ranged, starts, [*keys, "__p"]).selectExpr(
        *K, "__v", "__n", f"__start + sum(__c) OVER (PARTITION BY {by}, __p ORDER BY __v) AS __to", "__c")
    picks = []
    for i, share in enumerate(shares.values()):
        for side, rank in (("lo", f"floor((__n - 1) * {share})"), ("hi", f"ceil((__n - 1) * {share})")):
            picks.append(F.expr(f"max(CASE WHEN __to - __c <= {rank} AND {rank} < __to THEN __v END) AS __{side}{i}"))
    got = run.groupBy(*K).agg(F.max("__n").alias("__n"), *picks)
    return got.selectExpr(*K, *[
        f"__lo{i} + (__hi{i} - __lo{i}) * ((__n - 1) * {share} - floor((__n - 1) * {share})) AS {q(name)}"
        for i, (name, share) in enumerate(shares.items())])


def data_range_summary(df: DataFrame, keys=("folder", "Name", "ts_id", "CSV"),
                       ts: str = "TimeStamp", value: str = "Value",
                       attrs=("Plate", "Description", "Unit"), null_rule: str = "value",
                       digits: int = 3, extended: bool = False) -> DataFrame:
    keys = list(keys)
    attrs = [a for a in attrs if a in df.columns]
    v = nan_to_null(value)
    if null_rule == "any":
        base = df.withColumn(value, v).na.drop("any")
    elif null_rule == "value":
        base = df.withColumn(value, v).filter(F.col(value).isNotNull())
    else:
        raise ValueError("null_rule must be 'value' or 'any'")
    val, t = F.col(value), F.col(ts)
    aggs = [F.min(a).alias(a) for a in attrs] + [
        F.min(t).alias("Start"), F.max(t).alias("End"),
        F.round(F.min(val), digits).alias("Min"),
        F.min_by(t, F.struct(val, t)).alias("Time_min"),
        F.round(F.max(val), digits).alias("Max"),
        F.min_by(t, F.struct(-val, t)).alias("Time_max"),
    ]
    if extended:
        aggs += [F.round(F.avg(val), digits).alias("Mean"),
                 F.round(F.stddev_samp(val), digits).alias("Std")]
    out = base.groupBy(*keys).agg(*aggs)
    if extended:
        exact = quantiles(base, keys, value, EXT_PERCENTILES)
        out = join_keyed(out, exact.select(*[F.col(q(k)) for k in keys],
                                           *[F.round(q(n), digits).alias(n) for n in EXT_PERCENTILES]), keys)
    return out


def distinct_count(df: DataFrame, by, cols, name: str = "n") -> DataFrame:
    """Exact number of distinct ``cols`` tuples per ``by`` (NULL is a value)."""
    by = [by] if isinstance(by, str) else list(by)
    cols = [cols] if isinstance(cols, str) else list(cols)
    return df.select(*by, *cols).distinct().groupBy(*by).agg(F.count(F.lit(1)).alias(name))
