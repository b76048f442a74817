"""T1 ``ts_validate``: report what makes a frame an invalid series.

Schema checks run once on the driver (they only read ``df.schema``); data
checks are distributed aggregates. Output: one row per violation,
``keys + [check, n]`` (schema checks have NULL keys).

* ``duplicate_times``: number of times that occur more than once;
* ``out_of_order``: rows whose time is earlier than the previous row's, in
  the order of an explicit arrival column ``seq`` (a DataFrame has no
  intrinsic order). Ranges of ``seq`` (width adapted to each series) are
  compared inside ``(series, chunk)`` windows and chunk edges are stitched,
  so a hot series is never sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timecols import is_numeric, is_temporal, q

SEQ_PER_CHUNK = 50_000


def schema_violations(df: DataFrame, keys=(), ts: str | None = None) -> list[str]:
    keys = set(keys)
    fields = [f for f in df.schema.fields if f.name not in keys]
    temporal = [f.name for f in fields if is_temporal(f.dataType)]
    out = []
    if ts is None and len(temporal) == 0:
        out.append("no_temporal_column")
    if ts is None and len(temporal) > 1:
        out.append("many_temporal_columns")
    rest = [f for f in fields if f.name not in temporal and f.name != ts]
    if not rest:
        out.append("no_value_column")
    if any(not is_numeric(f.dataType) for f in rest):
        out.append("non_numeric_column")
    return out


def ts_validate(df: DataFrame, keys=(), ts: str | None = None, seq: str | None = None,
                seq_per_chunk: int = SEQ_PER_CHUNK) -> DataFrame:
    keys = list(keys)
    spark = df.sparkSession
    schema = T.StructType([*[df.schema[k] for k in keys],
                           T.StructField("check", T.StringType()),
                           T.StructField("n", T.LongType())])
    problems = schema_violations(df.drop(seq) if seq else df, keys, ts)
    out = spark.createDataFrame([tuple([None] * len(keys) + [p, None]) for p in problems], schema)
    if ts is None:
        temporal = [f.name for f in df.schema.fields if f.name not in keys and is_temporal(f.dataType)]
        if len(temporal) != 1:
            return out
        ts = temporal[0]
    dups = (df.groupBy(*keys, ts).count().filter(F.col("count") > 1)
              .groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
              .select(*keys, F.lit("duplicate_times").alias("check"), "n"))
    out = out.unionByName(dups)
    if seq is not None:
        # chunk width adapts to each series' density of arrival numbers,
        # so both the rows per chunk and the chunks per series stay bounded
        from .joins import join_keyed, materialise
        ext = materialise(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"),
                                                F.min(seq).alias("__s0"), F.max(seq).alias("__s1"))
                          if keys else df.agg(F.count(F.lit(1)).alias("__n"),
                                              F.min(seq).alias("__s0"), F.max(seq).alias("__s1")))
        width = (f"greatest(1, ceil((__s1 - __s0 + 1) / greatest(1, floor(__n / "
                 f"greatest({int(seq_per_chunk)}, sqrt(__n))))))")
        base = join_keyed(df.select(*keys, F.col(seq), F.col(ts)), ext, keys).select(
            *keys, F.col(seq), F.col(ts), F.expr(f"({q(seq)} - __s0) div {width}").alias("__c"))
        w = Window.partitionBy(*keys, "__c").orderBy(seq)
        inner = (base.withColumn("__prev", F.lag(ts).over(w))
                     .groupBy(*keys, "__c")
                     .agg(F.count_if(F.col(ts) < F.col("__prev")).alias("__bad"),
                          F.min_by(ts, F.col(seq)).alias("__first"),
                          F.max_by(ts, F.col(seq)).alias("__last")))
        wc = Window.partitionBy(*keys).orderBy("__c") if keys else Window.orderBy("__c")
        edge = (F.col("__first") < F.lag("__last").over(wc)).cast("long")
        order = (inner.withColumn("__edge", F.coalesce(edge, F.lit(0)))
                      .groupBy(*keys).agg((F.sum("__bad") + F.sum("__edge")).alias("n"))
                      .filter(F.col("n") > 0)
                      .select(*keys, F.lit("out_of_order").alias("check"), "n"))
        out = out.unionByName(order)
    return out
