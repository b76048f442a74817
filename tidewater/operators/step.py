"""T2 ``ts_step`` and T3 ``is_ts_daily``: time-step detection per series.

Semantics (one series = one group of ``keys``):

* rows whose value columns are all missing (NULL or NaN) are ignored;
* fewer than two distinct times -> step NULL;
* ``m`` = smallest gap between consecutive distinct times;
* the series is regular with step ``m`` iff ``m >= min_step_s`` and every
  gap is a multiple of ``m`` (the smallest gap, not the gcd); otherwise -1.
  With ``ignore_subthreshold=True`` gaps under the threshold are skipped and
  ``m`` is the smallest gap at or above it (the R dialect).

Plan, built for a series that may hold a third of all readings: consecutive
gaps need an order, but ordering a whole series in one task does not scale.
The distinct times of each series (combined map-side, so a flood of equal
times is one row) are range-partitioned on (series, time); sampled
boundaries make every partition about the same size, wherever readings
crowd. A run of times of one series inside a partition is a chunk, and goes
on as one mergeable row: bounds, number of readings, smallest gap, greatest
common divisor of its gaps (which no built-in aggregate gives, hence Arrow and
numpy there), and its gaps above the smallest. Chunk edges are stitched on
that small table. All gaps are multiples of the smallest one of the series,
``m``, exactly if the divisors of all chunks and all edges are, so the readings
are read once.

Expressions are written as SQL text: one JVM call per expression keeps
plan construction cheap on the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timecols import (US_PER_DAY, US_PER_SECOND, discover_roles,
                                  present_sql, q, micros_sql)
from .joins import SmallTable, join_keyed, materialise

def _kq(keys) -> list[str]:
    return [q(k) for k in keys]


def series_extent(df: DataFrame, keys, ts: str, values) -> DataFrame:
    """Per series: number of present rows and first/last present time (micros).

    Series whose values are all missing stay, with n = 0 and NULL bounds.
    """
    keys = list(keys)
    p, t = present_sql(values), micros_sql(ts)
    aggs = [F.expr(f"count_if({p}) AS n"), F.expr(f"min(CASE WHEN {p} THEN {t} END) AS t0"),
            F.expr(f"max(CASE WHEN {p} THEN {t} END) AS t1")]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def _grouped(df: DataFrame, keys, *aggs: str) -> DataFrame:
    exprs = [F.expr(a) for a in aggs]
    return df.groupBy(*[F.col(q(k)) for k in keys]).agg(*exprs) if keys else df.agg(*exprs)


def _same_as_before(batch: pa.RecordBatch, columns: list[str]) -> np.ndarray:
    """Rows whose ``columns`` equal those of the row before (from the second row on)."""
    same = np.ones(max(batch.num_rows - 1, 0), bool)
    for c in columns:
        col = batch.column(batch.schema.get_field_index(c))
        a, b = col.slice(1), col.slice(0, max(batch.num_rows - 1, 0))
        try:
            equal = pc.fill_null(pc.equal(a, b), False).to_numpy(zero_copy_only=False)
        except pa.ArrowNotImplementedError:  # nested keys: every row is a chunk
            return np.zeros_like(same)
        same &= equal | (a.is_null().to_numpy(zero_copy_only=False) & b.is_null().to_numpy(zero_copy_only=False))
    return same


_CHUNK = "cmin long, cmax long, n long, gmin long, divisor long, holes array<struct<a: long, b: long>>"


def _chunk_rows(keys: list[str], least: int):
    """Rows in order of keys and time (``__t``, occurring ``__c`` times) to one row for each run of
    equal keys. Gaps under ``least`` do not count."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            first = np.flatnonzero(np.concatenate(([True], ~_same_as_before(batch, keys))))
            size = np.diff(np.concatenate((first, [batch.num_rows])))
            time = batch.column(batch.schema.get_field_index("__t"))
            there = ~time.is_null().to_numpy(zero_copy_only=False)
            t = pc.fill_null(time, 0).to_numpy(zero_copy_only=False)
            c = np.where(there, batch.column(batch.schema.get_field_index("__c")).to_numpy(zero_copy_only=False), 0)
            run_of = np.repeat(np.arange(len(first)), size)
            gap = np.zeros(batch.num_rows, np.int64)  # to the time before in the run
            gap[1:] = np.where((run_of[1:] == run_of[:-1]) & there[1:] & there[:-1], t[1:] - t[:-1], 0)
            gap[gap < max(least, 1)] = 0
            top = np.iinfo(np.int64).max
            gmin = np.minimum.reduceat(np.where(gap > 0, gap, top), first)
            divisor = np.gcd.reduceat(gap, first)
            last = first + size - 1
            # a missing time sorts first, and alone
            low = np.minimum(first + ~there[first], last)
            wide = np.flatnonzero(gap > gmin[run_of])
            holes = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(run_of[wide], np.arange(len(first) + 1)).astype(np.int32)),
                pa.StructArray.from_arrays([pa.array(t[np.maximum(wide - 1, 0)]), pa.array(t[wide])], ["a", "b"]))
            at, some, none = pa.array(first), there[last], gmin == top
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(batch.schema.get_field_index(k)).take(at) for k in keys],
                 pa.array(t[low], mask=~some), pa.array(t[last], mask=~some), pa.array(np.add.reduceat(c, first)),
                 pa.array(gmin, mask=none), pa.array(divisor, mask=none), holes],
                [*keys, "cmin", "cmax", "n", "gmin", "divisor", "holes"])

    return run


def chunk_table(df: DataFrame, keys, ts: str, values, least_gap: int = 0, parts: int | None = None) -> DataFrame:
    """One row per chunk (see above): keys, cmin, cmax, n, gmin, divisor, holes, and ``before``,
    the last time of the chunk before. A chunk without present readings has n = 0."""
    keys = list(keys)
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    times = _grouped(df.selectExpr(*_kq(keys), f"CASE WHEN {present_sql(values)} THEN {micros_sql(ts)} END AS __t"),
                     [*keys, "__t"], "count(1) AS __c")
    order = [*[F.col(q(k)) for k in keys], F.col("__t")]
    ranged = times.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # plain names on the way: a key may hold any character
    plain = [f"__k{i}" for i in range(len(keys))]
    schema = T.StructType([T.StructField(n, df.schema[k].dataType) for n, k in zip(plain, keys)]
                          + T._parse_datatype_string(_CHUNK).fields)
    rows = ranged.selectExpr(*[f"{q(k)} AS {n}" for n, k in zip(plain, keys)], "__t", "__c").mapInArrow(
        _chunk_rows(plain, least_gap), schema)
    rows = rows.selectExpr(*[f"{n} AS {q(k)}" for n, k in zip(plain, keys)], "cmin", "cmax", "n", "gmin", "divisor", "holes")
    over = f"(PARTITION BY {', '.join(_kq(keys))} ORDER BY cmin)" if keys else "(ORDER BY cmin)"
    return rows.selectExpr("*", f"lag(cmax) OVER {over} AS before")


class StepTable(SmallTable):
    """The step table of a frame's series, with the chunks that it comes from."""

    def __init__(self, df: DataFrame, rows: int, chunks: DataFrame):
        super().__init__(df, rows)
        self.chunks = chunks

    def release(self) -> None:
        super().release()
        self.chunks.unpersist()


def step_table(df: DataFrame, keys=(), ts: str | None = None, values=None,
               min_step_s: int = 60, ignore_subthreshold: bool = False,
               parts: int | None = None) -> StepTable:
    """Materialised per-series table: keys, n, t0, t1, m_us, step_us, step_s.

    ``parts`` is the number of range partitions (default: the session's
    shuffle partitions). The readings are read once.
    """
    keys = list(keys)
    ts, values = discover_roles(df, keys, ts, values)
    thr = int(min_step_s) * US_PER_SECOND
    chunks = chunk_table(df, keys, ts, values, thr if ignore_subthreshold else 0, parts).persist(StorageLevel.MEMORY_AND_DISK)
    edge = f"CASE WHEN cmin - before >= {thr if ignore_subthreshold else 1} THEN cmin - before END"
    over = f"(PARTITION BY {', '.join(_kq(keys))})" if keys else "()"
    rows = chunks.selectExpr(*_kq(keys), "cmin", "cmax", "n", "divisor", f"{edge} AS edge", f"least(gmin, {edge}) AS gap").selectExpr(
        "*", f"min(gap) OVER {over} AS m")
    series = _grouped(rows, keys, "coalesce(sum(n), 0) AS n", "min(cmin) AS t0", "max(cmax) AS t1", "min(m) AS m_us",
                      "coalesce(bool_and(coalesce(pmod(divisor, m) = 0, true) AND coalesce(pmod(edge, m) = 0, true)), true) AS __ok")
    # no usable gap: NULL for fewer than two times, else -1 (nothing at or
    # above the threshold to call a step)
    step = (f"CASE WHEN m_us IS NULL THEN CASE WHEN t1 > t0 THEN CAST(-1 AS BIGINT) END "
            f"WHEN m_us < {thr} OR NOT __ok THEN CAST(-1 AS BIGINT) ELSE m_us END")
    out = materialise(series.selectExpr(*_kq(keys), "n", "t0", "t1", "m_us", f"{step} AS step_us").selectExpr(
        "*", f"CASE WHEN step_us > 0 THEN step_us div {US_PER_SECOND} ELSE step_us END AS step_s"))
    return StepTable(out.df, out.rows, chunks)


def ts_step(df: DataFrame, keys=(), ts: str | None = None, values=None,
            min_step_s: int = 60, ignore_subthreshold: bool = False) -> DataFrame:
    """Per series ``step_s`` = seconds (regular), -1 (irregular) or NULL."""
    keys = list(keys)
    st = step_table(df, keys, ts, values, min_step_s, ignore_subthreshold)
    return st.df.select(*keys, "step_s")


def is_ts_daily(df: DataFrame, keys=(), ts: str | None = None, values=None) -> DataFrame:
    """A DATE series is daily; otherwise step 86400 s and all times at 00:00:00."""
    keys = list(keys)
    ts, values = discover_roles(df, keys, ts, values)
    if isinstance(df.schema[ts].dataType, T.DateType):
        base = df.select(*keys).distinct() if keys else df.sparkSession.range(1).select()
        return base.withColumn("is_daily", F.lit(True))
    st = step_table(df, keys, ts, values)
    mid = F.expr(f"bool_and(pmod({micros_sql(ts)}, {US_PER_DAY}) = 0) AS __mid")
    at_midnight = df.groupBy(*keys).agg(mid) if keys else df.agg(mid)
    out = join_keyed(st.df.select(*keys, "step_s"), SmallTable(at_midnight, st.rows), keys, "left")
    return out.selectExpr(*_kq(keys), "coalesce(step_s = 86400, false) AND coalesce(__mid, false) AS is_daily")
