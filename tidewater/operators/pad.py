"""T4 ``na_ts_insert``: pad the gaps of regular series with NULL rows.

Per series: all-missing rows are dropped; an irregular series (step -1) or
one with fewer than two times is returned as is; a regular one gets every
grid time ``t0 + k * step`` up to its last present time, with NULL values
where nothing was read. Leading and trailing empty rows therefore vanish.

Plan: the readings are not moved. The step table's chunks hold the gaps above
the smallest of each chunk, and the chunk edges; where the smallest is the step
of the series, these are all its holes. Holes go through ``explode`` in two
levels (pieces of a hole, a small repartition, points of a piece), so that a
long one is spread over tasks, and the missing points are added to the readings.
Series that have a chunk without two neighbouring points (one part read hourly,
another daily) are padded by joining them with their whole grid, and so is
everything at a step that is given: a full outer join on ``(keys, time)``, which
spreads even a hot series over all tasks.

The input is read twice (step table, output); an input that is an aggregate of
something much larger (as in ``hourly_2_daily``) is best materialised first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timecols import (discover_roles, from_micros_sql, nan_to_null_sql,
                                  present_sql, q)
from ..functions.timecols import US_PER_SECOND
from .joins import SmallTable, join_keyed, materialise
from .step import StepTable, series_extent, step_table

POINTS_PER_PIECE = 100_000


def grid_times(steps: SmallTable, keys, ts: str, is_date: bool,
               points_per_piece: int = POINTS_PER_PIECE) -> DataFrame:
    """(keys, ts) of the full regular grid of every regular series."""
    keys = list(keys)
    K = [q(k) for k in keys]
    p = int(points_per_piece)
    pieces = steps.df.filter("step_us > 0").selectExpr(
        *K, "t0", "step_us", "(t1 - t0) div step_us + 1 AS __npts").selectExpr(
        *K, "t0", "step_us", "__npts", f"explode(sequence(0L, (__npts - 1) div {p})) AS __piece")
    # spread grid generation: one long series is cut into many pieces
    pieces = pieces.repartition(*keys, "__piece") if keys else pieces.repartition("__piece")
    t = from_micros_sql("t0 + __k * step_us")
    t = f"CAST({t} AS DATE)" if is_date else t
    return pieces.selectExpr(
        *K, "t0", "step_us",
        f"explode(sequence(__piece * {p}, least(__npts - 1, __piece * {p} + {p - 1}))) AS __k"
    ).selectExpr(*K, f"{t} AS {q(ts)}")


def fixed_steps(df: DataFrame, keys, ts: str, values, step_s: int) -> SmallTable:
    """Step table for a known step: every series with two or more present
    times is padded on ``t0 + k * step`` (no detection pass)."""
    ext = materialise(series_extent(df, keys, ts, values))
    us = int(step_s) * US_PER_SECOND
    t = ext.df.selectExpr(*[q(k) for k in keys], "n", "t0", "t1",
                          f"CASE WHEN t1 > t0 THEN CAST({us} AS BIGINT) END AS step_us")
    return SmallTable(t, ext.rows)


def na_ts_insert(df: DataFrame, keys=(), ts: str | None = None, values=None,
                 min_step_s: int = 60, steps: SmallTable | None = None,
                 points_per_piece: int = POINTS_PER_PIECE, step_s: int | None = None) -> DataFrame:
    """Padded series: columns ``keys + [ts] + values``.

    ``step_s`` pads at a known step instead of the detected one (e.g.
    ``86400`` reproduces the R dialect, where a DATE series is always
    padded daily); present times off that grid are kept as they are.
    """
    keys = list(keys)
    ts, values = discover_roles(df, keys, ts, values)
    is_date = isinstance(df.schema[ts].dataType, T.DateType)
    if steps is None and step_s is not None:
        steps = fixed_steps(df, keys, ts, values, step_s)
    st = steps or step_table(df, keys, ts, values, min_step_s)
    present = df.filter(present_sql(values))
    if not isinstance(st, StepTable) or steps is not None:
        return _on_grid(present, st, keys, ts, values, is_date, points_per_piece)
    K = [q(k) for k in keys]
    known = SmallTable(st.df.select(*[F.col(k) for k in K], "step_us"), st.rows)
    chunks = join_keyed(st.chunks, known, keys).filter("step_us > 0")
    holes = chunks.selectExpr(*K, "step_us", "inline(concat(holes, IF(cmin - before > step_us, "
                              "array(named_struct('a', before, 'b', cmin)), array())))")
    shown = present.selectExpr(*K, q(ts), *[f"{nan_to_null_sql(v)} AS {q(v)}" for v in values])
    facts = chunks.selectExpr("gmin <> step_us AS coarse", "aggregate(holes, 0L, (s, h) -> s + (h.b - h.a) div step_us - 1) "
                              "+ coalesce((cmin - before) div step_us - 1, 0) AS points").agg(
        F.expr("coalesce(bool_or(coarse), false)"), F.expr("coalesce(sum(points), 0)")).first()
    # pieces are small rows for many points, so their number of partitions goes by the points
    parts = 1 + facts[1] // (10 * int(points_per_piece))
    if not facts[0]:
        return shown.unionByName(_missing(holes, keys, ts, values, df.schema, is_date, points_per_piece, parts)) if facts[1] else shown
    coarse = materialise(chunks.filter("gmin <> step_us").select(*[F.col(k) for k in K], F.lit(True).alias("__coarse")).distinct())

    def split(frame, wanted: bool):
        marked = join_keyed(frame, coarse, keys, "left")
        return marked.filter("__coarse" if wanted else "__coarse IS NULL").drop("__coarse")

    fine = split(shown, False).unionByName(_missing(split(holes, False), keys, ts, values, df.schema, is_date, points_per_piece, parts))
    return fine.unionByName(_on_grid(split(present, True), SmallTable(split(st.df, True), coarse.rows), keys, ts, values, is_date,
                                     points_per_piece))


def _missing(holes: DataFrame, keys, ts: str, values, schema, is_date: bool, points_per_piece: int,
             parts: int) -> DataFrame:
    """The points between the readings ``a`` and ``b`` at ``step_us``, without values."""
    K, p = [q(k) for k in keys], int(points_per_piece)
    pieces = holes.selectExpr(*K, "step_us", "a", "(b - a) div step_us - 1 AS __n").selectExpr(
        *K, "step_us", "a", "__n", f"explode(sequence(0L, (__n - 1) div {p})) AS __piece")
    pieces = pieces.repartition(parts, *[F.col(k) for k in K], "a", "__piece")
    t = from_micros_sql("a + (__k + 1) * step_us")
    t = f"CAST({t} AS DATE)" if is_date else f"CAST({t} AS {schema[ts].dataType.simpleString()})"
    points = pieces.selectExpr(*K, "a", "step_us", f"explode(sequence(__piece * {p}, least(__n - 1, __piece * {p} + {p - 1}))) AS __k")
    return points.selectExpr(*K, f"{t} AS {q(ts)}", *[f"CAST(NULL AS {schema[v].dataType.simpleString()}) AS {q(v)}" for v in values])


def _on_grid(present: DataFrame, st: SmallTable, keys, ts: str, values, is_date: bool, points_per_piece: int) -> DataFrame:
    """The present readings and the whole grid of their series, joined on the time."""
    cols = keys + [ts]
    g = grid_times(st, keys, ts, is_date, points_per_piece).selectExpr(
        *[f"{q(c)} AS __g{i}" for i, c in enumerate(cols)])
    p = present.selectExpr(
        *[f"{q(c)} AS __p{i}" for i, c in enumerate(cols)],
        *[f"{nan_to_null_sql(v)} AS __v{j}" for j, v in enumerate(values)])
    n = len(cols)
    cond = " AND ".join([f"__g{n - 1} = __p{n - 1}"] + [f"__g{i} <=> __p{i}" for i in range(n - 1)])
    j = g.join(p, F.expr(cond), "full")
    return j.selectExpr(*[f"coalesce(__g{i}, __p{i}) AS {q(c)}" for i, c in enumerate(cols)],
                        *[f"__v{j} AS {q(v)}" for j, v in enumerate(values)])
