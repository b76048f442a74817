"""T5 ``wide_eligibility``: may a folder of series become one wide table?

Checks in order; the first failure is the reason:

1. ``duplicate_site``: fewer distinct plates than files (``duplicate_files``
   lists those whose plate occurs in more than one file);
2. ``mixed_unit_or_parameter``: more than one distinct (Unit, Parameter),
   NULL counting as a value;
3. ``insufficient_data`` (a single distinct time) or ``irregular_or_coarse``
   (step of the folder's distinct times is -1 or above one day; rows with
   missing values count, as the times form the table);
4. ``name_collision``: the wide columns are named by site name, so two
   plates sharing a name (or several unnamed plates) would merge.

Everything is a ``groupBy`` aggregate or the step table: one row per
folder comes out; neither a folder's readings nor its files are gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import micros_sql, q
from .joins import SmallTable, join_keyed, materialise
from .step import step_table


def duplicate_files(long: DataFrame, folder: str = "folder", file: str = "CSV", plate: str = "Plate") -> DataFrame:
    """Rows ``folder, plate, file`` of the plates that occur in more than one file of their folder."""
    pf = long.select(folder, plate, file).distinct()
    many = pf.groupBy(folder, plate).agg(F.count(file).alias("__nf")).filter("__nf > 1").drop("__nf")
    cond = f"__f <=> {q(folder)} AND __p <=> {q(plate)}"
    many = many.selectExpr(f"{q(folder)} AS __f", f"{q(plate)} AS __p")
    return pf.join(many, F.expr(cond), "left_semi")


def wide_eligibility(long: DataFrame, files: DataFrame | None = None, folder: str = "folder",
                     file: str = "CSV", plate: str = "Plate", name: str = "Name",
                     unit: str = "Unit", parameter: str = "Parameter",
                     ts: str = "TimeStamp") -> DataFrame:
    """Columns: folder, eligible, reason, n_dup_files, step_s, is_daily.

    The long table is read once for the per-file attributes (a small table:
    one row per file and attribute combination, materialised) and once by
    the step detection; every check is derived from those small tables.
    """
    midnight = f"bool_and(pmod({micros_sql(ts)}, 86400000000) = 0)"
    attrs = materialise(long.groupBy(folder, file, plate, unit, parameter,
                                     F.coalesce(F.col(name), F.col(plate)).alias("__nm"))
                            .agg(F.expr(f"{midnight} AS __mid")))
    a = attrs.df
    if files is None:
        files = a.select(folder, file)
    n_files = files.select(folder, file).distinct().groupBy(folder).agg(
        F.count(F.lit(1)).alias("__files"))
    pf = a.select(folder, plate, file).distinct()
    plates = pf.select(folder, plate).distinct().groupBy(folder).agg(F.count(F.lit(1)).alias("__plates"))
    multi = (pf.groupBy(folder, plate).agg(F.count(file).alias("__nf")).filter("__nf > 1")
               .groupBy(folder).agg(F.sum("__nf").alias("n_dup_files")))
    up = a.select(folder, unit, parameter).distinct().groupBy(folder).agg(F.count(F.lit(1)).alias("__up"))
    nm = (a.select(folder, plate, "__nm").distinct().groupBy(folder)
           .agg(F.countDistinct("__nm").alias("__names"), F.count(F.lit(1)).alias("__pl2")))
    mid = a.groupBy(folder).agg(F.bool_and("__mid").alias("__mid"))
    times = long.selectExpr(q(folder), f"CAST({q(ts)} AS TIMESTAMP_NTZ) AS {q(ts)}", "0.0 AS __vv")
    st = step_table(times, [folder], ts, ["__vv"])

    g = n_files
    for part in (plates, multi, up, nm, mid):
        g = g.join(part, folder, "left")
    g = join_keyed(g, SmallTable(st.df.select(folder, "step_s"), st.rows), [folder], "left")
    reason = ("CASE WHEN coalesce(__plates, 0) < __files THEN 'duplicate_site' "
              "WHEN __up > 1 THEN 'mixed_unit_or_parameter' "
              "WHEN step_s IS NULL THEN 'insufficient_data' "
              "WHEN step_s = -1 OR step_s > 86400 THEN 'irregular_or_coarse' "
              "WHEN __names < __pl2 THEN 'name_collision' END")
    out = g.selectExpr(q(folder), f"{reason} AS reason",
                       "coalesce(n_dup_files, 0L) AS n_dup_files", "step_s",
                       "coalesce(step_s = 86400 AND __mid, false) AS is_daily")
    return out.selectExpr(q(folder), "reason IS NULL AS eligible", "reason", "n_dup_files", "step_s", "is_daily")
