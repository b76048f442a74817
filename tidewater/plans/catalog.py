"""Registered queries: each reads the driver tables and returns a DataFrame.

Every entry has a Spark builder ``(spark, sf_dir) -> DataFrame`` and, where
the result is expressible in SQL, an independent DuckDB statement over the
same tables. Results are presented with doubles rounded to 6 digits and
dates as ``yyyy-MM-dd`` text on both sides, so engine-specific float
summation order and date typing do not affect the comparison.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.daily import hourly_2_daily
from ..operators.info import ts_info
from ..operators.pad import na_ts_insert
from ..operators.resample import raw_series, resample
from ..operators.reshape import to_wide, ts_2_list, ts_melt, unpivot_long
from ..operators.clean import drop_any_null, trim_ts, value_present
from ..operators.gate import duplicate_files, wide_eligibility
from ..operators.joins import keep_all_sites, select_listed
from ..operators.reshape import concat_frames
from ..operators.step import is_ts_daily, ts_step
from ..operators.summary import data_range_summary
from .oracle_sql import hourly_events_cte, nn, pad_ctes, step_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: present(fn(spark, sf_dir.rstrip("/")))
        QUERIES[name].__name__ = name
        QUERIES[name].__doc__ = fn.__doc__
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def present(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            # nudge by 1e-9 so a value whose exact decimal form ends in 5 at
            # the 7th digit rounds the same whatever the summation order
            c = F.round(c + F.lit(1e-9), 6)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_type", "ts", "value")


def hourly_events(spark, sf_dir) -> DataFrame:
    return resample(events(spark, sf_dir), ["event_type"], "ts", "value", "hour", "mean")


def hourly_wide(spark, sf_dir) -> DataFrame:
    return to_wide(hourly_events(spark, sf_dir), "ts", "event_type", "value")


H = hourly_events_cte("h")


def r6(c: str, alias: str | None = None) -> str:
    return f"round({c} + 1e-9, 6) as \"{alias or c}\""


# ---------------------------------------------------------------- A2-A8

def _resample_sql(tbl, key, ts, val, unit, fn):
    return (f"select {key}, date_trunc('{unit}', {ts}) as {ts}, round({fn}({nn(val)}) + 1e-9, 6) as {val} "
            f"from {tbl} group by all")


@register("resample_hour_mean", _resample_sql("events", "event_type", "ts", "value", "hour", "avg"))
def q_resample_hour_mean(spark, sf):
    """A2: hourly mean per event type."""
    return resample(events(spark, sf), ["event_type"], "ts", "value", "hour", "mean")


@register("resample_hour_sum", _resample_sql("events", "event_type", "ts", "value", "hour", "sum"))
def q_resample_hour_sum(spark, sf):
    """A3: hourly sum per event type."""
    return resample(events(spark, sf), ["event_type"], "ts", "value", "hour", "sum")


@register("resample_day_mean", _resample_sql("events", "event_type", "ts", "value", "day", "avg"))
def q_resample_day_mean(spark, sf):
    """A4: daily mean per event type."""
    return resample(events(spark, sf), ["event_type"], "ts", "value", "day", "mean")


@register("resample_day_sum", _resample_sql("events", "event_type", "ts", "value", "day", "sum"))
def q_resample_day_sum(spark, sf):
    """A5: daily sum per event type."""
    return resample(events(spark, sf), ["event_type"], "ts", "value", "day", "sum")


@register("resample_month_mean",
          _resample_sql("lineitem", "l_returnflag", "l_shipdate", "l_quantity", "month", "avg"))
def q_resample_month_mean(spark, sf):
    """Monthly mean quantity per return flag."""
    li = table(spark, sf, "lineitem")
    return resample(li, ["l_returnflag"], "l_shipdate", "l_quantity", "month", "mean")


@register("resample_month_sum",
          _resample_sql("orders", "o_orderpriority", "o_orderdate", "o_totalprice", "month", "sum"))
def q_resample_month_sum(spark, sf):
    """Monthly total price per order priority."""
    o = table(spark, sf, "orders")
    return resample(o, ["o_orderpriority"], "o_orderdate", "o_totalprice", "month", "sum")


@register("resample_none", f"select event_type, ts, round({nn('value')} + 1e-9, 6) as value from events")
def q_resample_none(spark, sf):
    """Empty process chain = the readings."""
    return raw_series(events(spark, sf), ["event_type"], "ts", "value")


# ---------------------------------------------------------------- T2 / T3

def _step_sql(src_cte, src, key, t, present):
    return (f"with {src_cte}, {step_ctes('st', src, [key], t, present)} "
            f"select {key}, case when step_us > 0 then step_us // 1000000 else step_us end as step_s from st")


@register("ts_step_regular", _step_sql(H, "h", "event_type", "ts", "value is not null"))
def q_ts_step_regular(spark, sf):
    """T2 on the hourly grid of events: 3600 s per type."""
    return ts_step(hourly_events(spark, sf), ["event_type"], "ts", ["value"])


@register("ts_step_irregular",
          _step_sql(f"e as (select event_type, ts, {nn('value')} as value from events)", "e",
                    "event_type", "ts", "value is not null"))
def q_ts_step_irregular(spark, sf):
    """T2 on raw events: irregular (-1)."""
    return ts_step(events(spark, sf), ["event_type"], "ts", ["value"])


def _daily_mix(spark, sf):
    li = table(spark, sf, "lineitem").select(
        F.concat(F.lit("lineitem:"), "l_returnflag").alias("series"),
        F.col("l_shipdate").alias("ts"), F.col("l_quantity").alias("value"))
    h = hourly_events(spark, sf).select(
        F.concat(F.lit("events:"), "event_type").alias("series"), "ts", "value")
    return li.unionByName(h)


_MIX = ("mix as (select 'lineitem:' || l_returnflag as series, l_shipdate as ts, l_quantity as value "
        f"from lineitem union all select 'events:' || event_type, ts, value from h)")


@register("is_ts_daily",
          f"with {H}, {_MIX}, {step_ctes('st', 'mix', ['series'], 'ts', 'value is not null')}, "
          "mid as (select series, bool_and(epoch_us(ts) % 86400000000 = 0) as m from mix group by 1) "
          "select series, coalesce(step_us = 86400000000, false) and m as is_daily "
          "from st join mid using (series)")
def q_is_ts_daily(spark, sf):
    """Lineitem ship dates per flag are daily; hourly events are not."""
    return is_ts_daily(_daily_mix(spark, sf), ["series"], "ts", ["value"])


# ---------------------------------------------------------------- T4

@register("na_ts_insert_hourly",
          f"with {H}, {step_ctes('st', 'h', ['event_type'], 'ts', 'value is not null')}, "
          f"{pad_ctes('p', 'h', 'st', ['event_type'], 'ts', ['value'], 'value is not null')} "
          "select event_type, ts, round(value + 1e-9, 6) as value from p")
def q_na_ts_insert_hourly(spark, sf):
    """T4: hourly events padded to the full hourly grid per type."""
    return na_ts_insert(hourly_events(spark, sf), ["event_type"], "ts", ["value"])


_ORD = ("o as (select o_orderpriority, cast(o_orderdate as date) as o_orderdate, "
        f"sum({nn('o_totalprice')}) as o_totalprice from orders group by all)")


@register("na_ts_insert_daily",
          f"with {_ORD}, {step_ctes('st', 'o', ['o_orderpriority'], 'o_orderdate', 'o_totalprice is not null', True)}, "
          f"{pad_ctes('p', 'o', 'st', ['o_orderpriority'], 'o_orderdate', ['o_totalprice'], 'o_totalprice is not null', True)} "
          "select o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') as o_orderdate, "
          "round(o_totalprice + 1e-9, 6) as o_totalprice from p")
def q_na_ts_insert_daily(spark, sf):
    """T4 on a DATE series: daily order totals per priority, gaps padded."""
    o = resample(table(spark, sf, "orders"), ["o_orderpriority"], "o_orderdate", "o_totalprice",
                 "day", "sum")
    o = o.withColumn("o_orderdate", F.to_date("o_orderdate"))
    return na_ts_insert(o, ["o_orderpriority"], "o_orderdate", ["o_totalprice"])


# ---------------------------------------------------------------- A9 / X1

def _h2d_sql(dsa, fn, name, prop):
    d0 = (f"d0 as (select event_type, cast(ts - interval {1 + dsa} hour as date) as \"Date\", "
          f"{fn}(value) as \"Agg_{name}\" from h where value is not null group by all "
          f"having count(value) / 24.0 >= {prop})")
    return (f"with {H}, {d0}, {step_ctes('st', 'd0', ['event_type'], '\"Date\"', f'\"Agg_{name}\" is not null', True)}, "
            f"{pad_ctes('p', 'd0', 'st', ['event_type'], '\"Date\"', [f'\"Agg_{name}\"'], f'\"Agg_{name}\" is not null', True)} "
            f"select event_type, strftime(\"Date\", '%Y-%m-%d') as \"Date\", "
            f"round(\"Agg_{name}\" + 1e-9, 6) as \"Agg_{name}\" from p")


def _h2d(dsa, agg, prop):
    def build(spark, sf):
        return hourly_2_daily(hourly_events(spark, sf), ["event_type"], "ts", "value",
                              day_starts_at=dsa, agg=agg, prop=prop)
    return build


register("hourly_2_daily_full", _h2d_sql(0, "avg", "mean", 1.0))(_h2d(0, "mean", 1.0))
register("hourly_2_daily_p90", _h2d_sql(0, "avg", "mean", 0.9))(_h2d(0, "mean", 0.9))
register("hourly_2_daily_9am", _h2d_sql(9, "avg", "mean", 0.9))(_h2d(9, "mean", 0.9))
register("hourly_2_daily_sum", _h2d_sql(0, "sum", "sum", 0.5))(_h2d(0, "sum", 0.5))
register("hourly_2_daily_median", _h2d_sql(0, "median", "median", 0.75))(_h2d(0, "median", 0.75))


# ---------------------------------------------------------------- A10

def _info_sql(src_cte, src, completion: bool):
    head = (f"with {src_cte}, {step_ctes('st', f'(select 1 as f, * from {src})', ['f'], 'ts', 'value is not null')}, "
            f"s as (select event_type, min(ts) filter (where value is not null) as \"Start\", "
            f"max(ts) filter (where value is not null) as \"End\", count(value) as n from {src} group by 1), "
            "x as (select s.*, (epoch_us(\"End\") - epoch_us(\"Start\")) / 86400e6 as days, "
            "case when st.step_us > 0 then st.step_us / 86400e6 end as sd from s, st) ")
    sel = ("select event_type, \"Start\", \"End\", "
           "round(days / 365.2422 + coalesce(sd, 0) / 365.2422 + 1e-9, 6) as \"Length_yr\"")
    if completion:
        sel += ", round(n * sd / (days + sd) * 100 + 1e-9, 6) as \"Completion_%\""
    return head + sel + " from x"


@register("ts_info_regular", _info_sql(H, "h", True))
def q_ts_info_regular(spark, sf):
    """A10 on hourly events (frame step 3600 s)."""
    return ts_info(hourly_events(spark, sf), "event_type", "ts", "value")


@register("ts_info_irregular",
          _info_sql(f"e as (select event_type, ts, {nn('value')} as value from events)", "e", False))
def q_ts_info_irregular(spark, sf):
    """A10 on raw events: irregular, so no completion column."""
    return ts_info(events(spark, sf), "event_type", "ts", "value")


# ---------------------------------------------------------------- A1

@register("data_range_summary",
          f"with e as (select event_type, ts, {nn('value')} as v from events) "
          "select event_type, min(ts) as \"Start\", max(ts) as \"End\", round(min(v), 3) as \"Min\", "
          "arg_min(ts, (v, ts)) as \"Time_min\", round(max(v), 3) as \"Max\", "
          "arg_min(ts, (-v, ts)) as \"Time_max\" from e where v is not null group by 1")
def q_data_range_summary(spark, sf):
    """A1 per event type: range, extremes and their (earliest) times."""
    return data_range_summary(events(spark, sf), ["event_type"], "ts", "value", attrs=())


def _lineitem_long(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(
        F.col("l_returnflag").alias("folder"), F.concat(F.lit("Line "), "l_linestatus").alias("Name"),
        F.md5(F.concat("l_returnflag", "l_linestatus")).alias("uid"),
        F.col("l_linestatus").alias("Plate"), F.lit("pcs").alias("Unit"),
        F.col("l_shipdate").alias("TimeStamp"), F.col("l_quantity").alias("Value"))


@register("data_range_summary_sql",
          f"with l as (select l_returnflag as folder, 'Line ' || l_linestatus as \"Name\", "
          f"md5(l_returnflag || l_linestatus) as uid, l_linestatus as \"Plate\", 'pcs' as \"Unit\", "
          f"l_shipdate as \"TimeStamp\", {nn('l_quantity')} as v from lineitem) "
          "select folder, \"Name\", uid, min(\"Plate\") as \"Plate\", min(\"Unit\") as \"Unit\", "
          "min(\"TimeStamp\") as \"Start\", max(\"TimeStamp\") as \"End\", round(min(v), 3) as \"Min\", "
          "arg_min(\"TimeStamp\", (v, \"TimeStamp\")) as \"Time_min\", round(max(v), 3) as \"Max\", "
          "arg_min(\"TimeStamp\", (-v, \"TimeStamp\")) as \"Time_max\" from l where v is not null "
          "group by folder, \"Name\", uid")
def q_data_range_summary_sql(spark, sf):
    """A1, SQL dialect keys (folder, Name, uid); many ties on integer quantities."""
    return data_range_summary(_lineitem_long(spark, sf), ["folder", "Name", "uid"],
                              attrs=("Plate", "Unit"))


@register("data_range_summary_ext",
          f"with e as (select event_type, ts, {nn('value')} as v from events) "
          "select event_type, min(ts) as \"Start\", max(ts) as \"End\", round(min(v), 3) as \"Min\", "
          "arg_min(ts, (v, ts)) as \"Time_min\", round(max(v), 3) as \"Max\", arg_min(ts, (-v, ts)) as \"Time_max\", "
          "round(avg(v), 3) as \"Mean\", round(stddev_samp(v), 3) as \"Std\", round(quantile_cont(v, 0.25), 3) as \"25%\", "
          "round(quantile_cont(v, 0.5), 3) as \"Median\", round(quantile_cont(v, 0.75), 3) as \"75%\" "
          "from e where v is not null group by 1")
def q_data_range_summary_ext(spark, sf):
    """Adds mean, sample std and exact interpolated quartiles."""
    return data_range_summary(events(spark, sf), ["event_type"], "ts", "value", attrs=(),
                              extended=True)


# ---------------------------------------------------------------- R1-R5, F1-F3

# the five event types of the driver's events table (oracle side only)
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
_PIV = ("w as (select ts, " + ", ".join(f"max(value) filter (where event_type = '{t}') as {t}"
                                         for t in EVENT_TYPES) + " from h group by ts)")
_UNPIV = ("l as (" + " union all ".join(f"select ts, '{t}' as \"Site\", {t} as \"Value\" from w "
                                         f"where {t} is not null" for t in EVENT_TYPES) + ")")
_ANY = "coalesce(" + ", ".join(EVENT_TYPES) + ")"
_WCOLS = ", ".join(r6(t) for t in EVENT_TYPES)


@register("to_wide", f"with {H}, {_PIV} select ts, {_WCOLS} from w")
def q_to_wide(spark, sf):
    """Hourly events, one column per type."""
    return hourly_wide(spark, sf)


_WPAD = (f"with {H}, {_PIV}, wf as (select 1 as f, * from w), "
         f"{step_ctes('st', 'wf', ['f'], 'ts', _ANY + ' is not null')}, "
         f"{pad_ctes('p', 'wf', 'st', ['f'], 'ts', list(EVENT_TYPES), _ANY + ' is not null')} ")
_WSEL = f"select ts, {_WCOLS} from p"


def _wide_padded(spark, sf):
    w = hourly_wide(spark, sf)
    return na_ts_insert(w, [], "ts")


@register("wide_padded", _WPAD + _WSEL)
def q_wide_padded(spark, sf):
    """T4 on a wide frame: one step and one grid for all columns."""
    return _wide_padded(spark, sf)


@register("unpivot_long",
          f"with {H}, {_PIV}, {_UNPIV} select ts, \"Site\", {r6('Value')} from l")
def q_unpivot_long(spark, sf):
    """Wide back to long, missing cells dropped."""
    return unpivot_long(hourly_wide(spark, sf), "ts", "Site", "Value")


_MELT = (f"with {H}, {_PIV}, {_UNPIV}, "
         f"{step_ctes('st', 'l', ['Site'], 'ts', 'Value is not null')}, "
         f"{pad_ctes('p', 'l', 'st', ['Site'], 'ts', ['Value'], 'Value is not null')} ")


@register("ts_melt", _MELT + "select \"Site\", ts, round(\"Value\" + 1e-9, 6) as \"Value\" from p")
def q_ts_melt(spark, sf):
    """Long form, every site padded at its own step."""
    return ts_melt(hourly_wide(spark, sf), "ts", "Site", "Value")


@register("ts_2_list", _MELT + "select \"Site\", ts, round(\"Value\" + 1e-9, 6) as \"Value\" from p")
def q_ts_2_list(spark, sf):
    """One padded series per site, keyed by Site."""
    return ts_2_list(hourly_wide(spark, sf), "ts", "Site", "Value")


@register("value_present", _MELT + "select \"Site\", ts, round(\"Value\" + 1e-9, 6) as \"Value\" from p "
          "where \"Value\" is not null")
def q_value_present(spark, sf):
    """padded long series without the padding rows."""
    return value_present(ts_melt(hourly_wide(spark, sf), "ts", "Site", "Value"), "Value")


@register("drop_any_null", f"with {H}, {_PIV} select ts, {_WCOLS} from w "
          "where click is not null and error is not null and purchase is not null "
          "and signup is not null and view is not null")
def q_drop_any_null(spark, sf):
    """hours in which every event type has a value."""
    return drop_any_null(hourly_wide(spark, sf))


@register("trim_ts", _WPAD + _WSEL + " where " + _ANY + " is not null")
def q_trim_ts(spark, sf):
    """padded wide frame without its all-empty rows."""
    return trim_ts(_wide_padded(spark, sf), [], "ts")


# ---------------------------------------------------------------- S1-S3, S8, T5, T6, T7

from .fixtures import DEMO_SQL, PLATES, params_dim, plates_dim, render_demo  # noqa: E402
from .organise import long_table, organise_folder  # noqa: E402
from ..sources.report_csv import report_csv_scan, report_files, report_order, report_rejects  # noqa: E402

_DEMO = "with " + DEMO_SQL


def _organised(spark, sf):
    root = render_demo(spark, sf)
    return organise_folder(spark, root, params_dim(spark), plates_dim(spark), recursive=True,
                           glob="*.txt")


@register("report_csv_roundtrip",
          _DEMO + "select d.folder, d.uid, d.\"Parameter\", d.\"Label\", d.\"Plate\", pl.\"Name\", "
          "pa.\"Unit\", d.\"Description\", d.\"TimeStamp\", " + r6('d."Value"', "Value") +
          " from demo d left join plates pl using (\"Plate\") left join params pa using (\"Parameter\")")
def q_report_csv_roundtrip(spark, sf):
    """Events rendered as report files, read back into the long table."""
    root = render_demo(spark, sf)
    long = report_csv_scan(spark, root, params_dim(spark), plates_dim(spark), recursive=True, glob="*.txt")
    return long.select("folder", "uid", "Parameter", "Label", "Plate", "Name", "Unit",
                       "Description", "TimeStamp", "Value")


@register("report_header_parse",
          _DEMO + "select distinct folder, uid, \"Parameter\", \"Plate\", \"Label\", "
          "\"Parameter\" || '.' || \"Label\" || '@' || \"Plate\" as ts_id, \"Description\" from demo")
def q_report_header_parse(spark, sf):
    """S3: one row per report file from its description and header lines."""
    root = render_demo(spark, sf)
    return report_files(spark, root, recursive=True, glob="*.txt").select(
        "folder", "uid", "Parameter", "Plate", "Label", "ts_id", "Description")


@register("organise_folder",
          _DEMO + ", l as (select d.*, pl.\"Name\", pa.\"Unit\", d.\"Parameter\" || '.' || d.\"Label\" || '@' || "
          "d.\"Plate\" as ts_id from demo d left join plates pl using (\"Plate\") "
          "left join params pa using (\"Parameter\") where d.\"Value\" is not null) "
          "select folder, \"Name\", ts_id, min(\"Plate\") as \"Plate\", min(\"Description\") as \"Description\", "
          "min(\"Unit\") as \"Unit\", min(\"TimeStamp\") as \"Start\", max(\"TimeStamp\") as \"End\", "
          "round(min(\"Value\"), 3) as \"Min\", arg_min(\"TimeStamp\", (\"Value\", \"TimeStamp\")) as \"Time_min\", "
          "round(max(\"Value\"), 3) as \"Max\", arg_min(\"TimeStamp\", (-\"Value\", \"TimeStamp\")) as \"Time_max\" "
          "from l group by folder, \"Name\", ts_id, uid")
def q_organise_folder(spark, sf):
    """Range summary of every series after the organise plan (file name column dropped)."""
    return _organised(spark, sf).summary.drop("CSV")


@register("long_table_sql",
          _DEMO + "select d.\"TimeStamp\", " + r6('d."Value"', "Value") + ", pa.\"Unit\", d.\"Parameter\", "
          "pl.\"Plate\", pl.\"Name\", d.folder, d.uid from demo d "
          "left join plates pl on d.\"Plate\" = pl.\"Plate\" left join params pa using (\"Parameter\") "
          "where d.\"Value\" is not null")
def q_long_table_sql(spark, sf):
    """SQL-dialect long table (recursive scan, uid from the path, NULLs dropped)."""
    root = render_demo(spark, sf)
    long, _ = long_table(spark, root, params_dim(spark), plates_dim(spark), glob="*.txt")
    return long


_GATE_SQL = _DEMO + f""", l as (select d.*, pl."Name", pa."Unit" from demo d left join plates pl using ("Plate")
                left join params pa using ("Parameter")),
nf as (select folder, count(distinct uid) as nf, count(distinct "Plate") as np from l group by 1),
pu as (select distinct folder, "Plate", uid from l),
dp as (select folder, "Plate" from pu group by 1, 2 having count(*) > 1),
df as (select pu.folder, count(*) as n_dup_files from pu join dp using (folder, "Plate") group by 1),
up as (select folder, count(*) as nup from (select distinct folder, "Unit", "Parameter" from l) group by 1),
nm as (select folder, count(distinct coalesce("Name", "Plate")) as nn, count(distinct "Plate") as np2 from l group by 1),
tt as (select distinct folder, "TimeStamp" as ts, 0.0 as v from l),
{step_ctes('st', 'tt', ['folder'], 'ts', 'v is not null')},
mid as (select folder, bool_and(epoch_us(ts) % 86400000000 = 0) as m from tt group by 1),
g as (select folder, case when np < nf then 'duplicate_site' when nup > 1 then 'mixed_unit_or_parameter'
               when step_us is null then 'insufficient_data'
               when step_us = -1 or step_us > 86400000000 then 'irregular_or_coarse'
               when nn < np2 then 'name_collision' end as reason,
             coalesce(n_dup_files, 0) as n_dup_files,
             case when step_us > 0 then step_us // 1000000 else step_us end as step_s,
             coalesce(step_us = 86400000000 and m, false) as is_daily
      from nf join up using (folder) join nm using (folder) join st using (folder) join mid using (folder)
      left join df using (folder))
select folder, reason is null as eligible, reason, n_dup_files, step_s, is_daily from g"""


@register("wide_eligibility", _GATE_SQL)
def q_wide_eligibility(spark, sf):
    """T5: per-folder verdict (each reason appears once in the demo folders)."""
    return _organised(spark, sf).gate.select("folder", "eligible", "reason", "n_dup_files", "step_s", "is_daily")


def _wide_sql(folder: str, tcol: str, daily: bool) -> str:
    names = [b for a, b in PLATES if not a.endswith("_N")]
    cols = ", ".join(f"max(\"Value\") filter (where \"Name\" = '{n}') as \"{n}\"" for n in names)
    tsel = "cast(\"TimeStamp\" as date)" if daily else "\"TimeStamp\""
    anyv = "coalesce(" + ", ".join(f'"{n}"' for n in names) + ")"
    fmt = f"strftime({tcol}, '%Y-%m-%d')" if daily else tcol
    return (_DEMO + f", l as (select d.*, pl.\"Name\" from demo d left join plates pl using (\"Plate\") "
            f"where folder = '{folder}'), w as (select 1 as f, {tsel} as {tcol}, {cols} from l group by 2), "
            f"{step_ctes('st', 'w', ['f'], tcol, anyv + ' is not null', daily)}, "
            f"{pad_ctes('p', 'w', 'st', ['f'], tcol, [chr(34) + n + chr(34) for n in names], anyv + ' is not null', daily)} "
            f"select {fmt} as {tcol}, " + ", ".join(r6(f'"{n}"', n) for n in names) + " from p")


@register("wide_table_hourly", _wide_sql("hourly", "Time", False))
def q_wide_table_hourly(spark, sf):
    """R1 + R6 + T4: the eligible hourly folder as a padded wide table."""
    return _organised(spark, sf).wide("hourly")


@register("wide_table_daily", _wide_sql("daily", "Date", True))
def q_wide_table_daily(spark, sf):
    """R1 + R6 + T4: the eligible daily folder (DATE column ``Date``)."""
    return _organised(spark, sf).wide("daily")


# ---------------------------------------------------------------- T1

from ..operators.validate import ts_validate  # noqa: E402


@register("ts_validate_dups",
          "select o_orderpriority, 'duplicate_times' as \"check\", count(*) as n from "
          "(select o_orderpriority, o_orderdate from orders group by 1, 2 having count(*) > 1) group by 1 "
          "union all select o_orderpriority, 'out_of_order', count(*) from "
          "(select o_orderpriority, o_orderdate, lag(o_orderdate) over "
          "(partition by o_orderpriority order by o_orderkey) as p from orders) where o_orderdate < p group by 1")
def q_ts_validate_dups(spark, sf):
    """Order dates per priority repeat, and are unordered by order key."""
    o = table(spark, sf, "orders").select("o_orderpriority", "o_orderdate", "o_totalprice", "o_orderkey")
    return ts_validate(o, ["o_orderpriority"], "o_orderdate", seq="o_orderkey")


# ---------------------------------------------------------------- J1/J2, S4-S6, K5

from ..operators.joins import enrich  # noqa: E402
from ..session import scratch_path  # noqa: E402
from ..sinks.writers import write_dim_json, write_lake  # noqa: E402
from ..sources.dims import dim_from_catalog, dim_from_json_map  # noqa: E402


@register("enrich_left_lookup",
          "select c_custkey, c_name, n_name from customer left join nation on c_nationkey = n_nationkey")
def q_enrich_left_lookup(spark, sf):
    """Customers tagged with their nation name (broadcast lookup)."""
    c = table(spark, sf, "customer").select("c_custkey", "c_name", F.col("c_nationkey").alias("n_nationkey"))
    dim = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return enrich(c, dim, "n_nationkey").select("c_custkey", "c_name", "n_name")


@register("enrich_unmatched",
          "select s_suppkey, s_name, n_name from supplier left join "
          "(select * from nation where n_regionkey <= 2) on s_nationkey = n_nationkey")
def q_enrich_unmatched(spark, sf):
    """Lookup against a partial dictionary; unmatched rows keep NULL."""
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").alias("n_nationkey"))
    dim = table(spark, sf, "nation").filter("n_regionkey <= 2").select("n_nationkey", "n_name")
    return enrich(s, dim, "n_nationkey").select("s_suppkey", "s_name", "n_name")


def _nation_region(spark, sf):
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    return n.join(r, n["n_regionkey"] == r["r_regionkey"]).select("n_nationkey", "n_name", "n_regionkey", "r_name")


@register("dim_json_map",
          "select n_name as \"Plate\", r_name as \"Name\" from nation join region on n_regionkey = r_regionkey")
def q_dim_json_map(spark, sf):
    """S4 + K5: a dictionary written as one JSON object and read back."""
    path = scratch_path(spark, "dim-json")
    write_dim_json(_nation_region(spark, sf), "n_name", "r_name", path)
    return dim_from_json_map(spark, path, "Plate", "Name")


def _catalog(spark, sf):
    path = scratch_path(spark, "catalog")
    n = table(spark, sf, "nation")
    items = F.sort_array(F.collect_list(F.struct(
        F.col("n_nationkey").alias("k"), F.col("n_regionkey").cast("string").alias("Identifier"),
        F.col("n_name").alias("Name"))))
    doc = n.agg(F.to_json(F.struct(F.transform(items, lambda x: F.struct(
        x["Identifier"].alias("Identifier"), x["Name"].alias("Name"))).alias("LocationDescriptions"))).alias("value"))
    doc.coalesce(1).write.mode("overwrite").text(path)
    return path


@register("dim_catalog_flatten",
          "select distinct cast(n_regionkey as varchar) as \"Identifier\", n_name as \"Name\" from nation")
def q_dim_catalog_flatten(spark, sf):
    """Catalogue payload flattened; duplicate ids keep every distinct pair."""
    return dim_from_catalog(spark, _catalog(spark, sf), "LocationDescriptions", "Identifier", "Name")


@register("dim_catalog_last",
          "select cast(n_regionkey as varchar) as \"Identifier\", arg_max(n_name, n_nationkey) as \"Name\" "
          "from nation group by 1")
def q_dim_catalog_last(spark, sf):
    """Catalogue payload flattened; per id the value listed last wins."""
    return dim_from_catalog(spark, _catalog(spark, sf), "LocationDescriptions", "Identifier", "Name",
                            keep="last")


# ---------------------------------------------------------------- S7, M1, M2

from ..sources.spec import render_spec, report_spec_scan  # noqa: E402
from .extract import extract_job, long_record_filter  # noqa: E402

# The report specs of the reference workload (title, StatType, Period).
SPECS = [("hourly_mean", "Mean", "Hourly"), ("hourly_sum", "Sum", "Hourly"),
         ("daily_mean", "Mean", "Daily"), ("daily_sum", "Sum", "Daily"),
         ("monthly_mean", "Mean", "Monthly"), ("monthly_sum", "Sum", "Monthly"),
         ("raw", None, None)]


_SPEC_PATHS: dict = {}


def _specs(spark):
    """The spec files are config: rendered once per application, then read."""
    key = spark.sparkContext.applicationId
    if key not in _SPEC_PATHS:
        path = scratch_path(spark, "specs")
        render_spec(spark, SPECS, path)
        _SPEC_PATHS[key] = path
    return report_spec_scan(spark, _SPEC_PATHS[key])


_SPEC_UNIT = {"Hourly": "hour", "Daily": "day", "Monthly": "month"}
_SPEC_FN = {"Mean": "avg", "Sum": "sum"}


def _spec_sql():
    parts = []
    for title, stat, period in SPECS:
        if stat is None:
            parts.append(f"select '{title}' as spec, event_type, ts, {r6(nn('value'), 'value')} from events")
        else:
            parts.append(f"select '{title}' as spec, event_type, date_trunc('{_SPEC_UNIT[period]}', ts) as ts, "
                         f"{r6(_SPEC_FN[stat] + '(' + nn('value') + ')', 'value')} from events group by all")
    return " union all ".join(parts)


@register("report_spec_resample", _spec_sql())
def q_report_spec_resample(spark, sf):
    """S7 + A2-A8: every report spec's process chain applied to every event type."""
    from ..operators.resample import apply_specs
    specs = _specs(spark)
    chains = {r["spec"]: r["ProcessChain"] for r in specs.select("spec", "ProcessChain").collect()}
    # every reading is requested under every spec (map-side, one scan)
    tagged = events(spark, sf).withColumn("spec", F.explode(F.array(*[F.lit(k) for k in sorted(chains)])))
    return apply_specs(tagged, chains, ["event_type"], "ts", "value").select("spec", "event_type", "ts", "value")


_MANIFEST_SQL = (
    "with m as (select cast(s_suppkey as varchar) as uid, case when n_regionkey <= 1 then 'daily_sum' "
    "when n_regionkey <= 3 then 'monthly_mean' else 'raw' end as spec, n_name as folder "
    "from supplier join nation on s_nationkey = n_nationkey), "
    f"r as (select cast(l_suppkey as varchar) as uid, l_shipdate as ts, {nn('l_quantity')} as v from lineitem) "
    "select folder, uid, date_trunc('day', ts) as \"TimeStamp\", " + r6("sum(v)", "Value") +
    " from r join m using (uid) where spec = 'daily_sum' group by all union all "
    "select folder, uid, date_trunc('month', ts), " + r6("avg(v)", "Value") +
    " from r join m using (uid) where spec = 'monthly_mean' group by all union all "
    "select folder, uid, ts, " + r6("v", "Value") + " from r join m using (uid) where spec = 'raw'")


@register("extract_manifest", _MANIFEST_SQL)
def q_extract_manifest(spark, sf):
    """M1 + J5: every supplier's shipments under its nation folder, with the spec of its region."""
    sup = table(spark, sf, "supplier")
    nat = table(spark, sf, "nation")
    manifest = sup.join(nat, sup["s_nationkey"] == nat["n_nationkey"]).select(
        F.col("s_suppkey").cast("string").alias("uid"),
        F.when(F.col("n_regionkey") <= 1, "daily_sum").when(F.col("n_regionkey") <= 3, "monthly_mean")
         .otherwise("raw").alias("spec"), F.col("n_name").alias("folder"))
    readings = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("uid"), F.col("l_shipdate").alias("TimeStamp"),
        F.col("l_quantity").alias("Value"))
    return extract_job(readings, manifest, _specs(spark))


def _by_supplier(spark, sf):
    """Readings of the suppliers, and a manifest of those of two regions."""
    sup, nat = table(spark, sf, "supplier"), table(spark, sf, "nation")
    manifest = sup.join(nat.filter("n_regionkey IN (1, 2)"), sup["s_nationkey"] == nat["n_nationkey"]).select(
        F.col("s_suppkey").cast("string").alias("uid"),
        F.when(F.col("n_regionkey") <= 1, "daily_sum").otherwise("monthly_mean").alias("spec"), F.col("n_name").alias("folder"))
    readings = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("uid"), F.col("l_shipdate").alias("TimeStamp"), F.col("l_quantity").alias("Value"))
    return readings, manifest


@register("extract_landed", _MANIFEST_SQL.replace("on s_nationkey = n_nationkey)", "on s_nationkey = n_nationkey where n_regionkey in (1, 2))"))
def q_extract_landed(spark, sf):
    """M1 + K1: a selection of suppliers extracted from a lake by series bucket, landed by folder and read back."""
    lake, out = scratch_path(spark, "lake"), scratch_path(spark, "extract")
    readings, manifest = _by_supplier(spark, sf)
    write_lake(readings, lake)
    return extract_job(spark.read.parquet(lake), manifest, _specs(spark), out=out)


@register("long_record_filter",
          f"with d as (select p_brand, date_trunc('day', l_shipdate) as ts, sum({nn('l_quantity')}) as v "
          "from lineitem join part on l_partkey = p_partkey group by all), "
          f"{step_ctes('st', 'd', ['p_brand'], 'ts', 'v is not null')}, "
          "n as (select p_brand, count(v) as n from d group by 1), "
          "x as (select p_brand, n, step_us // 1000000 as step_s, n * step_us / (86400e6 * 365.2422) as ny "
          "from st join n using (p_brand) where step_us > 0) "
          "select p_brand, n, step_s, " + r6("ny", "net_years") + " from x where ny >= 4.0")
def q_long_record_filter(spark, sf):
    """M2: part brands whose daily shipment series has at least 4 net years."""
    li = table(spark, sf, "lineitem").select("l_partkey", "l_shipdate", "l_quantity")
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    daily = resample(li.join(part, "l_partkey"), ["p_brand"], "l_shipdate", "l_quantity", "day", "sum")
    return long_record_filter(daily, ["p_brand"], "l_shipdate", ["l_quantity"], min_years=4.0)


# ---------------------------------------------------------------- S3 scalars

from ..functions.names import compact_uid, series_id, split_series_name  # noqa: E402


@register("split_series_name",
          "with t as (select p_partkey, p_type || ' @ ' || p_name || '@' || p_brand as token from part) "
          "select p_partkey, token, regexp_extract(token, '^(.*)@([^@]*)$', 1) as \"Parameter\", "
          "regexp_extract(token, '^(.*)@([^@]*)$', 2) as \"Plate\" from t")
def q_split_series_name(spark, sf):
    """S3 scalar: ``Parameter@Plate`` split at the last ``@`` (inner ``@`` kept)."""
    p = table(spark, sf, "part").select(
        "p_partkey", F.concat("p_type", F.lit(" @ "), "p_name", F.lit("@"), "p_brand").alias("token"))
    param, plate = split_series_name("token")
    return p.select("p_partkey", "token", param.alias("Parameter"), plate.alias("Plate"))


@register("series_id_build",
          "select p_partkey, p_name || '.' || 'Size ' || p_size || '@' || p_brand as ts_id, "
          "md5(p_name || p_brand) as uid from part")
def q_series_id_build(spark, sf):
    """P1 scalars: ``Parameter.Label@Plate`` ids and hyphen-free unique ids."""
    p = table(spark, sf, "part")
    h = F.md5(F.concat("p_name", "p_brand"))
    hyph = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))
    return p.select("p_partkey",
                    series_id("p_name", F.concat(F.lit("Size "), F.col("p_size").cast("string")), "p_brand")
                    .alias("ts_id"), compact_uid(hyph).alias("uid"))


# ---------------------------------------------------------------- X1 with a pandas aggregate

from ..functions.udafs import spread  # noqa: E402

@register("hourly_2_daily_udaf", _h2d_sql(0, "(max(value) - min(value)) + 0 * ", "spread", 0.75)
          .replace("(max(value) - min(value)) + 0 * (value)", "(max(value) - min(value))"))
def q_hourly_2_daily_udaf(spark, sf):
    """A Python (pandas, Arrow-batched) aggregate as the daily statistic."""
    return hourly_2_daily(hourly_events(spark, sf), ["event_type"], "ts", "value",
                          agg=spread, prop=0.75)


# ---------------------------------------------------------------- A12, S5, K1

from ..operators.summary import distinct_count  # noqa: E402
from ..sinks.writers import (register_tables, save_table, write_dim_csv, write_long_by_folder, write_per_site,  # noqa: E402
                             write_long_table, write_summary_tsv, write_wide)
from ..sources.dims import dim_from_csv  # noqa: E402
from ..functions.timecols import nan_to_null_sql  # noqa: E402


@register("distinct_count",
          "select l_returnflag, count(*) as n from (select distinct l_returnflag, l_linestatus, l_discount "
          "from lineitem) group by 1")
def q_distinct_count(spark, sf):
    """Exact distinct (status, discount) tuples per return flag."""
    li = table(spark, sf, "lineitem")
    return distinct_count(li, "l_returnflag", ["l_linestatus", "l_discount"])


@register("dim_csv",
          "select n_name as \"Plate\", r_name as \"Name\" from nation join region on n_regionkey = r_regionkey")
def q_dim_csv(spark, sf):
    """S5 + K5: a dictionary written as CSV with header and read back as a lookup."""
    path = scratch_path(spark, "dim-csv")
    write_dim_csv(_nation_region(spark, sf).select(F.col("n_name").alias("Plate"),
                                                    F.col("r_name").alias("Name")), path)
    return dim_from_csv(spark, path)


@register("long_by_folder_roundtrip",
          f"select l_returnflag as folder, md5(l_returnflag || l_linestatus) as uid, "
          f"strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as \"TimeStamp\", {r6(nn('l_quantity'), 'Value')} "
          "from lineitem")
def q_long_by_folder_roundtrip(spark, sf):
    """K1: long table written per folder (time as text) and read back."""
    path = scratch_path(spark, "long-by-folder")
    long = _lineitem_long(spark, sf).withColumn("Value", F.expr(f"{nan_to_null_sql('Value')}"))
    write_long_by_folder(long, path)
    return spark.read.parquet(path).select("folder", "uid", "TimeStamp", "Value")


# ---------------------------------------------------------------- §2.13 #3: always-daily padding

_RPAD_SQL = (f"with {H}, d0 as (select event_type, cast(ts - interval 1 hour as date) as \"Date\", "
             "avg(value) as \"Agg_mean\" from h where value is not null group by all "
             "having count(value) / 24.0 >= 1.0), "
             "b as (select event_type, min(\"Date\") as s, max(\"Date\") as e from d0 group by 1 "
             "having max(\"Date\") > min(\"Date\")), "
             "g as (select event_type, cast(unnest(generate_series(cast(s as timestamp), cast(e as timestamp), "
             "interval 1 day)) as date) as \"Date\" from b), "
             "p as (select coalesce(g.event_type, d0.event_type) as event_type, coalesce(g.\"Date\", d0.\"Date\") "
             "as \"Date\", d0.\"Agg_mean\" from g full outer join d0 on g.event_type = d0.event_type "
             "and g.\"Date\" = d0.\"Date\") "
             "select event_type, strftime(\"Date\", '%Y-%m-%d') as \"Date\", " + r6('"Agg_mean"', "Agg_mean") +
             " from p")


@register("hourly_2_daily_full_daily_pad", _RPAD_SQL)
def q_hourly_2_daily_full_daily_pad(spark, sf):
    """A9, R dialect: fully covered days, padded daily whatever their spacing."""
    return hourly_2_daily(hourly_events(spark, sf), ["event_type"], "ts", "value", prop=1.0,
                          pad_step_s=86_400)


# ---------------------------------------------------------------- §2.13 #1: R step dialect

_RSTEP_SQL = (
    f"with e as (select distinct event_type, epoch_us(ts) as u from events where {nn('value')} is not null), "
    "d as (select event_type, u - lag(u) over (partition by event_type order by u) as d from e), "
    "m as (select event_type, min(d) filter (where d >= 60000000) as m, count(*) as n from d group by 1), "
    "b as (select d.event_type, count(*) filter (where d.d >= 60000000 and d.d % m.m <> 0) as bad "
    "from d join m using (event_type) group by 1) "
    "select event_type, case when m is null then case when n > 1 then -1 end when bad > 0 then -1 "
    "else m // 1000000 end as step_s from m join b using (event_type)")


@register("ts_step_r_dialect", _RSTEP_SQL)
def q_ts_step_r_dialect(spark, sf):
    """T2, R dialect: gaps under the threshold are ignored."""
    return ts_step(events(spark, sf), ["event_type"], "ts", ["value"], ignore_subthreshold=True)


@register("data_range_summary_moments",
          f"with e as (select event_type, {nn('value')} as v from events) "
          "select event_type, round(avg(v), 3) as \"Mean\", round(stddev_samp(v), 3) as \"Std\" "
          "from e where v is not null group by 1")
def q_data_range_summary_moments(spark, sf):
    """Mean and sample standard deviation at the operator's three digits."""
    return data_range_summary(events(spark, sf), ["event_type"], "ts", "value", attrs=(),
                              extended=True).select("event_type", "Mean", "Std")


# ---------------------------------------------------------------- sinks, read back

@register("sink_wide", _wide_sql("daily", "Date", True))
def q_sink_wide(spark, sf):
    """K2 + O2: the wide daily table written and read back (time as text)."""
    path = scratch_path(spark, "wide")
    write_wide(_organised(spark, sf).wide("daily"), path, "Date", True)
    return spark.read.parquet(path)


@register("sink_long_table", ORACLES["long_table_sql"].replace(
    'd."TimeStamp",', "strftime(d.\"TimeStamp\", '%Y-%m-%d %H:%M:%S') as \"TimeStamp\","))
def q_sink_long_table(spark, sf):
    """K3 + O1: the long table of the SQL dialect written in order and read back."""
    path = scratch_path(spark, "df-long")
    long, _ = long_table(spark, render_demo(spark, sf), params_dim(spark), plates_dim(spark), glob="*.txt")
    write_long_table(long, path)
    return spark.read.parquet(path)


@register("sink_summary_tsv", ORACLES["organise_folder"])
def q_sink_summary_tsv(spark, sf):
    """K4 + O1: the range summary written as TSV and read back with its schema."""
    path = scratch_path(spark, "summary")
    summary = _organised(spark, sf).summary.drop("CSV")
    write_summary_tsv(summary, path, ["folder", "Name", "ts_id"])
    return spark.read.option("sep", "\t").option("header", True).schema(summary.schema).csv(path)


@register("sql_tables",
          _DEMO + "select d.folder, pl.\"Name\", count(*) as n, round(avg(d.\"Value\") + 1e-9, 6) as mean from demo d "
          "left join plates pl on d.\"Plate\" = pl.\"Plate\" where d.\"Value\" is not null group by all")
def q_sql_tables(spark, sf):
    """K6: tables registered by name and queried in SQL."""
    long, _ = long_table(spark, render_demo(spark, sf), params_dim(spark), plates_dim(spark), glob="*.txt")
    register_tables(spark, {"df_long": long})
    return spark.sql("SELECT folder, Name, count(*) AS n, avg(Value) AS mean FROM df_long GROUP BY folder, Name")


@register("saved_tables",
          "select event_type, count(*) as n, min(ts) as first, max(ts) as last, " + r6("sum(value)", "total") + " from events group by 1")
def q_saved_tables(spark, sf):
    """K6: a saved table, bucketed by series and replaced once, grouped by series."""
    name, path = f"readings_{uuid.uuid4().hex[:8]}", scratch_path(spark, "tables")
    e = events(spark, sf).select("event_type", "ts", "value")
    save_table(e.filter("value IS NULL"), name, "event_type", "ts", path)
    save_table(e, name, "event_type", "ts", path)
    return spark.sql(f"SELECT event_type, count(*) AS n, min(ts) AS first, max(ts) AS last, sum(value) AS total FROM {name} GROUP BY event_type")


@register("per_site_roundtrip", ORACLES["ts_2_list"])
def q_per_site_roundtrip(spark, sf):
    """One padded series per site, written to a folder for each site and read back."""
    path = scratch_path(spark, "sites")
    made = QUERIES["ts_2_list"](spark, sf)
    write_per_site(made, path, "Site", "ts", rows_per_file=1_000)
    return spark.read.schema(made.schema).parquet(path).select("Site", "ts", "Value")


@register("folder_rewrite",
          "select event_type as folder, cast(user_id as varchar) as uid, strftime(ts, '%Y-%m-%d %H:%M:%S') as \"TimeStamp\", "
          + r6("case when event_type = 'click' then -1 * value else value end", "Value") + " from events")
def q_folder_rewrite(spark, sf):
    """K1: the long table by folder, of which one folder is written again."""
    path = scratch_path(spark, "long")
    long = table(spark, sf, "events").selectExpr("event_type AS folder", "CAST(user_id AS STRING) AS uid", "ts AS TimeStamp", "value AS Value")
    write_long_by_folder(long, path)
    write_long_by_folder(long.filter("folder = 'click'").withColumn("Value", -F.col("Value")), path, mode="folders")
    return spark.read.schema("uid string, TimeStamp string, Value double, folder string").parquet(path)


@register("report_order",
          "with e as (select event_type, ts, lag(ts) over (partition by event_type order by event_id) as before from events) "
          "select event_type as \"CSV\", count(*) as out_of_order from "
          "(select event_type, date_trunc('second', ts) as t, date_trunc('second', before) as b from e) where t < b group by 1")
def q_report_order(spark, sf):
    """T1 + O3: report files whose readings stand in order of arrival, not of time."""
    root, tmp = scratch_path(spark, "order") + "/f", scratch_path(spark, "order-by-file")
    e = table(spark, sf, "events").selectExpr("event_type AS file", "event_id", "concat(date_format(ts, 'yyyy-MM-dd HH:mm:ss'), ',', "
                                     "coalesce(CAST(value AS STRING), '')) AS line")
    head = e.select("file").distinct().selectExpr("file", "-1L AS event_id", "concat('TimeStamp,Discharge@', file) AS line")
    e.unionByName(head).repartition("file").sortWithinPartitions("file", "event_id").select(
        "file", F.col("line").alias("value")).write.partitionBy("file").text(tmp)
    _flatten(spark, tmp, root)
    found = report_order(spark, root[: -len("/f")])
    return found.select(F.regexp_replace("CSV", "[.]csv$", "").alias("CSV"), "out_of_order")


@register("gate_dup_files",
          _DEMO + "select folder, uid from demo where (folder, \"Plate\") in (select (folder, \"Plate\") from "
          "(select distinct folder, \"Plate\", uid from demo) group by folder, \"Plate\" having count(*) > 1) group by all")
def q_gate_dup_files(spark, sf):
    """O5 + T5: the files whose plate occurs in more than one file of their folder."""
    return duplicate_files(_organised(spark, sf).long).select(
        "folder", F.regexp_extract("CSV", "uid=([^/]+)/", 1).alias("uid"))


# ---------------------------------------------------------------- ingest faults

@register("report_rejects",
          "select lpad(cast(event_id % 50 as varchar), 2, '0') || '.csv' as \"CSV\", "
          "case when event_id % 7 = 0 then 'bad value' else 'bad time' end as reason, count(*) as n from events "
          "where event_id % 7 in (0, 3) group by all "
          "union all select 'headless.csv', 'no header line', 1")
def q_report_rejects(spark, sf):
    """Readings with a bad time or value, and a file without header, are reported."""
    return report_rejects(spark, _faulty(spark, sf)).groupBy("CSV", "reason").agg(F.count("*").alias("n"))


@register("report_csv_flat_layout",
          "select lpad(cast(event_id % 50 as varchar), 2, '0') || '.csv' as \"CSV\", count(*) as n, "
          "round(sum(value) + 1e-9, 3) as total from events where event_id % 7 not in (0, 3) group by 1 "
          "union all select 'headless.csv', 1, 1.0")
def q_report_csv_flat_layout(spark, sf):
    """The layout root/<folder>/<file>; fractions of seconds, ``T`` and plain dates are read."""
    long = report_csv_scan(spark, _faulty(spark, sf), on_reject="keep")
    return long.groupBy("CSV").agg(F.count("*").alias("n"), F.round(F.sum("Value") + 1e-9, 3).alias("total"))


def _faulty(spark, sf):
    """Report files root/f/NN.csv of the events: every 7th value and time is broken."""
    root = scratch_path(spark, "flat") + "/f"
    e = table(spark, sf, "events").select("event_id", "ts", F.expr(nan_to_null_sql("value")).alias("value"))
    time = ("CASE event_id % 7 WHEN 1 THEN date_format(ts, 'yyyy-MM-dd') WHEN 2 THEN date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") "
            "WHEN 3 THEN date_format(ts, 'yyyy-MM-dd 99:mm:ss') WHEN 4 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSS') "
            "ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END")
    value = "IF(event_id % 7 = 0, 'abc', coalesce(cast(value AS string), ''))"
    data = e.selectExpr("lpad(cast(event_id % 50 AS string), 2, '0') AS file", "2 AS part", f"concat({time}, ',', {value}) AS line")
    heads = data.select("file").distinct().selectExpr(
        "file", "1 AS part", "concat('# 00000000-0000-0000-0000-0000000000', file, ' Discharge.Raw@P', file, ': demo\\nTimeStamp,Discharge@P', file) AS line")
    alone = spark.range(1).selectExpr("'headless' AS file", "2 AS part", "'2024-01-01 00:00:00,1' AS line")
    lines = data.unionByName(heads).unionByName(alone)
    tmp = root + "-by-file"
    lines.repartition("file").sortWithinPartitions("file", "part").select("file", F.col("line").alias("value")).write.partitionBy(
        "file").text(tmp)
    _flatten(spark, tmp, root)
    return root[: -len("/f")]


def _flatten(spark, tmp, root):
    """tmp/file=X/part-* to root/X.csv: the layout of the reports, made from Spark's."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(tmp).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path(root))
    for part in fs.globStatus(path(f"{tmp}/file=*/part-*")):
        p = part.getPath()
        fs.rename(p, path(f"{root}/{p.getParent().getName()[len('file='):]}.csv"))


# ---------------------------------------------------------------- names, lookups, selections

@register("ts_melt_dotted",
          "select 'St. ' || event_type as \"Site\", strftime(date_trunc('day', ts), '%Y-%m-%d') as \"Date\", "
          + r6("avg(" + nn("value") + ")", "Value") + " from events group by all")
def q_ts_melt_dotted(spark, sf):
    """R4 on site names with a dot and a blank (every event type has every day)."""
    daily = resample(events(spark, sf).withColumn("event_type", F.concat(F.lit("St. "), "event_type")),
                     ["event_type"], "ts", "value", "day", "mean").withColumn("ts", F.to_date("ts"))
    wide = to_wide(daily.withColumnRenamed("ts", "Date"), "Date", "event_type", "value")
    return ts_melt(wide, "Date")


@register("ts_info_all_sites",
          "with i as (select l_returnflag, min(l_shipdate) as s, max(l_shipdate) as e from lineitem "
          "group by 1) select p.o as place, p.site as \"Site\", i.s as \"Start\", i.e as \"End\" "
          "from (select min(l_orderkey) as o, l_returnflag as site from lineitem group by 2 "
          "union all select n_nationkey, n_name from nation) p left join i on p.site = i.l_returnflag")
def q_ts_info_all_sites(spark, sf):
    """J4 + A10: every listed site with its place in the input, with nulls where it has no data."""
    li = table(spark, sf, "lineitem")
    sites = li.groupBy(F.col("l_returnflag").alias("Site")).agg(F.min("l_orderkey").alias("place")).unionByName(
        table(spark, sf, "nation").select(F.col("n_name").alias("Site"), F.col("n_nationkey").alias("place")))
    info = ts_info(li.select(F.col("l_returnflag").alias("Site"), "l_shipdate", "l_quantity"), "Site", "l_shipdate", "l_quantity", scope="series")
    return keep_all_sites(sites, info).select("place", "Site", "Start", "End")


@register("manifest_semi",
          "select o_orderkey, o_totalprice from orders where o_custkey in "
          "(select c_custkey from customer where c_nationkey % 3 = 0)")
def q_manifest_semi(spark, sf):
    """Orders of the customers on a list, by a left semi join."""
    listed = table(spark, sf, "customer").filter("c_nationkey % 3 = 0").select(F.col("c_custkey").alias("o_custkey"))
    return select_listed(table(spark, sf, "orders"), listed, "o_custkey").select("o_orderkey", "o_totalprice")


@register("data_range_summary_any",
          "select l_returnflag, min(l_shipdate) as \"Start\", max(l_shipdate) as \"End\", "
          "round(min(l_quantity), 3) as \"Min\", round(max(l_quantity), 3) as \"Max\" from lineitem "
          "where l_linestatus <> 'F' and l_quantity is not null group by 1")
def q_data_range_summary_any(spark, sf):
    """A1, Python dialect: a row with any missing attribute does not count."""
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_shipdate", "l_quantity",
                                             F.expr("nullif(l_linestatus, 'F') AS status"))
    return data_range_summary(li, ["l_returnflag"], "l_shipdate", "l_quantity", attrs=(),
                              null_rule="any").select("l_returnflag", "Start", "End", "Min", "Max")


@register("concat_by_name",
          "select c_custkey as k, c_name as name, c_nationkey as nation, cast(null as double) as price from customer "
          "union all select o_orderkey, null, null, o_totalprice from orders")
def q_concat_by_name(spark, sf):
    """Frames with different columns stacked by name."""
    c = table(spark, sf, "customer").selectExpr("c_custkey AS k", "c_name AS name", "c_nationkey AS nation")
    o = table(spark, sf, "orders").selectExpr("o_totalprice AS price", "o_orderkey AS k")
    return concat_frames(c, o)


@register("ts_validate_schema",
          "select cast(null as varchar) as l_returnflag, 'many_temporal_columns' as \"check\", cast(null as bigint) as n "
          "union all select null, 'non_numeric_column', null")
def q_ts_validate_schema(spark, sf):
    """Two time columns and a text column among the values are schema violations."""
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_shipdate", F.col("l_shipdate").cast("date").alias("day"),
                                             "l_quantity", "l_linestatus")
    return ts_validate(li, ["l_returnflag"])


@register("gate_insufficient",
          "select k as folder, count(distinct ts) > 1 as eligible, case when count(distinct ts) = 1 then 'insufficient_data' end as reason "
          "from (select event_type || '-hourly' as k, date_trunc('hour', ts) as ts from events where value is not null "
          "union all select event_type || '-once', max(ts) from events group by 1) group by 1")
def q_gate_insufficient(spark, sf):
    """T5: a folder with a single time cannot become a wide table, the hourly folder next to it can."""
    e = events(spark, sf)
    hourly = resample(e, ["event_type"], "ts", "value", "hour", "mean").filter("value IS NOT NULL")
    once = e.groupBy("event_type").agg(F.max("ts").alias("ts"), F.max("value").alias("value"))
    both = hourly.withColumn("folder", F.concat("event_type", F.lit("-hourly"))).unionByName(
        once.withColumn("folder", F.concat("event_type", F.lit("-once"))))
    long = both.selectExpr("folder", "ts AS TimeStamp", "value AS Value", "'a.csv' AS CSV", "folder AS Plate", "folder AS Name", "'m' AS Unit", "'x' AS Parameter")
    return wide_eligibility(long).select("folder", "eligible", "reason")


_GAP_HOURS = ("select event_type, date_trunc('day', ts) + interval 2 hour + interval (epoch_us(ts) // 1000000 % 3600) second as t, value "
              "from events where value is not null")


@register("resample_gap_hours",
          f"select event_type, date_trunc('hour', t) as t, {r6('avg(value)', 'value')} from ({_GAP_HOURS}) group by all")
def q_resample_gap_hours(spark, sf):
    """A2 on readings between 02:00 and 03:00, which spring changes skip in many time zones."""
    e = events(spark, sf).filter("value IS NOT NULL").selectExpr(
        "event_type", "value",
        "CAST(to_date(ts) AS TIMESTAMP_NTZ) + make_dt_interval(0, 2, minute(ts), CAST(second(ts) AS DECIMAL(18, 6))) AS t")
    return resample(e, ["event_type"], "t", "value", "hour", "mean")
