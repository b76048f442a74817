"""Report folders derived from the driver's ``events`` table.

Used by the ingest queries and tests: every folder is built from all event
types (each type is one site), so its size grows with the table. Folders
cover each verdict of the wide gate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.resample import raw_series, resample
from ..session import scratch_path
from ..sinks.writers import render_report_files

# Fixed demo dictionaries (Plate -> Name, Parameter -> Unit).
PLATES = [("CLICK", "Click Creek"), ("ERROR", "Error Stream"), ("PURCHASE", "Purchase River"),
          ("SIGNUP", "Signup Brook"), ("VIEW", "View Lake"),
          ("CLICK_N", "North Arm"), ("ERROR_N", "North Arm"), ("PURCHASE_N", "Purchase North"),
          ("SIGNUP_N", "Signup North"), ("VIEW_N", "View North")]
PARAMS = [("Discharge", "m^3/s"), ("Rainfall", "mm"), ("Absorbance @ 254nm Filtered", "None")]
ABSORB = "Absorbance @ 254nm Filtered"


def plates_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PLATES, "Plate string, Name string")


def params_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PARAMS, "Parameter string, Unit string")


def demo_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long frame: folder, uid, Parameter, Label, Plate, Description, TimeStamp, Value.

    Report files carry whole seconds, so times are rendered at that precision.
    """
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_type", "ts", "value")
    hourly = resample(ev, ["event_type"], "ts", "value", "hour", "mean")
    daily = resample(ev, ["event_type"], "ts", "value", "day", "mean")
    raw = raw_series(ev, ["event_type"], "ts", "value")
    up = F.upper("event_type")
    first_half = F.col("event_type") < F.lit("p")

    def folder(df, name, parameter, label, plate, desc):
        return df.select(
            F.lit(name).alias("folder"),
            F.md5(F.concat(F.lit(name), F.lit("/"), F.col("event_type"), F.lit("/"), label)).alias("uid"),
            parameter.alias("Parameter"), label.alias("Label"), plate.alias("Plate"),
            desc.alias("Description"), F.col("ts").alias("TimeStamp"), F.col("value").alias("Value"))

    parts = [
        folder(hourly, "hourly", F.lit("Discharge"), F.lit("Hourly Mean"), up,
               F.concat(F.lit("Hourly mean of "), "event_type")),
        folder(raw, "raw", F.lit("Rainfall"), F.lit("Raw"), up,
               F.concat(F.lit("Raw readings, site: "), "event_type")),
        folder(daily, "daily", F.lit("Discharge"), F.lit("Daily Mean"), up,
               F.concat(F.lit("Daily mean of "), "event_type")),
        folder(hourly, "mixed", F.when(first_half, F.lit("Discharge")).otherwise(F.lit(ABSORB)),
               F.lit("Hourly Mean"), up, F.lit("Mixed parameters")),
        folder(hourly, "dup", F.lit("Discharge"), F.lit("Hourly Mean"),
               F.when(first_half, F.lit("CLICK")).otherwise(up), F.lit("Shared plate")),
        folder(daily, "named", F.lit("Discharge"), F.lit("Daily Mean"), F.concat(up, F.lit("_N")),
               F.lit("Two plates, one name")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_RENDERED: dict = {}


def render_demo(spark: SparkSession, sf_dir: str) -> str:
    """Render the demo folders as report files under the shared scratch folder.

    Rendered once per application and table folder; later calls reuse it.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RENDERED:
        root = scratch_path(spark, "reports")
        render_report_files(demo_series(spark, sf_dir), root)
        _RENDERED[key] = root
    return _RENDERED[key]


DEMO_SQL = """
h as (select event_type, date_trunc('hour', ts) as ts, avg(case when isnan(value) then null else value end) as value from events group by all),
dd as (select event_type, date_trunc('day', ts) as ts, avg(case when isnan(value) then null else value end) as value from events group by all),
r as (select event_type, date_trunc('second', ts) as ts, case when isnan(value) then null else value end as value from events),
demo as (
  select 'hourly' as folder, md5('hourly/' || event_type || '/Hourly Mean') as uid, 'Discharge' as "Parameter",
         'Hourly Mean' as "Label", upper(event_type) as "Plate", 'Hourly mean of ' || event_type as "Description",
         ts as "TimeStamp", value as "Value" from h
  union all
  select 'raw', md5('raw/' || event_type || '/Raw'), 'Rainfall', 'Raw', upper(event_type),
         'Raw readings, site: ' || event_type, ts, value from r
  union all
  select 'daily', md5('daily/' || event_type || '/Daily Mean'), 'Discharge', 'Daily Mean', upper(event_type),
         'Daily mean of ' || event_type, ts, value from dd
  union all
  select 'mixed', md5('mixed/' || event_type || '/Hourly Mean'),
         case when event_type < 'p' then 'Discharge' else 'Absorbance @ 254nm Filtered' end,
         'Hourly Mean', upper(event_type), 'Mixed parameters', ts, value from h
  union all
  select 'dup', md5('dup/' || event_type || '/Hourly Mean'), 'Discharge', 'Hourly Mean',
         case when event_type < 'p' then 'CLICK' else upper(event_type) end, 'Shared plate', ts, value from h
  union all
  select 'named', md5('named/' || event_type || '/Daily Mean'), 'Discharge', 'Daily Mean', upper(event_type) || '_N',
         'Two plates, one name', ts, value from dd),
plates as (select * from (values """ + ", ".join(f"('{a}', '{b}')" for a, b in PLATES) + """) t("Plate", "Name")),
params as (select * from (values """ + ", ".join(f"('{a}', '{b}')" for a, b in PARAMS) + """) t("Parameter", "Unit"))
"""
