"""Report specs (time range + process chain) as a config DataFrame.

The chain sits inside the spec as a JSON *string*; it is parsed with
``from_json`` against a fixed schema, so every spec file becomes one row:
``spec, ReportName, RangeType, UtcOffset, OutputType, Location,
TimeSeriesUniqueId, ColumnLabel, ProcessChain``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed schema of the inner input definition.
INPUT_SCHEMA = (
    "TimeSeriesUniqueId string, IsMaster boolean, ColumnLabel string, "
    "ProcessChain array<struct<ProcessType: string, StatType: string, Period: string, "
    "PeriodCount: int, RequireMinimumDataCoverage: boolean, BinAnchorOffsetPeriod: string>>")


def report_spec_scan(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("multiLine", True).option("recursiveFileLookup", "true").json(path)
    raw = raw.withColumn("__file", F.col("_metadata.file_name"))
    inner = F.from_json(F.col("Parameters.Input1.Value"), INPUT_SCHEMA)
    return raw.select(
        F.coalesce(F.col("Parameters.ReportTitle.Value"),
                   F.regexp_replace("__file", r"\.[^.]*$", "")).alias("spec"),
        F.col("ReportName"), F.col("RequestedTimeRange.Type").alias("RangeType"),
        F.col("UtcOffset"), F.col("OutputType"), F.col("LocationInput.Identifier").alias("Location"),
        inner.alias("__in")).select(
        "spec", "ReportName", "RangeType", "UtcOffset", "OutputType", "Location",
        F.col("__in.TimeSeriesUniqueId").alias("TimeSeriesUniqueId"),
        F.col("__in.ColumnLabel").alias("ColumnLabel"),
        F.coalesce(F.col("__in.ProcessChain"), F.array()).alias("ProcessChain"))


def render_spec(spark: SparkSession, rows, path: str, mode: str = "overwrite") -> None:
    """Write specs in the report-spec layout (inner input as a JSON string).

    ``rows``: iterable of (title, stat or None, period or None).
    """
    data = [(t, s, p) for t, s, p in rows]
    df = spark.createDataFrame(data, "title string, stat string, period string")
    step = F.struct(F.lit("Statistic").alias("ProcessType"), F.col("stat").alias("StatType"),
                    F.col("period").alias("Period"), F.lit(1).alias("PeriodCount"),
                    F.lit(False).alias("RequireMinimumDataCoverage"),
                    F.lit("00-00 00:00").alias("BinAnchorOffsetPeriod"))
    chain = F.when(F.col("stat").isNull(), F.array().cast(
        "array<struct<ProcessType:string,StatType:string,Period:string,PeriodCount:int,"
        "RequireMinimumDataCoverage:boolean,BinAnchorOffsetPeriod:string>>")).otherwise(F.array(step))
    inner = F.to_json(F.struct(F.lit("0" * 32).alias("TimeSeriesUniqueId"), F.lit(True).alias("IsMaster"),
                               F.lit("Value@SITE").alias("ColumnLabel"), chain.alias("ProcessChain")))
    doc = F.to_json(F.struct(
        F.lit("Time Series Data").alias("ReportName"),
        F.struct(F.lit("EntireRecord").alias("Type")).alias("RequestedTimeRange"),
        F.struct(F.struct(F.lit("ReportTitle").alias("Name"), F.col("title").alias("Value")).alias("ReportTitle"),
                 F.struct(F.lit("Input1").alias("Name"), inner.alias("Value")).alias("Input1")).alias("Parameters"),
        F.lit("PT12H").alias("UtcOffset"), F.lit("Csv").alias("OutputType"),
        F.struct(F.lit("Location").alias("Name"), F.lit("SITE").alias("Identifier")).alias("LocationInput")))
    # one spec per file (a multi-line JSON file holds one document)
    df.select("title", doc.alias("value")).write.mode(mode).partitionBy("title").text(path)
