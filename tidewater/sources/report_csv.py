"""Read folders of per-series report files into one long table.

A report file holds one series: a free-text preamble, a description line
``# <uid> <Parameter>.<Label>@<Plate>: <Description>``, a header line
``TimeStamp,<Parameter>@<Plate>`` and data lines ``time,value``.

The files are read with the text source (splittable, so a very large file
is spread over tasks). Lines are classified by pattern instead of by line
number. The text is parsed once, into a columnar stage in the shared scratch
folder: readings as times and numbers, other lines as they are. From there each
file is reduced to a row (header, description, counts of lines that cannot be
read), and the readings are joined to those rows on the file path, as Spark
finds best from their size. No file is parsed by a single Python process.

Nothing is dropped silently: a time or value that cannot be read, a file
without header and text lines beyond the preamble are rejects. Scans raise
when there are any (``on_reject="raise"``), or keep what can be read and
leave the rest to :func:`report_rejects` (``on_reject="keep"``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import (ANY_HEADER_LINE, DATA_LINE, DESC_LINE, HEADER_LINE, PREAMBLE_LINES,
                               compact_uid, series_id, split_series_name)
from ..functions.timecols import micros_sql, nan_to_null
from ..operators.joins import enrich, materialise, one_per_key, sized_broadcast
from ..session import scratch_path


def scan_lines(spark: SparkSession, root: str, recursive: bool = False,
               glob: str | None = None, place: bool = False) -> DataFrame:
    """(path, line) of every report file under ``root``; ``place``: and ``block``, where its split begins.

    ``recursive=False`` (S1): every file, any extension, of each direct
    sub-folder of ``root``. ``recursive=True`` (S2): all files below
    ``root`` matching ``glob`` (default ``*.csv``).
    """
    root = root.rstrip("/")
    pattern = root if recursive else f"{root}/*/*"
    found = _exists(spark, root, pattern)
    if found is None:
        raise FileNotFoundError(f"report folder {root!r} does not exist")
    if not found:  # only empty folders: nothing to read
        return spark.createDataFrame([], "path string, line string" + (", block long" if place else ""))
    if recursive:
        reader = spark.read.option("recursiveFileLookup", "true").option(
            "pathGlobFilter", glob or "*.csv")
        df = reader.text(root)
    else:
        reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
        df = reader.text(f"{root}/*/*")
    more = [F.col("_metadata.file_block_start").alias("block")] if place else []
    return df.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"), *more)


def _exists(spark: SparkSession, root: str, pattern: str):
    """None if ``root`` is missing, else whether ``pattern`` matches anything
    (file-system metadata only, as Spark's own file listing does)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    rp = jvm.org.apache.hadoop.fs.Path(root)
    fs = rp.getFileSystem(conf)
    if not fs.exists(rp):
        return None
    matches = fs.globStatus(jvm.org.apache.hadoop.fs.Path(pattern))
    return matches is not None and len(matches) > 0


#: ``folder=F/`` and ``uid=U/`` above the file, with nothing but ``name=value`` folders between.
_BELOW = r"/((?:[^/=]+=[^/]*/)*[^/]+)$"


def file_lineage(path="path") -> dict:
    """Folder (parent directory), CSV (file name) and the file stem.

    For folders written by Spark with ``partitionBy`` the ``folder=`` and
    ``uid=`` values right above the file are used instead, and CSV is the path
    below ``folder=``; what the path holds further up does not matter.
    """
    p = F.col(path) if isinstance(path, str) else path
    p = F.when(p.contains("%"), F.url_decode(F.replace(p, F.lit("+"), F.lit("%2B")))).otherwise(p)
    parts = F.split(p, "/")
    name = F.element_at(parts, -1)

    def hive(key, group, other):
        found = F.regexp_extract(p, f"/{key}=([^/]+){_BELOW}", group)
        return F.when(found != "", found).otherwise(other)

    return {"folder": hive("folder", 1, F.element_at(parts, -2)), "CSV": hive("folder", 2, name),
            "stem": hive("uid", 1, F.regexp_replace(name, r"\.[^.]*$", ""))}


def _classified(lines: DataFrame) -> DataFrame:
    """path, line, kind (data, header, other_header, description, text), TimeStamp, Value, reason."""
    line = F.col("line")
    kind = (F.when(line.rlike(DATA_LINE), "data").when(line.rlike(DESC_LINE), "description")
             .when(line.rlike(HEADER_LINE), "header").when(line.rlike(ANY_HEADER_LINE), "other_header")
             .when(F.trim(line) == "", "blank").otherwise("text"))
    parts = F.split(line, ",", 2)
    time, text = F.trim(parts[0]), F.trim(F.get(parts, 1))
    number = text.try_cast("double")
    out = lines.withColumn("kind", kind).withColumn("TimeStamp", F.when(
        F.col("kind") == "data", time.try_cast("timestamp_ntz"))).withColumn(
        "Value", F.when(F.col("kind") == "data", nan_to_null(number)))
    reason = F.when(F.col("kind") == "data", F.when(F.col("TimeStamp").isNull(), "bad time").when(
        text.isNull() | (number.isNull() & (text != "")), "bad value"))
    return out.withColumn("reason", reason)


def staged_lines(lines: DataFrame) -> DataFrame:
    """The classified lines, parsed once and written to the scratch folder: path, kind, line (of
    what is not a reading), TimeStamp, Value, reason."""
    spark = lines.sparkSession
    path = scratch_path(spark, "report-lines")
    out = _classified(lines).filter("kind <> 'blank'").selectExpr(
        "path", "kind", "IF(kind = 'data' AND reason IS NULL, NULL, line) AS line", "TimeStamp", "Value", "reason")
    out.write.parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def _per_file(c: DataFrame) -> DataFrame:
    """One row per file of the staged lines: its header and description lines, and why it cannot be read."""

    def line_of(kind):
        return F.max(F.when(F.col("kind") == kind, F.col("line")))

    per = c.groupBy("path").agg(
        F.coalesce(line_of("header"), line_of("other_header")).alias("__h"), line_of("description").alias("__d"),
        F.count_if(F.col("reason").isNotNull()).alias("__bad"), F.count_if(F.col("kind") == "data").alias("__data"),
        # further lines that look like a header are text
        (F.count_if(F.col("kind").isin("text", "other_header"))
         - F.when(F.count_if(F.col("kind") == "header") == 0, F.least(F.count_if(F.col("kind") == "other_header"), F.lit(1)))
         .otherwise(0)).alias("__text"))
    fault = F.when(F.col("__h").isNull(), "no header line").when(F.col("__text") > PREAMBLE_LINES, "unexpected lines")
    return per.withColumn("__fault", fault)


def report_rejects(spark: SparkSession, root: str, recursive: bool = False,
                   glob: str | None = None) -> DataFrame:
    """What cannot be read: path, folder, CSV, line (NULL for a whole file) and reason."""
    lines = staged_lines(scan_lines(spark, root, recursive, glob))
    bad = lines.filter("reason IS NOT NULL").select("path", "line", "reason")
    files = _per_file(lines).filter("__fault IS NOT NULL").select(
        "path", F.lit(None).cast("string").alias("line"), F.col("__fault").alias("reason"))
    lin = file_lineage("path")
    return bad.unionByName(files).select("path", lin["folder"].alias("folder"), lin["CSV"].alias("CSV"), "line", "reason")


def _checked(lines: DataFrame, on_reject: str):
    """The per-file table of the staged lines, computed once; raises on rejects unless they are kept."""
    if on_reject not in ("raise", "keep"):
        raise ValueError("on_reject must be 'raise' or 'keep'")
    files = materialise(_per_file(lines))
    if on_reject == "raise":
        bad = files.df.filter("__bad > 0 OR __fault IS NOT NULL")
        first = bad.select("path", "__bad", "__fault").orderBy("path").first()
        if first is not None:
            raise ValueError(f"{first['path']}: {first['__fault'] or ''} {first['__bad']} unreadable readings; "
                             "see report_rejects, or scan with on_reject='keep'")
    return files.df


def report_headers(lines: DataFrame) -> DataFrame:
    """S3: one row per file: path, folder, CSV, Parameter, Plate, Label, uid, ts_id, Description."""
    return _headers(_per_file(_classified(lines)))


def _headers(per_file: DataFrame) -> DataFrame:
    token = F.regexp_extract("__h", "^[^,]*,(.*)$", 1)
    param, plate = split_series_name(token)
    lin = file_lineage("path")
    x = per_file.select("path", lin["folder"].alias("folder"), lin["CSV"].alias("CSV"),
                        param.alias("Parameter"), plate.alias("Plate"),
                        F.regexp_extract("__d", r"^# (\S+) ", 1).alias("__uid"), "__d")
    x = x.withColumn("__rest", F.expr("substr(__d, length(__uid) + 4)"))
    x = x.withColumn("__at", F.expr("locate(concat('@', Plate, ': '), __rest, length(Parameter) + 2)"))
    x = x.withColumn("__end", F.expr(
        "case when __at > 0 then __at when endswith(__rest, concat('@', Plate)) "
        "then length(__rest) - length(Plate) else 0 end"))
    label = F.expr("case when __end > 0 then substr(__rest, length(Parameter) + 2, "
                   "__end - length(Parameter) - 2) end")
    desc = F.expr("case when __at > 0 then substr(__rest, __at + length(Plate) + 3) "
                  "when __end > 0 then '' end")
    x = x.select("path", "folder", "CSV", "Parameter", "Plate", label.alias("Label"),
                 compact_uid("__uid").alias("uid"), desc.alias("Description"))
    return x.withColumn("ts_id", series_id("Parameter", "Label", "Plate"))


def report_order(spark: SparkSession, root: str, recursive: bool = False, glob: str | None = None) -> DataFrame:
    """T1 / O3 on files as they are: ``path, folder, CSV, out_of_order``, the readings whose
    time is earlier than that of the reading before them in the file; files without any are left out.

    Text is read in splits. Within one, lines come in the order of the file, so a
    running minimum is not needed: a split is reduced, as it is read and without
    a shuffle, to its first and last time and its number of steps back; the
    edges of the splits are compared in order of their place in the file.
    """
    lines = scan_lines(spark, root, recursive, glob, place=True)
    c = _classified(lines).filter("kind = 'data' AND reason IS NULL").selectExpr("path", "block", f"{micros_sql('TimeStamp')} AS t")

    def run(batches):
        number = 0  # batches of a task are in order
        for batch in batches:
            if not batch.num_rows:
                continue
            path, block, t = (batch.column(batch.schema.get_field_index(c)) for c in ("path", "block", "t"))
            code = path.dictionary_encode().indices.to_numpy()
            at, t = block.to_numpy(), t.to_numpy()
            same = (code[1:] == code[:-1]) & (at[1:] == at[:-1])
            first = np.flatnonzero(np.concatenate(([True], ~same)))
            back = np.concatenate(([0], same & (t[1:] < t[:-1]))).astype(np.int64)
            last = np.concatenate((first[1:], [len(t)])) - 1
            number += 1
            yield pa.RecordBatch.from_arrays(
                [path.take(pa.array(first)), pa.array(at[first]), pa.array(np.full(len(first), number)), pa.array(t[first]),
                 pa.array(t[last]), pa.array(np.add.reduceat(back, first))], ["path", "block", "number", "first", "last", "back"])

    pieces = c.mapInArrow(run, "path string, block long, number long, first long, last long, back long")
    edges = pieces.selectExpr("path", "back", "first < lag(last) OVER (PARTITION BY path ORDER BY block, number) AS edge")
    per = edges.groupBy("path").agg((F.sum("back") + F.count_if("edge")).alias("out_of_order")).filter("out_of_order > 0")
    lin = file_lineage("path")
    return per.select("path", lin["folder"].alias("folder"), lin["CSV"].alias("CSV"), "out_of_order")


def report_readings(staged: DataFrame) -> DataFrame:
    """(path, TimeStamp, Value) of every readable data line; empty and NaN values are NULL."""
    return staged.filter("kind = 'data' AND reason IS NULL").select("path", "TimeStamp", "Value")


LONG_COLUMNS = ["TimeStamp", "Value", "Unit", "ts_id", "Parameter", "Label", "Plate", "Name",
                "uid", "CSV", "Description", "folder"]


def report_csv_scan(spark: SparkSession, root: str, params: DataFrame | None = None,
                    plates: DataFrame | None = None, recursive: bool = False,
                    glob: str | None = None, with_files: bool = False, on_reject: str = "raise"):
    """D2 long frame of all report files under ``root`` (NULL readings kept).

    ``params`` is a (Parameter, Unit) and ``plates`` a (Plate, Name)
    dimension; unmatched lookups give NULL. ``with_files=True`` also
    returns the per-file header table (files without data rows included).
    """
    lines = staged_lines(scan_lines(spark, root, recursive, glob))
    heads = _headers(_checked(lines, on_reject))
    long = report_readings(lines).join(heads, "path", "left")
    long = _attach_dims(long, params, plates).select(*LONG_COLUMNS)
    return (long, heads) if with_files else long


def report_files(spark: SparkSession, root: str, recursive: bool = False,
                 glob: str | None = None) -> DataFrame:
    """Per-file header table (files without data rows included)."""
    return report_headers(scan_lines(spark, root, recursive, glob))


def _attach_dims(df: DataFrame, params, plates) -> DataFrame:
    if params is not None:
        df = enrich(df, params.select("Parameter", "Unit"), "Parameter")
    else:
        df = df.withColumn("Unit", F.lit(None).cast("string"))
    if plates is not None:
        df = enrich(df, plates.select("Plate", "Name"), "Plate")
    else:
        df = df.withColumn("Name", F.lit(None).cast("string"))
    return df


def long_table_scan(spark: SparkSession, root: str, params: DataFrame | None = None,
                    plates: DataFrame | None = None, glob: str = "*.csv",
                    drop_nulls: bool = True, on_reject: str = "raise") -> DataFrame:
    """T7 (SQL dialect): recursive scan, ``uid`` = file stem, folder = parent,
    NULL readings dropped (as UNPIVOT does); columns
    TimeStamp, Value, Unit, Parameter, Plate, Name, folder, uid.
    """
    lines = staged_lines(scan_lines(spark, root, True, glob))
    param, plate = split_series_name(F.regexp_extract("__h", "^[^,]*,(.*)$", 1))
    lin = file_lineage("path")
    heads = _checked(lines, on_reject).select("path", param.alias("Parameter"), plate.alias("Plate"),
                                              lin["folder"].alias("folder"), lin["stem"].alias("uid"))
    readings = report_readings(lines)
    if drop_nulls:
        readings = readings.filter(F.col("Value").isNotNull())
    long = readings.join(heads, "path", "left")
    if plates is not None:
        # the SQL dialect takes the plate table's columns: Plate is NULL too when unmatched
        pl = one_per_key(plates.select(F.col("Plate").alias("__pl"), "Name"), "__pl")
        long = long.join(sized_broadcast(pl), F.col("Plate") == F.col("__pl"), "left")
        long = long.withColumn("Plate", F.col("__pl")).drop("__pl")
    else:
        long = long.withColumn("Name", F.lit(None).cast("string"))
    if params is not None:
        long = enrich(long, params.select("Parameter", "Unit"), "Parameter")
    else:
        long = long.withColumn("Unit", F.lit(None).cast("string"))
    return long.select("TimeStamp", "Value", "Unit", "Parameter", "Plate", "Name", "folder", "uid")
