"""Sinks write what the readers read back; pandas UDAFs plug into hourly_2_daily."""

from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql.functions import pandas_udf

from tidewater.operators.daily import hourly_2_daily
from tidewater.sinks import writers
from tidewater.sources.dims import dim_from_json_map

SCHEMA = "site string, t timestamp_ntz, v double"


def test_pandas_udaf_in_hourly_2_daily(spark):
    @pandas_udf("double")
    def spread(v: pd.Series) -> float:
        return float(v.max() - v.min())

    b = datetime(2024, 1, 1, 1)
    rows = [("a", b + timedelta(hours=i), float(i)) for i in range(24)]
    out = hourly_2_daily(spark.createDataFrame(rows, SCHEMA), ["site"], "t", "v", agg=spread).collect()
    assert [(str(r["Date"]), r["Agg_spread"]) for r in out] == [("2024-01-01", 23.0)]


def test_long_wide_summary_and_dim_writers(spark, tmp_path):
    b = datetime(2024, 1, 1)
    long = spark.createDataFrame(
        [("f1", "u1", b + timedelta(hours=i), float(i), "Flow A", "FA") for i in range(3)],
        "folder string, uid string, TimeStamp timestamp_ntz, Value double, Name string, Plate string")
    writers.write_long_by_folder(long, str(tmp_path / "long"))
    back = spark.read.parquet(str(tmp_path / "long"))
    assert back.count() == 3 and dict(back.dtypes)["TimeStamp"] == "string"
    assert {r["folder"] for r in back.collect()} == {"f1"}
    writers.write_long_table(long, str(tmp_path / "df_long"))
    assert spark.read.parquet(str(tmp_path / "df_long")).count() == 3
    wide = long.groupBy("TimeStamp").pivot("Name", ["Flow A"]).agg({"Value": "max"})
    writers.write_wide(wide, str(tmp_path / "wide"), "TimeStamp", daily=False)
    w = spark.read.parquet(str(tmp_path / "wide"))
    assert w.columns[0] == "Time" and w.count() == 3
    writers.write_summary_tsv(long.select("folder", "Name"), str(tmp_path / "tsv"))
    tsv = spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "tsv"))
    assert tsv.count() == 3
    dim = spark.createDataFrame([("FA", "Flow A"), ("FB", "None")], "Plate string, Name string")
    writers.write_dim_json(dim, "Plate", "Name", str(tmp_path / "dim"))
    got = {r["Plate"]: r["Name"] for r in dim_from_json_map(spark, str(tmp_path / "dim"), "Plate", "Name").collect()}
    assert got == {"FA": "Flow A", "FB": "None"}


def _files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("part-*.parquet")}


def test_one_folder_is_written_again(spark, tmp_path):
    b = datetime(2024, 1, 1)
    long = spark.createDataFrame([(f, "u", b + timedelta(hours=i), float(i)) for f in ("a", "b", "c") for i in range(5)],
                                 "folder string, uid string, TimeStamp timestamp_ntz, Value double")
    path = tmp_path / "long"
    writers.write_long_by_folder(long, str(path))
    before = _files(path)
    writers.write_long_by_folder(long.filter("folder = 'b' AND Value < 2"), str(path), mode="folders")
    after = _files(path)
    assert {f for f in before if "folder=b" not in f} == {f for f in after if "folder=b" not in f}
    assert all(after[f] == before[f] for f in after if "folder=b" not in f)
    assert {r["folder"]: r["count"] for r in spark.read.parquet(str(path)).groupBy("folder").count().collect()} == {"a": 5, "b": 2, "c": 5}


def test_files_of_a_site_are_bounded(spark, tmp_path):
    rows = spark.range(9000).selectExpr("IF(id < 8000, 'hot', concat('s', id % 20)) AS Site", "id AS n")
    path = tmp_path / "sites"
    writers.write_per_site(rows.repartition(16), str(path), rows_per_file=1000)
    per = {}
    for f in _files(path):
        per[f.split("/")[0]] = per.get(f.split("/")[0], 0) + 1
    assert len(per) == 21 and 8 <= per.pop("Site=hot") <= 16 and set(per.values()) == {1}, per
    assert spark.read.parquet(str(path)).count() == 9000


def test_saved_table_is_bucketed_and_swapped(spark, tmp_path):
    import pytest
    from pyspark.sql import functions as F
    rows = spark.range(400).selectExpr("concat('s', id % 7) AS site", "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, CAST(id AS INT)) AS t",
                                       "CAST(id AS DOUBLE) AS v")
    first = writers.save_table(rows, "sites_saved", "site", "t", str(tmp_path), buckets=4)
    total = spark.sql("SELECT site, sum(v) AS v FROM sites_saved GROUP BY site")
    assert "Exchange" not in total._jdf.queryExecution().executedPlan().toString() and total.count() == 7
    fails = rows.withColumn("v", F.expr("IF(v > 300, CAST(raise_error('no') AS DOUBLE), v)"))
    with pytest.raises(Exception):
        writers.save_table(fails, "sites_saved", "site", "t", str(tmp_path), buckets=4)
    assert spark.table("sites_saved").count() == 400
    second = writers.save_table(rows.filter("v < 100"), "sites_saved", "site", "t", str(tmp_path), buckets=4)
    assert spark.table("sites_saved").count() == 100 and second != first and not spark.catalog.tableExists(first)
    spark.sql("DROP VIEW sites_saved")


def test_extract_reads_only_the_buckets_listed(spark, tmp_path):
    from tidewater.plans.extract import extract_job
    rows = spark.range(6000).selectExpr("concat('u', id % 300) AS uid", "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, CAST(id AS INT)) AS TimeStamp",
                                        "CAST(id AS DOUBLE) AS Value")
    writers.write_lake(rows, str(tmp_path / "lake"), buckets=32)
    lake = spark.read.parquet(str(tmp_path / "lake"))
    manifest = spark.createDataFrame([("u1", "raw", "f"), ("u2", "raw", "g")], "uid string, spec string, folder string")
    specs = spark.createDataFrame([("raw", [])], "spec string, ProcessChain array<struct<Method: string, Interval: string>>")
    found = extract_job(lake, manifest, specs, buckets=32)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString().lower()
    assert sorted(map(str, found.collect())) == sorted(map(str, extract_job(rows, manifest, specs).collect()))
    landed = extract_job(lake, manifest, specs, out=str(tmp_path / "out"), buckets=32)
    assert landed.count() == 40 and {p.name for p in (tmp_path / "out").glob("folder=*")} == {"folder=f", "folder=g"}
    more = spark.createDataFrame([("u3", "raw", "h")], "uid string, spec string, folder string")
    assert extract_job(lake, more, specs, out=str(tmp_path / "out"), buckets=32).count() == 20
    assert {p.name for p in (tmp_path / "out").glob("folder=*")} == {"folder=f", "folder=g", "folder=h"}


def test_order_of_a_file_in_splits(spark, tmp_path):
    import random
    from tidewater.sources.report_csv import report_order
    rng, want = random.Random(6), {}
    (tmp_path / "f").mkdir()
    for name in ("a.csv", "b.csv", "c.csv"):
        hours = [rng.randrange(400) if name != "c.csv" else k for k in range(350)]
        lines = ["preamble"] * 11 + ["TimeStamp,Flow@X"] + [f"{datetime(2024, 1, 1) + timedelta(hours=h)},{h}" for h in hours]
        (tmp_path / "f" / name).write_text("\n".join(lines) + "\n")
        want[name] = sum(x > y for x, y in zip(hours, hours[1:]))
    assert want.pop("c.csv") == 0
    for size in ("128m", "1k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            assert {r["CSV"]: r["out_of_order"] for r in report_order(spark, str(tmp_path)).collect()} == want
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
