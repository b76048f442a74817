"""hourly_2_daily, ts_info and data_range_summary contracts."""

from datetime import datetime, timedelta

import pytest

from conftest import ts
from tidewater.operators.daily import hourly_2_daily
from tidewater.operators.info import ts_info
from tidewater.operators.summary import data_range_summary

SCHEMA = "site string, t timestamp_ntz, v double"


def hours(start, n, site="a", value=1.0):
    b = datetime.fromisoformat(start)
    return [(site, b + timedelta(hours=i), value) for i in range(n)]


def test_arguments_checked(spark):
    df = spark.createDataFrame(hours("2024-01-01 01:00", 24), SCHEMA)
    with pytest.raises(ValueError):
        hourly_2_daily(df, ["site"], "t", "v", day_starts_at=24)
    with pytest.raises(ValueError):
        hourly_2_daily(df, ["site"], "t", "v", prop=1.5)


def test_full_day_end_labelled(spark):
    # hours 01:00 .. 00:00 next day form exactly one day
    df = spark.createDataFrame(hours("2024-01-01 01:00", 24), SCHEMA)
    out = hourly_2_daily(df, ["site"], "t", "v").collect()
    assert [(str(r["Date"]), r["Agg_mean"]) for r in out] == [("2024-01-01", 1.0)]


def test_midnight_belongs_to_previous_day(spark):
    df = spark.createDataFrame([("a", ts("2024-01-02 00:00"), 5.0)], SCHEMA)
    out = hourly_2_daily(df, ["site"], "t", "v", prop=0.0).collect()
    assert [str(r["Date"]) for r in out] == ["2024-01-01"]


def test_nine_am_day(spark):
    # day D runs (D 09:00, D+1 09:00]
    rows = hours("2024-01-01 10:00", 24)
    df = spark.createDataFrame(rows, SCHEMA)
    out = hourly_2_daily(df, ["site"], "t", "v", day_starts_at=9).collect()
    assert [str(r["Date"]) for r in out] == ["2024-01-01"]


def test_coverage_and_padding(spark):
    # day 2 is half covered; surviving days 1, 3, 4 have a one-day step,
    # so day 2 comes back as a NULL row
    rows = hours("2024-01-01 01:00", 24) + hours("2024-01-02 01:00", 12, value=3.0) + \
        hours("2024-01-03 01:00", 24, value=2.0) + hours("2024-01-04 01:00", 24, value=4.0)
    df = spark.createDataFrame(rows, SCHEMA)
    full = sorted(hourly_2_daily(df, ["site"], "t", "v", prop=1.0).collect(), key=lambda r: r["Date"])
    assert [(str(r["Date"]), r["Agg_mean"]) for r in full] == [
        ("2024-01-01", 1.0), ("2024-01-02", None), ("2024-01-03", 2.0), ("2024-01-04", 4.0)]
    half = hourly_2_daily(df, ["site"], "t", "v", prop=0.5, agg="sum").collect()
    assert sorted(r["Agg_sum"] for r in half) == [24.0, 36.0, 48.0, 96.0]
    # only day 1 is fully covered before 2024-01-03 12:00: a single row
    two = hourly_2_daily(df.filter("t < '2024-01-03 12:00'"), ["site"], "t", "v", prop=1.0).collect()
    assert sorted(str(r["Date"]) for r in two) == ["2024-01-01"]


def test_callable_agg_name(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(hours("2024-01-01 01:00", 24), SCHEMA)

    def peak(c):
        return F.max(c)
    out = hourly_2_daily(df, ["site"], "t", "v", agg=peak)
    assert "Agg_peak" in out.columns


def test_ts_info_regular_and_all_null_site(spark):
    rows = hours("2024-01-01 00:00", 48) + [("b", ts("2024-01-01 00:00"), None)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = {r["site"]: r for r in ts_info(df, "site", "t", "v").collect()}
    a = out["a"]
    step_day = 1 / 24
    assert abs(a["Length_yr"] - (47 / 24 + step_day) / 365.2422) < 1e-12
    assert abs(a["Completion_%"] - 100.0) < 1e-9
    assert out["b"]["Start"] is None and out["b"]["Completion_%"] is None


def test_ts_info_irregular_has_no_completion(spark):
    b = datetime(2024, 1, 1)
    rows = [("a", b + timedelta(seconds=s), 1.0) for s in (0, 100, 250)]
    out = ts_info(spark.createDataFrame(rows, SCHEMA), "site", "t", "v")
    assert "Completion_%" not in out.columns


def test_summary_tie_takes_earliest(spark):
    rows = [("a", ts("2024-01-01 03:00"), 1.0), ("a", ts("2024-01-01 01:00"), 1.0),
            ("a", ts("2024-01-01 02:00"), 5.0), ("a", ts("2024-01-01 04:00"), 5.0),
            ("a", ts("2024-01-01 05:00"), None)]
    df = spark.createDataFrame(rows, SCHEMA)
    r = data_range_summary(df, ["site"], "t", "v", attrs=()).collect()[0]
    assert r["Time_min"] == ts("2024-01-01 01:00") and r["Time_max"] == ts("2024-01-01 02:00")
    assert r["End"] == ts("2024-01-01 04:00")
