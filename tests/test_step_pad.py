"""Contracts of ts_step / is_ts_daily / na_ts_insert (hand-made series)."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import d, ts
from tidewater.operators.pad import na_ts_insert
from tidewater.operators.step import is_ts_daily, step_table, ts_step

SCHEMA = "site string, t timestamp_ntz, v double"
DSCHEMA = "site string, t date, v double"


def steps(spark, rows, schema=SCHEMA, **kw):
    df = spark.createDataFrame(rows, schema)
    return {r["site"]: r["step_s"] for r in ts_step(df, ["site"], "t", ["v"], **kw).collect()}


def test_regular_gap_and_padding(spark):
    rows = [("a", ts("2024-01-01 00:00"), 1.0), ("a", ts("2024-01-01 01:00"), 2.0),
            ("a", ts("2024-01-01 03:00"), 3.0)]
    assert steps(spark, rows) == {"a": 3600}
    out = na_ts_insert(spark.createDataFrame(rows, SCHEMA), ["site"], "t", ["v"]).collect()
    got = sorted((r["t"], r["v"]) for r in out)
    assert got == [(ts("2024-01-01 00:00"), 1.0), (ts("2024-01-01 01:00"), 2.0),
                   (ts("2024-01-01 02:00"), None), (ts("2024-01-01 03:00"), 3.0)]


def test_min_not_gcd(spark):
    base = ts("2024-01-01 00:00")
    rows = [("a", base + timedelta(seconds=s), 1.0) for s in (0, 120, 300)]
    assert steps(spark, rows) == {"a": -1}


def test_sub_minute_gap_is_irregular(spark):
    base = ts("2024-01-01 00:00")
    rows = [("a", base + timedelta(seconds=s), 1.0) for s in (0, 30, 3600)]
    assert steps(spark, rows) == {"a": -1}
    # R dialect ignores gaps under the threshold
    assert steps(spark, rows, ignore_subthreshold=True) == {"a": 3570}


def test_one_row_and_empty(spark):
    rows = [("one", ts("2024-01-01 00:00"), 1.0), ("empty", ts("2024-01-01 00:00"), None),
            ("empty", ts("2024-01-01 01:00"), float("nan"))]
    assert steps(spark, rows) == {"one": None, "empty": None}
    out = na_ts_insert(spark.createDataFrame(rows, SCHEMA), ["site"], "t", ["v"]).collect()
    assert [(r["site"], r["v"]) for r in out] == [("one", 1.0)]


def test_two_day_dates(spark):
    rows = [("a", d("2024-01-01"), 1.0), ("a", d("2024-01-03"), 2.0), ("a", d("2024-01-05"), 3.0)]
    assert steps(spark, rows, DSCHEMA) == {"a": 172800}
    out = na_ts_insert(spark.createDataFrame(rows, DSCHEMA), ["site"], "t", ["v"]).collect()
    assert len(out) == 3


def test_uneven_dates_not_padded(spark):
    rows = [("a", d("2024-01-01"), 1.0), ("a", d("2024-01-03"), 2.0), ("a", d("2024-01-06"), 3.0)]
    assert steps(spark, rows, DSCHEMA) == {"a": -1}
    out = na_ts_insert(spark.createDataFrame(rows, DSCHEMA), ["site"], "t", ["v"]).collect()
    assert len(out) == 3


def test_empty_edges_removed_interior_kept(spark):
    vals = [None, 1.0, 2.0, None, 3.0, None]
    rows = [("a", ts("2024-01-01 0%d:00" % h), v) for h, v in enumerate(vals)]
    out = sorted(na_ts_insert(spark.createDataFrame(rows, SCHEMA), ["site"], "t", ["v"]).collect(),
                 key=lambda r: r["t"])
    assert [(r["t"].hour, r["v"]) for r in out] == [(1, 1.0), (2, 2.0), (3, None), (4, 3.0)]


def test_partly_null_wide_rows_kept(spark):
    df = spark.createDataFrame([(ts("2024-01-01 00:00"), 1.0, None), (ts("2024-01-01 01:00"), None, 2.0),
                                (ts("2024-01-01 03:00"), 3.0, 3.0)], "t timestamp_ntz, x double, y double")
    out = na_ts_insert(df, [], "t").collect()
    assert len(out) == 4
    assert sum(1 for r in out if r["x"] is None and r["y"] is None) == 1


def test_is_ts_daily(spark):
    daily = [("a", ts("2024-01-0%d 00:00" % i), 1.0) for i in range(1, 5)]
    nine = [("b", ts("2024-01-0%d 09:00" % i), 1.0) for i in range(1, 5)]
    df = spark.createDataFrame(daily + nine, SCHEMA)
    got = {r["site"]: r["is_daily"] for r in is_ts_daily(df, ["site"], "t", ["v"]).collect()}
    assert got == {"a": True, "b": False}


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=400), min_size=2, max_size=60, unique=True),
       st.sampled_from([60, 120, 3600]))
def test_chunked_step_equals_single_chunk(spark, offsets, unit):
    """Stitching many tiny chunks gives the same step as one chunk per series."""
    base = datetime(2020, 1, 1)
    rows = [("a", base + timedelta(seconds=o * unit), 1.0) for o in offsets]
    df = spark.createDataFrame(rows, SCHEMA)
    one = step_table(df, ["site"], "t", ["v"], parts=1).df.collect()[0]["step_s"]
    many = step_table(df, ["site"], "t", ["v"], parts=9).df.collect()[0]["step_s"]
    srt = sorted(offsets)
    diffs = [(b - a) * unit for a, b in zip(srt, srt[1:])]
    m = min(diffs)
    expect = m if m >= 60 and all(x % m == 0 for x in diffs) else -1
    assert one == many == expect


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=200), min_size=2, max_size=40, unique=True))
def test_padding_properties(spark, offsets):
    base = datetime(2021, 6, 1)
    rows = [("a", base + timedelta(hours=o), float(o)) for o in offsets]
    df = spark.createDataFrame(rows, SCHEMA)
    out = na_ts_insert(df, ["site"], "t", ["v"], points_per_piece=7).collect()
    present = {r["t"]: r["v"] for r in out if r["v"] is not None}
    assert present == {t: v for _, t, v in rows}          # non-null rows untouched
    srt = sorted(offsets)
    diffs = [b - a for a, b in zip(srt, srt[1:])]
    m = min(diffs)
    if all(x % m == 0 for x in diffs):
        assert len(out) == (srt[-1] - srt[0]) // m + 1     # full grid
        again = na_ts_insert(spark.createDataFrame([("a", r["t"], r["v"]) for r in out], SCHEMA),
                             ["site"], "t", ["v"]).collect()
        assert len(again) == len(out)                        # idempotent
    else:
        assert len(out) == len(offsets)


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_readings_are_read_once_in_ranges(spark):
    """Times are range-partitioned on (series, time), and the step needs no second look at the readings."""
    from tidewater.operators import step as S
    df = spark.range(50).selectExpr("IF(id < 0, 'b', 'a') AS site", "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, CAST(id AS INT), 0) AS t",
                                    "CAST(id AS DOUBLE) AS v")
    chunks = S.chunk_table(df, ["site"], "t", ["v"], parts=3)
    assert "rangepartitioning(site" in plan_of(chunks)
    assert [r["holes"] for r in chunks.collect()] == [[]] * chunks.count()
    seen = spark.sparkContext.accumulator(0)
    counted = df.mapInArrow(lambda batches: (seen.add(b.num_rows) or b for b in batches), df.schema)
    assert [r["step_s"] for r in S.ts_step(counted, ["site"], "t", ["v"]).collect()] == [60]
    assert seen.value == 50


def test_chunk_rows_whatever_the_batches(spark):
    """The table is the same if the readings come in batches of a few rows."""
    rng_rows = [(f"s{k % 3}", None if k % 11 == 0 else (k * 7919) % 500 * 60, 1.0 if k % 5 else None) for k in range(400)]
    df = spark.createDataFrame([(a, m, v) for a, m, v in rng_rows], "site string, m long, v double").selectExpr(
        "IF(site = 's2', NULL, site) AS site", "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, CAST(m AS DECIMAL(18, 6))) AS t", "v")
    want = sorted(map(str, step_table(df, ["site"], "t", ["v"], parts=1).df.collect()))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for parts in (1, 5):
            assert sorted(map(str, step_table(df, ["site"], "t", ["v"], parts=parts).df.collect())) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 30)), min_size=1, max_size=40), st.sampled_from([1, 3]))
def test_holes_equal_the_grid_join(spark, points, parts):
    """Padding by holes gives what the join with the whole grid gives."""
    from tidewater.operators import pad as P
    df = spark.createDataFrame([(s, m, float(m)) for s, m in points], "site string, m long, v double").selectExpr(
        "site", "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, CAST(m * IF(site = 'a', 1, 5) AS INT), 0) AS t", "v")
    table = step_table(df, ["site"], "t", ["v"], parts=parts)
    by_grid = P._on_grid(df, table, ["site"], "t", ["v"], False, 7)
    kept = P.step_table
    P.step_table = lambda *a, **k: step_table(*a, **k, parts=parts)
    try:
        by_holes = na_ts_insert(df, ["site"], "t", ["v"], points_per_piece=7)
    finally:
        P.step_table = kept
    assert sorted(map(str, by_holes.collect())) == sorted(map(str, by_grid.collect()))


def test_a_series_read_at_two_rates_is_padded(spark):
    """Daily for a while, then hourly: the daily part has no two neighbouring points of the grid."""
    df = spark.range(40).selectExpr("'a' AS site", "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval("
                                    "0, CAST(IF(id < 20, 24 * id, 24 * 19 + id - 19) AS INT), 0, 0) AS t", "1.0 AS v")
    df = df.unionByName(df.filter("t < TIMESTAMP_NTZ'2024-01-10 00:00:00'").withColumn("site", F.lit("b")))
    out = na_ts_insert(df, ["site"], "t", ["v"])
    n = {r["site"]: (r["count"], r["there"]) for r in out.groupBy("site").agg(F.count("*").alias("count"), F.count("v").alias("there")).collect()}
    assert n == {"a": (24 * 19 + 21, 40), "b": (9, 9)}


def test_a_long_hole_is_spread_over_tasks(spark):
    """Ten million missing points between two readings come from many tasks; the readings are not moved."""
    df = spark.createDataFrame([("a", ts("2024-01-01 00:00"), 1.0), ("a", ts("2024-01-01 00:01"), 2.0)], SCHEMA)
    df = df.unionByName(spark.sql("SELECT 'a' AS site, TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, 10000001, 0) AS t, 3.0D AS v"))
    out = na_ts_insert(df, ["site"], "t", ["v"])
    per_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 10_000_002 and len([n for n in per_task if n > 1_000_000]) > 2
    assert "Outer" not in out._jdf.queryExecution().executedPlan().toString()


def test_validate_order_check_stitches_chunks(spark):
    from tidewater.operators.validate import ts_validate
    import random
    rnd = random.Random(7)
    base = datetime(2024, 1, 1)
    rows = [("a", i, base + timedelta(minutes=rnd.randint(0, 500)), 1.0) for i in range(300)]
    df = spark.createDataFrame(rows, "site string, seq long, t timestamp_ntz, v double")
    want = sum(1 for (_, _, a, _), (_, _, b, _) in zip(rows, rows[1:]) if b < a)

    def bad(k):
        out = ts_validate(df, ["site"], "t", seq="seq", seq_per_chunk=k).collect()
        return {r["check"]: r["n"] for r in out}.get("out_of_order")
    assert bad(1) == bad(1_000_000) == want


def test_forced_daily_padding_r_dialect(spark):
    rows = [("a", d("2024-01-01"), 1.0), ("a", d("2024-01-03"), 2.0), ("a", d("2024-01-06"), 3.0)]
    df = spark.createDataFrame(rows, DSCHEMA)
    out = na_ts_insert(df, ["site"], "t", ["v"], step_s=86400).collect()
    assert len(out) == 6 and sum(r["v"] is None for r in out) == 3


def test_summary_null_rules(spark):
    from tidewater.operators.summary import data_range_summary
    rows = [("a", ts("2024-01-01 00:00"), 1.0, None), ("a", ts("2024-01-01 01:00"), 2.0, "m")]
    df = spark.createDataFrame(rows, "site string, t timestamp_ntz, v double, Unit string")
    r_value = data_range_summary(df, ["site"], "t", "v", attrs=("Unit",)).collect()[0]
    r_any = data_range_summary(df, ["site"], "t", "v", attrs=("Unit",), null_rule="any").collect()[0]
    assert (r_value["Min"], r_value["Start"]) == (1.0, ts("2024-01-01 00:00"))
    assert (r_any["Min"], r_any["Start"]) == (2.0, ts("2024-01-01 01:00"))


def chunk_sizes(df, parts):
    """Rows of the largest (series, chunk) of the distinct times."""
    from pyspark.sql import functions as F
    times = df.selectExpr("site", "unix_micros(CAST(t AS TIMESTAMP)) AS __t").distinct()
    sized = times.repartitionByRange(parts, "site", "__t").withColumn("p", F.spark_partition_id())
    return [r["count"] for r in sized.groupBy("site", "p").count().collect()]


def test_hot_series_and_distinct_gaps_stay_bounded(spark):
    """One irregular series with 60,000 different gaps: chunks are even, and the step is right."""
    df = spark.range(60_000).selectExpr(
        "'a' AS site", "TIMESTAMP_NTZ'2000-01-01 00:00:00' + make_dt_interval(0, 0, 0, CAST(60 * id + id * (id - 1) / 2e5 AS DECIMAL(18, 6))) AS t",
        "1.0 AS v")
    sizes = chunk_sizes(df, 8)
    assert sum(sizes) == 60_000 and max(sizes) < 3 * 60_000 / 8
    assert [r["step_s"] for r in ts_step(df, ["site"], "t", ["v"]).collect()] == [-1]


def test_flood_of_equal_times_is_one_row(spark):
    df = spark.range(50_000).selectExpr(
        "'a' AS site", "TIMESTAMP_NTZ'2000-01-01 00:00:00' + make_dt_interval(0, CAST(greatest(id - 49990, 0) AS INT), 0, 0) AS t", "1.0 AS v")
    assert max(chunk_sizes(df, 4)) <= 10
    r = step_table(df, ["site"], "t", ["v"]).df.collect()[0]
    assert (r["n"], r["step_s"]) == (50_000, 3600)


@pytest.mark.parametrize("zone", ["America/New_York", "Pacific/Auckland"])
def test_session_time_zone_does_not_enter(spark, zone):
    """Hours that a spring change skips are ordinary hours of a wall-clock series."""
    from tidewater.operators.daily import hourly_2_daily
    from tidewater.operators.info import ts_info
    from tidewater.operators.resample import resample
    hours = spark.range(24 * 365).selectExpr(
        "'a' AS site", "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, CAST(id AS INT), 0, 0) AS t", "CAST(id AS DOUBLE) AS v")
    half = spark.range(200).selectExpr(
        "'b' AS site", "TIMESTAMP_NTZ'2024-01-01 02:30:00' + make_dt_interval(CAST(id AS INT), 0, 0, 0) AS t", "CAST(id AS DOUBLE) AS v")

    def results():
        gaps = hours.filter("pmod(v, 50) <> 3").unionByName(half.filter("v <> 77"))
        return [sorted(map(tuple, x.collect())) for x in (
            ts_step(gaps, ["site"], "t", ["v"]),
            na_ts_insert(gaps, ["site"], "t", ["v"]).selectExpr("site", "cast(t AS string)", "coalesce(v, -1)"),
            resample(hours, ["site"], "t", "v", "hour", "mean").selectExpr("site", "cast(t AS string)", "v"),
            resample(hours, ["site"], "t", "v", "day", "sum", label="end").selectExpr("site", "cast(t AS string)", "v"),
            hourly_2_daily(hours, ["site"], "t", "v", prop=0.5).selectExpr("site", "cast(Date AS string)", "Agg_mean"),
            ts_info(half, "site", "t", "v").selectExpr("site", "cast(End AS string)", "Length_yr"))]

    want = results()
    assert want[0] == [("a", 3600), ("b", 86400)] and len(want[2]) == 24 * 365
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert results() == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_dotted_names(spark):
    from tidewater.operators.clean import trim_ts
    from tidewater.operators.reshape import ts_melt, unpivot_long
    df = spark.createDataFrame([(ts("2024-01-01 00:00"), 1.0, None), (ts("2024-01-01 01:00"), None, None),
                                (ts("2024-01-01 03:00"), 2.0, 5.0)], "t timestamp_ntz, `St. Arnaud` double, b double")
    assert trim_ts(df).columns == ["t", "St. Arnaud", "b"] and trim_ts(df).count() == 2
    assert unpivot_long(df).count() == 3
    assert ts_melt(df).filter("Site = 'St. Arnaud'").count() == 2


def test_padding_join_is_hashed_on_series_and_time(spark):
    """The grid join shuffles on (series, time), so a hot series spreads over all tasks."""
    import re
    rows = [("a", ts("2024-01-01 00:00"), 1.0), ("a", ts("2024-01-01 02:00"), 2.0)]
    out = na_ts_insert(spark.createDataFrame(rows, SCHEMA), ["site"], "t", ["v"], step_s=3600)
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "FullOuter" in plan or "full" in plan.lower()
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString()
    parts = re.findall(r"hashpartitioning\(([^)]*)\)", final)
    assert any("__g0" in p and "__g1" in p for p in parts), parts


def test_validate_schema_checks(spark):
    from tidewater.operators.validate import ts_validate
    bad = spark.createDataFrame([("a", ts("2024-01-01 00:00"), ts("2024-01-02 00:00"), "x")],
                                "site string, t1 timestamp_ntz, t2 timestamp_ntz, note string")
    checks = {r["check"] for r in ts_validate(bad, ["site"]).collect()}
    assert {"many_temporal_columns", "non_numeric_column"} <= checks
    dup = spark.createDataFrame([("a", ts("2024-01-01 00:00"), 1.0), ("a", ts("2024-01-01 00:00"), 2.0),
                                 ("b", ts("2024-01-01 00:00"), 1.0)], SCHEMA)
    got = {(r["site"], r["check"]): r["n"] for r in ts_validate(dup, ["site"], "t").collect()}
    assert got == {("a", "duplicate_times"): 1}


def test_is_ts_daily_on_dates(spark):
    rows = [("a", d("2024-01-01"), 1.0), ("a", d("2024-01-04"), 1.0)]
    got = is_ts_daily(spark.createDataFrame(rows, DSCHEMA), ["site"], "t", ["v"]).collect()
    assert [(r["site"], r["is_daily"]) for r in got] == [("a", True)]
