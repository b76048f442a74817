"""Report files in the reference layout (root/<folder>/<file>) -> long table, gate, wide."""

import os

import pytest

from conftest import ts
from tidewater.operators.joins import enrich
from tidewater.plans.organise import long_table, organise_folder
from tidewater.sources.dims import dim_from_catalog, dim_from_csv, dim_from_json_map
from tidewater.sources.report_csv import report_csv_scan, report_files


def report(path, uid, param, label, plate, desc, rows):
    pre = [f"Preamble {i}" for i in range(1, 12)]
    pre[7] = f"# {uid} {param}.{label}@{plate}: {desc}"
    lines = pre + [f"TimeStamp,{param}@{plate}"] + [f"{t},{v}" for t, v in rows]
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


UID1 = "0a0a0a0a-1b1b-2c2c-3d3d-4e4e4e4e4e4e"
UID2 = "5f5f5f5f-6a6a-7b7b-8c8c-9d9d9d9d9d9d"
UID3 = "11111111-2222-3333-4444-555555555555"
UID4 = "aaaaaaaa-bbbb-cccc-dddd-eeeeeeeeeeee"


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    r = str(tmp_path_factory.mktemp("out") / "csv")
    hourly = [(f"2024-01-01 0{h}:00:00", v) for h, v in enumerate(["1.5", "", "2.5", "NaN", "4"])]
    report(f"{r}/dFlo/{UID1.replace('-', '')}.csv", UID1, "Discharge", "Master", "AA100",
           "River at bridge: gauge, upstream", hourly)
    report(f"{r}/dFlo/second.csv", UID2, "Discharge", "Master", "BB200", "Other site", hourly)
    report(f"{r}/dQual/abs", UID3, "Colour @ dusk", "Lab", "BB200", "Lab data",
           [("2024-01-01 00:00:00", "0.1"), ("2024-01-03 00:00:00", "0.3")])
    report(f"{r}/dQual/empty.csv", UID4, "Colour @ dusk", "Lab", "ZZ1", "no rows", [])
    report(f"{r}/dup/a.csv", UID1, "Discharge", "Master", "AA100", "a", hourly)
    report(f"{r}/dup/b.csv", UID2, "Discharge", "Copy", "AA100", "b", hourly)
    os.makedirs(f"{r}/emptyfolder", exist_ok=True)
    return r


@pytest.fixture(scope="module")
def dims(spark):
    plates = spark.createDataFrame([("AA100", "Flow A"), ("BB200", "Flow B")], "Plate string, Name string")
    params = spark.createDataFrame([("Discharge", "m^3/s"), ("Colour @ dusk", "None")],
                                   "Parameter string, Unit string")
    return params, plates


def test_headers(spark, root):
    h = {(r["folder"], r["CSV"]): r for r in report_files(spark, root).collect()}
    a = h[("dFlo", UID1.replace("-", "") + ".csv")]
    assert (a["Parameter"], a["Plate"], a["Label"], a["uid"]) == \
        ("Discharge", "AA100", "Master", UID1.replace("-", ""))
    assert a["Description"] == "River at bridge: gauge, upstream"
    assert a["ts_id"] == "Discharge.Master@AA100"
    q = h[("dQual", "abs")]  # no extension, parameter with '@' and blanks
    assert (q["Parameter"], q["Plate"], q["Label"]) == ("Colour @ dusk", "BB200", "Lab")
    assert ("dQual", "empty.csv") in h


def test_long_table_keeps_nulls_and_tags(spark, root, dims):
    params, plates = dims
    long = report_csv_scan(spark, root, params, plates)
    rows = long.filter("folder = 'dFlo' AND Plate = 'AA100'").collect()
    assert len(rows) == 5
    vals = sorted((r["TimeStamp"], r["Value"]) for r in rows)
    assert vals[1] == (ts("2024-01-01 01:00"), None) and vals[3] == (ts("2024-01-01 03:00"), None)
    assert {r["Unit"] for r in rows} == {"m^3/s"} and {r["Name"] for r in rows} == {"Flow A"}
    q = long.filter("folder = 'dQual'").collect()
    assert {r["Unit"] for r in q} == {"None"}  # the text "None" is a unit, not a null


def test_gate_and_wide(spark, root, dims):
    params, plates = dims
    res = organise_folder(spark, root, params, plates)
    gate = {r["folder"]: r for r in res.gate.collect()}
    assert gate["dFlo"]["eligible"] and gate["dFlo"]["step_s"] == 3600
    assert gate["dup"]["reason"] == "duplicate_site" and gate["dup"]["n_dup_files"] == 2
    from tidewater.operators.gate import duplicate_files
    assert sorted(r["CSV"] for r in duplicate_files(res.long).filter("folder = 'dup'").collect()) == ["a.csv", "b.csv"]
    assert gate["dQual"]["reason"] == "duplicate_site"   # a file without rows counts as a file
    w = res.wide("dFlo").collect()
    assert sorted(c for c in res.wide("dFlo").columns) == ["Flow A", "Flow B", "Time"]
    # 01:00 and 03:00 are empty for every site: trimmed, step re-inferred as 2 h
    assert len(w) == 3
    s = {r["ts_id"]: r for r in res.summary.filter("folder = 'dFlo'").collect()}
    r = s["Discharge.Master@AA100"]
    assert (r["Min"], r["Max"], r["Time_max"]) == (1.5, 4.0, ts("2024-01-01 04:00"))


def test_sql_dialect(spark, root, dims):
    params, plates = dims
    long, summary = long_table(spark, root, params, plates)
    got = long.filter("folder = 'dFlo'").collect()
    assert len(got) == 6  # NULL readings dropped, ".csv" files only
    assert {r["uid"] for r in got} == {UID1.replace("-", ""), "second"}
    assert long.filter("folder = 'dQual'").count() == 0  # "abs" has no .csv suffix


def test_dimensions(spark, tmp_path):
    p = tmp_path / "param.json"
    p.write_text('{"1,4-Dioxane": "mg/m^3", "Colour @ dusk": "None", "pH": "pH Units"}')
    d = {r["Parameter"]: r["Unit"] for r in dim_from_json_map(spark, str(p), "Parameter", "Unit").collect()}
    assert d == {"1,4-Dioxane": "mg/m^3", "Colour @ dusk": "None", "pH": "pH Units"}
    c = tmp_path / "param.csv"
    c.write_text('Param,Unit\n"1,4-Dioxane",mg/m^3\npH,pH Units\n')
    got = dim_from_csv(spark, str(c), {"Param": "Parameter"}).collect()
    assert {(r["Parameter"], r["Unit"]) for r in got} == {("1,4-Dioxane", "mg/m^3"), ("pH", "pH Units")}
    j = tmp_path / "cat.json"
    j.write_text('{"LocationDescriptions": [{"Identifier": "A", "Name": "x"}, {"Identifier": "A", "Name": "y"},'
                 ' {"Identifier": "B", "Name": "z"}]}')
    assert dim_from_catalog(spark, str(j), "LocationDescriptions", "Identifier", "Name").count() == 3
    last = {r["Identifier"]: r["Name"] for r in
            dim_from_catalog(spark, str(j), "LocationDescriptions", "Identifier", "Name", keep="last").collect()}
    assert last == {"A": "y", "B": "z"}


def test_enrich_is_broadcast(spark):
    big = spark.range(100).selectExpr("id", "cast(id % 3 as string) AS k")
    dim = spark.createDataFrame([("0", "zero"), ("1", "one")], "k string, name string")
    out = enrich(big, dim, "k")
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    assert out.filter("name IS NULL").count() == 33


def test_organise_writes_outputs(spark, root, dims, tmp_path):
    params, plates = dims
    out = str(tmp_path / "out")
    organise_folder(spark, root, params, plates, out=out)
    long = spark.read.parquet(f"{out}/long")
    assert dict(long.dtypes)["TimeStamp"] == "string"
    assert {r["folder"] for r in long.select("folder").distinct().collect()} == {"dFlo", "dQual", "dup"}
    wide = spark.read.parquet(f"{out}/dFlo_wide")
    assert wide.columns[0] == "Time" and dict(wide.dtypes)["Time"] == "string" and wide.count() == 3
    tsv = spark.read.option("sep", "\t").option("header", True).csv(f"{out}/data_range")
    assert "Time_max" in tsv.columns and tsv.count() == 5


def test_long_table_writes_outputs(spark, root, dims, tmp_path):
    params, plates = dims
    out = str(tmp_path / "db")
    long_table(spark, root, params, plates, out=out)
    df = spark.read.parquet(f"{out}/df_long")
    assert df.count() == 12 and dict(df.dtypes)["TimeStamp"] == "string"


def test_missing_and_empty_roots(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        report_csv_scan(spark, str(tmp_path / "nope"))
    (tmp_path / "only_empty" / "f1").mkdir(parents=True)
    assert report_csv_scan(spark, str(tmp_path / "only_empty")).count() == 0


def test_concat_frames_fills_missing_columns(spark):
    from tidewater.operators.reshape import concat_frames
    a = spark.createDataFrame([(1, 2.0)], "k int, x double")
    b = spark.createDataFrame([(2, 3.0)], "k int, y double")
    rows = sorted(concat_frames(a, b).collect())
    assert [tuple(r) for r in rows] == [(1, 2.0, None), (2, None, 3.0)]


def test_unreadable_lines_are_rejected_not_lost(spark, tmp_path):
    from tidewater.sources.report_csv import report_rejects
    r = str(tmp_path / "csv")
    report(f"{r}/f/bad.csv", UID1, "Discharge", "Raw", "AA100", "x", [
        ("2024-01-01 00:00:00.500", "1"), ("2024-01-01T01:00:00", "2"), ("2024-01-02", "3"),
        ("2024-01-01 02:00:00", "abc"), ("2024-01-01 99:00:00", "5"), ("2024-01-03 00:00:00", "nan")])
    report(f"{r}/f/other.txt", UID2, "Level", "Raw", "BB200", "x", [("2024-01-01 00:00:00", "7")])
    with open(f"{r}/f/other.txt") as f:
        text = f.read().replace("TimeStamp,", "Zeit,")
    with open(f"{r}/f/other.txt", "w") as f:
        f.write(text)
    with open(f"{r}/f/headless", "w") as f:
        f.write("2024-01-01 00:00:00,9\n")
    with pytest.raises(ValueError, match="report_rejects"):
        report_csv_scan(spark, r)
    got = sorted((x["CSV"], x["reason"]) for x in report_rejects(spark, r).collect())
    assert got == [("bad.csv", "bad time"), ("bad.csv", "bad value"), ("headless", "no header line")]
    long = report_csv_scan(spark, r, on_reject="keep").collect()
    assert sorted((x["CSV"], x["Value"]) for x in long if x["Value"] is not None) == [
        ("bad.csv", 1.0), ("bad.csv", 2.0), ("bad.csv", 3.0), ("headless", 9.0), ("other.txt", 7.0)]
    assert {x["Plate"] for x in long if x["CSV"] == "other.txt"} == {"BB200"}


def test_lookup_does_not_depend_on_row_order(spark):
    df = spark.createDataFrame([("p",)], "Plate string")
    rows = [("p", "A"), ("p", "B")]
    for order in (rows, rows[::-1]):
        dim = spark.createDataFrame(order, "Plate string, Name string").coalesce(1)
        assert [r["Name"] for r in enrich(df, dim, "Plate").collect()] == ["B"]


def test_wide_names_are_grouped_not_refused(spark):
    from tidewater.operators.reshape import name_groups
    assert [len(g) for g in name_groups([f"n{i}" for i in range(2_500)])] == [1_000, 1_000, 500]


def test_quantiles_are_exact(spark):
    import numpy as np
    from tidewater.operators.summary import quantiles
    rng = np.random.default_rng(3)
    data = {k: rng.integers(0, 40, n).astype(float) for k, n in (("a", 1), ("b", 2), ("c", 501))}
    df = spark.createDataFrame([(k, float(v)) for k, vs in data.items() for v in vs], "k string, v double")
    got = {r["k"]: (r["lo"], r["hi"]) for r in quantiles(df, ["k"], "v", {"lo": 0.25, "hi": 0.9}, parts=5).collect()}
    for k, vs in data.items():
        assert got[k] == pytest.approx((np.quantile(vs, 0.25), np.quantile(vs, 0.9)))


@pytest.mark.parametrize("daily", [False, True])
def test_wide_parts_joined_are_the_one_table(spark, monkeypatch, daily):
    """Each part has the step, extent and times of the folder, whatever its own sites have."""
    from functools import reduce

    from tidewater.plans import organise
    unit = "DAY" if daily else "MINUTE"
    at = {"even": {"A": [0, 1, 2, 5], "B": [2, 4, 6], "C": [3], "D": []}, "uneven": {"A": [0, 7], "B": [0, 30, 61], "C": [7]}}
    rows = [(f, s if s != "B" else None, s, t, float(t)) for f, sites in at.items() for s, times in sites.items() for t in times]
    rows += [("even", "D", "D", 8, None), ("even", "A", "A", 9, None), ("even", "A", "A", 3, float("nan"))]
    long = spark.createDataFrame(rows, "folder string, Name string, Plate string, t int, Value double").selectExpr(
        "folder", "Name", "Plate", f"TIMESTAMP_NTZ'2024-03-01 00:00:00' + t * INTERVAL '1' {unit} AS TimeStamp", "Value")
    res = organise.Organised(long, None, None, None, [(f, daily) for f in at])
    ts = "Date" if daily else "Time"
    monkeypatch.setattr(organise, "name_groups", lambda names: [[n] for n in names])
    for folder, length in (("even", 7), ("uneven", 4)):
        one, parts = res.wide(folder), res.wide_parts(folder)
        assert len(parts) == len(at[folder]) and [p.count() for p in parts] == [length] * len(parts)
        joined = reduce(lambda a, b: a.join(b, ts, "full"), parts)
        assert joined.dtypes == one.dtypes
        assert sorted(map(tuple, joined.collect()), key=lambda r: r[0]) == sorted(map(tuple, one.collect()), key=lambda r: r[0])
