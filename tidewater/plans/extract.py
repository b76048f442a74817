"""M1 ``extract_job`` and M2 ``long_record_filter``.

M1 replaces "download these series with this report spec into that folder"
by a selection over readings already in the lake: a broadcast join with the
manifest (bounded list of ids) tags each reading with its spec and folder,
and every spec's process chain is applied in one pass (``apply_specs``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import US_PER_DAY
from ..operators.joins import sized_broadcast
from ..operators.info import DAYS_PER_YEAR
from ..operators.resample import apply_specs
from ..operators.step import step_table
from ..sinks import writers


def extract_job(readings: DataFrame, manifest: DataFrame, specs: DataFrame,
                key: str = "uid", ts: str = "TimeStamp", value: str = "Value",
                out: str | None = None, buckets: int = 64) -> DataFrame:
    """Rows ``folder, key, ts, value`` for every (series, spec, folder) listed.

    The manifest (bounded: one row per listed series and spec) is counted
    and broadcast; readings are tagged with their spec and folder in one
    map-side join, then all specs are computed together (``apply_specs``).

    Readings from a lake (``write_lake``; they have a column ``bucket``) are
    joined on the bucket too, so that only the folders of listed series are read
    (dynamic partition pruning); ``buckets`` is that of the lake. With ``out`` the
    result lands there, one dataset per folder (K1), and is read back from it.
    """
    chains = {r["spec"]: r["ProcessChain"] for r in specs.select("spec", "ProcessChain").collect()}
    m = manifest.select(key, "spec", "folder").distinct()
    wanted = [r["spec"] for r in m.select("spec").distinct().collect()]
    missing = sorted(set(wanted) - set(chains))
    if missing:
        raise ValueError(f"manifest names unknown specs: {missing}")
    if "bucket" in readings.columns:
        m = m.filter(F.col(key) > "").withColumn("bucket", writers.lake_bucket(key, buckets))
        tagged = readings.select(key, ts, value, "bucket").join(sized_broadcast(m), ["bucket", key]).drop("bucket")
    else:
        tagged = readings.select(key, ts, value).join(sized_broadcast(m), key)
    found = apply_specs(tagged, {s: chains[s] for s in wanted}, ["folder", key], ts, value).select("folder", key, ts, value)
    if out is None:
        return found
    if key != "uid":
        found = found.withColumnRenamed(key, "uid")
    writers.write_long_by_folder(found, out, mode="folders", ts=ts)
    kinds = {c: t for c, t in found.dtypes}
    back = readings.sparkSession.read.parquet(out).withColumn("folder", F.col("folder").cast("string"))
    # folders of earlier extracts stay where they are and are not part of this result
    listed = m.select("folder").distinct()
    back = back.join(sized_broadcast(listed), "folder", "left_semi")
    return back.select("folder", F.col("uid").alias(key), F.col(ts).cast(kinds[ts]).alias(ts), value)


def long_record_filter(df: DataFrame, keys, ts: str | None = None, values=None,
                       min_years: float = 5.0) -> DataFrame:
    """M2: regular series whose net record (present readings x step) reaches ``min_years``."""
    keys = list(keys)
    st = step_table(df, keys, ts, values)
    net = F.col("n") * F.col("step_us") / F.lit(float(US_PER_DAY) * DAYS_PER_YEAR)
    return (st.df.filter(F.col("step_us") > 0)
              .select(*keys, "n", "step_s", net.alias("net_years"))
              .filter(F.col("net_years") >= F.lit(float(min_years))))
