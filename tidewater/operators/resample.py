"""Resample a series to hourly / daily / monthly means or sums.

Buckets are computed on TIMESTAMP_NTZ without any session time zone
(hour: integer floor of micros; day: ``to_date``; month: ``trunc``), so a
wall-clock reading never moves to a neighbouring bucket around DST. The
aggregation is a plain ``groupBy(keys, bucket)``: partial aggregation runs
map-side and a hot series is spread over all its buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import (as_ntz, bucket_sql, discover_roles, dtype_of,
                                  nan_to_null, nan_to_null_sql, q)

# Fixed vocabulary of the report specs (StatType / Period values).
STAT_TYPES = {"Mean": "mean", "Sum": "sum"}
PERIODS = {"Hourly": "hour", "Daily": "day", "Monthly": "month"}

_STATS = {"mean": F.avg, "sum": F.sum}


def resample(df: DataFrame, keys=(), ts: str | None = None, value: str | None = None,
             period: str = "hour", stat: str = "mean", label: str = "start") -> DataFrame:
    """Mean or sum of the non-missing values per (series, period bucket).

    The bucket is labelled by its start (default) or end; the output keeps
    the names of ``ts`` and ``value``.
    """
    keys = list(keys)
    ts, values = discover_roles(df, keys, ts, value)
    value = values[0]
    if stat not in _STATS:
        raise ValueError(f"stat must be one of {sorted(_STATS)}, got {stat!r}")
    if label not in ("start", "end"):
        raise ValueError("label must be 'start' or 'end'")
    b = bucket_sql(ts, period, label)
    return (df.selectExpr(*[q(k) for k in keys], f"{b} AS {q(ts)}", f"{nan_to_null_sql(value)} AS {q(value)}")
              .groupBy(*keys, ts).agg(_STATS[stat](value).alias(value)))


def raw_series(df: DataFrame, keys=(), ts: str | None = None, value: str | None = None) -> DataFrame:
    """Empty process chain: the readings themselves, NaN as NULL."""
    keys = list(keys)
    ts, values = discover_roles(df, keys, ts, value)
    return df.select(*keys, as_ntz(ts, dtype_of(df, ts)).alias(ts),
                     *[nan_to_null(v).alias(v) for v in values])


def apply_process_chain(df: DataFrame, chain, keys=(), ts: str | None = None,
                        value: str | None = None) -> DataFrame:
    """Run a report spec's process chain (list of dicts or Rows) on a series.

    Only what the specs use is accepted: ``Statistic`` of Mean/Sum over one
    Hourly/Daily/Monthly period, anchored at ``00-00 00:00``.
    """
    out = raw_series(df, keys, ts, value)
    for step in chain or []:
        step = step.asDict() if hasattr(step, "asDict") else dict(step)
        if step.get("ProcessType") != "Statistic":
            raise ValueError(f"unsupported ProcessType {step.get('ProcessType')!r}")
        if step.get("StatType") not in STAT_TYPES or step.get("Period") not in PERIODS:
            raise ValueError(f"unsupported statistic {step!r}")
        if int(step.get("PeriodCount") or 1) != 1:
            raise ValueError("only PeriodCount 1 is supported")
        if (step.get("BinAnchorOffsetPeriod") or "00-00 00:00") != "00-00 00:00":
            raise ValueError("only the default bin anchor is supported")
        out = resample(out, keys, ts, value, PERIODS[step["Period"]], STAT_TYPES[step["StatType"]])
    return out


def _chain_step(chain):
    """(stat, period) of a one-step chain, or None for the raw (empty) chain."""
    steps = [s.asDict() if hasattr(s, "asDict") else dict(s) for s in (chain or [])]
    if not steps:
        return None
    if len(steps) > 1:
        raise ValueError("multi-step chains: use apply_process_chain per spec")
    st = steps[0]
    if (st.get("ProcessType") != "Statistic" or st.get("StatType") not in STAT_TYPES
            or st.get("Period") not in PERIODS or int(st.get("PeriodCount") or 1) != 1
            or (st.get("BinAnchorOffsetPeriod") or "00-00 00:00") != "00-00 00:00"):
        raise ValueError(f"unsupported statistic {st!r}")
    return STAT_TYPES[st["StatType"]], PERIODS[st["Period"]]


def apply_specs(tagged: DataFrame, chains: dict, keys=(), ts: str = "TimeStamp",
                value: str = "Value", spec_col: str = "spec") -> DataFrame:
    """Apply many report specs at once to readings tagged with their spec.

    All aggregating specs share one ``groupBy`` (the bucket is a per-row
    ``CASE`` on the spec), raw specs pass through: the readings are read at
    most twice, however many specs there are.
    """
    keys = list(keys)
    parsed = {name: _chain_step(c) for name, c in chains.items()}
    agg_specs = {k: v for k, v in parsed.items() if v is not None}
    raw_specs = [k for k, v in parsed.items() if v is None]
    S, V = q(spec_col), nan_to_null_sql(value)
    parts = []
    if agg_specs:
        def lit(x):
            return "'" + x.replace("'", "''") + "'"
        bucket = "CASE " + " ".join(f"WHEN {S} = {lit(k)} THEN {bucket_sql(ts, p)}"
                                     for k, (_, p) in agg_specs.items()) + " END"
        sums = [k for k, (s, _) in agg_specs.items() if s == "sum"]
        pick = (f"CASE WHEN {S} IN ({', '.join(lit(k) for k in sums)}) THEN __sum ELSE __avg END"
                if sums else "__avg")
        a = (tagged.filter(F.col(spec_col).isin(list(agg_specs)))
                   .selectExpr(*[q(k) for k in keys], S, f"{bucket} AS {q(ts)}", f"{V} AS __v")
                   .groupBy(*keys, spec_col, ts)
                   .agg(F.sum("__v").alias("__sum"), F.avg("__v").alias("__avg"))
                   .selectExpr(*[q(k) for k in keys], S, q(ts), f"{pick} AS {q(value)}"))
        parts.append(a)
    if raw_specs:
        parts.append(tagged.filter(F.col(spec_col).isin(raw_specs)).selectExpr(
            *[q(k) for k in keys], S, f"CAST({q(ts)} AS TIMESTAMP_NTZ) AS {q(ts)}", f"{V} AS {q(value)}"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
