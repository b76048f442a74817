"""DuckDB SQL fragments used as independent oracles for the registered queries.

They restate each operator's definition in plain SQL (lag, generate_series,
full outer join) so the Spark plans can be checked against a different
engine on the same parquet tables.
"""

from __future__ import annotations

THR_US = 60_000_000


def nn(col: str) -> str:
    """NaN counts as missing."""
    return f"case when isnan({col}) then null else {col} end"


def step_ctes(name: str, src: str, keys: list[str], t: str, present: str,
              is_date: bool = False, thr_us: int = THR_US) -> str:
    """CTEs ``{name}`` (keys, t0, t1, step_us) over the present rows of ``src``."""
    K = ", ".join(keys)
    ts = f"cast({t} as timestamp)" if is_date else t
    on = " and ".join(f"d.{k} = x.{k}" for k in keys)
    xk = ", ".join(f"x.{k}" for k in keys)
    return f"""
{name}_u as (select distinct {K}, epoch_us({ts}) as u from {src} where {present}),
{name}_d as (select {K}, u - lag(u) over (partition by {K} order by u) as d from {name}_u),
{name}_m as (select {K}, min(u) as t0, max(u) as t1 from {name}_u group by {K}),
{name}_g as (select {K}, min(d) filter (where d > 0) as m from {name}_d group by {K}),
{name}_b as (select {xk}, count(*) filter (where d.d > 0 and d.d % x.m <> 0) as bad
             from {name}_d d join {name}_g x on {on} group by {xk}),
{name} as (select m.*, case when g.m is null then null when g.m < {thr_us} or b.bad > 0 then -1
                          else g.m end as step_us
           from {name}_m m left join {name}_g g using ({K}) left join {name}_b b using ({K}))"""


def pad_ctes(name: str, src: str, steps: str, keys: list[str], t: str, values: list[str],
             present: str, is_date: bool = False) -> str:
    """CTE ``{name}``: present rows of ``src`` plus NULL rows on the regular grid."""
    K = ", ".join(keys)
    gt = "cast(make_timestamp(x) as date)" if is_date else "make_timestamp(x)"
    on = " and ".join([f"g.{k} = s.{k}" for k in keys] + [f"g.{t} = s.{t}"])
    sel = ", ".join([f"coalesce(g.{k}, s.{k}) as {k}" for k in keys] + [f"coalesce(g.{t}, s.{t}) as {t}"]
                    + [f"s.{v}" for v in values])
    return f"""
{name}_gr as (select {K}, {gt} as {t} from (select {K}, unnest(generate_series(t0, t1, step_us)) as x
              from {steps} where step_us > 0)),
{name}_s as (select * from {src} where {present}),
{name} as (select {sel} from {name}_gr g full outer join {name}_s s on {on})"""


def hourly_events_cte(name: str = "h") -> str:
    return (f"{name} as (select event_type, date_trunc('hour', ts) as ts, avg({nn('value')}) as value "
            f"from events group by all)")
