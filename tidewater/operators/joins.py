"""Keyed joins with an explicit size check before any broadcast.

Per-series tables (one row per series: start, end, step, ...) are small
compared with the readings, but their size still grows with the number of
series. They are therefore computed once (persisted), counted, and
broadcast only under ``BROADCAST_MAX_ROWS``. Above it
the join is a plain shuffle join; AQE's skew-join rule then splits a hot
series (one series may hold a third of all readings) over several tasks.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed limits (rows) for a broadcast side; a row of a per-series table is a
# handful of longs, so 2 M rows stay well under 200 MB.
BROADCAST_MAX_ROWS = 2_000_000
DIMENSION_MAX_ROWS = 1_000_000


class SmallTable:
    """A materialised DataFrame together with its exact row count."""

    def __init__(self, df: DataFrame, rows: int):
        self.df = df
        self.rows = rows

    def broadcastable(self, limit: int = BROADCAST_MAX_ROWS) -> bool:
        return self.rows <= limit

    def release(self) -> None:
        self.df.unpersist()


def materialise(df: DataFrame) -> SmallTable:
    """Compute a per-series table once and count it (one job).

    The table stays in the block cache (memory, spilling to disk); a lost
    block is recomputed from its lineage, so executor loss is survived.
    """
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    return SmallTable(df, df.count())


def join_keyed(big: DataFrame, small, keys, how: str = "inner",
               limit: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Join ``big`` with a per-key table on ``keys`` (null-safe equality).

    ``small`` is a :class:`SmallTable` (size known) or a DataFrame whose size
    is unknown, in which case no broadcast is forced and AQE decides.
    The key columns of ``small`` are dropped from the output.
    """
    keys = list(keys)
    if isinstance(small, SmallTable):
        right = small.df
        hinted = small.broadcastable(limit)
    else:
        right, hinted = small, False
    if not keys:
        # A frame-wide table has one row: attach it by a constant key.
        right = F.broadcast(right.withColumn("__one", F.lit(1)))
        return big.withColumn("__one", F.lit(1)).join(right, "__one", how).drop("__one")
    ren = {k: f"__r_{i}" for i, k in enumerate(keys)}
    right = right.selectExpr(*[f"`{c}` AS `{ren.get(c, c)}`" for c in right.columns])
    if hinted:
        right = F.broadcast(right)
    cond = " AND ".join(f"`{k}` <=> `{ren[k]}`" for k in keys)
    out = big.join(right, F.expr(cond), how)
    return out.drop(*ren.values())


def sized_broadcast(df: DataFrame, limit: int = DIMENSION_MAX_ROWS) -> DataFrame:
    """Broadcast-hint a dimension table only after counting it."""
    n = df.count()
    return F.broadcast(df) if n <= limit else df


def one_per_key(dim: DataFrame, on: str) -> DataFrame:
    """One row per key: the one with the greatest other columns."""
    rest = [f"`{c}`" for c in dim.columns if c != on]
    if not rest:
        return dim.distinct()
    best = dim.groupBy(F.col(f"`{on}`")).agg(F.max(F.struct(*rest)).alias("__v"))
    return best.select(F.col(f"`{on}`"), "__v.*").select(*[F.col(f"`{c}`") for c in dim.columns])


def enrich(df: DataFrame, dim: DataFrame, on: str, limit: int = DIMENSION_MAX_ROWS) -> DataFrame:
    """Left lookup of a keyed dimension; unmatched rows keep nulls.

    A lookup never multiplies readings: of several rows with one key, the one
    with the greatest other columns (in their order) is used, whatever the
    order of the rows.
    """
    dim = one_per_key(dim, on)
    return df.join(sized_broadcast(dim, limit), on=on, how="left")


def select_listed(df: DataFrame, manifest: DataFrame, on, limit: int = DIMENSION_MAX_ROWS) -> DataFrame:
    """Keep rows whose id is listed in ``manifest`` (left semi join)."""
    on = [on] if isinstance(on, str) else list(on)
    return df.join(sized_broadcast(manifest.select(*on).distinct(), limit), on=on, how="left_semi")


def keep_all_sites(sites: DataFrame, info: DataFrame, on: str = "Site") -> DataFrame:
    """Every listed site appears once, with nulls when it has no data.

    ``sites`` may carry more columns, such as the place of a site in the input.
    """
    return one_per_key(sites, on).join(info, on=on, how="left")
