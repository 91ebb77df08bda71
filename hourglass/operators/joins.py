"""Joins (inventory C1-C12).

Broadcast policy: only sides whose size cannot grow with the data (``nation``,
``region``, one-row statistics) carry a hint.  Everything else is left to the
planner: AQE broadcasts by measured bytes, else a sort-merge join on the key
whose hot partitions it splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def equi_join(a: DataFrame, b: DataFrame, key: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on shared key column(s)."""
    return a.join(b, key if isinstance(key, str) else list(key), how)


def star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, Column | str, bool]],
              distinct: bool = True) -> DataFrame:
    """Chain of inner joins ``(dim, condition, fixed_size)``, then DISTINCT.

    ``fixed_size=True`` marks a dimension whose row count does not grow with
    the data (e.g. 25 nations); only those are broadcast.
    """
    out = fact
    for dim, cond, fixed in dims:
        out = out.join(F.broadcast(dim) if fixed else dim, cond, "inner")
    return out.dropDuplicates() if distinct else out


def range_join(events: DataFrame, stays: DataFrame, key: str = "stay",
               offset_col: str = "offset_min", lo: int = -1440,
               hi_col: str = "discharge_offset") -> DataFrame:
    """``key = key AND offset BETWEEN lo AND stays.hi_col``.

    Planned as an equi-join on ``key`` with the range as a residual predicate;
    the literal lower bound is also pushed below the join (parquet filter).
    """
    s = stays.select(key, hi_col)
    ev = events.where(F.col(offset_col) >= lo)
    return (ev.join(s, key, "inner")
              .where(F.col(offset_col) <= F.col(hi_col))
              .drop(hi_col))


def semi_join(df: DataFrame, ids: DataFrame, key: str = "stay") -> DataFrame:
    """C4: keep rows whose key is in ``ids`` (``IN (subquery)``)."""
    return df.join(ids.select(key), key, "left_semi")


def left_zero_fill(ids: DataFrame, values: DataFrame, key: str = "stay",
                   fill: float | int = 0) -> DataFrame:
    """Reindex ``values`` to every id; absent rows/values become ``fill``."""
    cols = [c for c in values.columns if c != key]
    out = ids.select(key).join(values, key, "left")
    return out.na.fill(fill, subset=cols) if cols else out


def cross_scalar(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Every row sees a one-row statistics table (an aggregate without grouping)."""
    return df.crossJoin(F.broadcast(stats))


def item_lookup(events: DataFrame, items: DataFrame, key: str = "itemid") -> DataFrame:
    """C11: item id -> label dictionary join."""
    return events.join(items, key, "inner")
