"""Fact ⋈ dimension joins.

A dimension is small by nature (dozens of categories) but that is a property of
the data, not a guarantee, so broadcasting is always behind a size check:

* ``broadcast="auto"`` (default): no hint. Catalyst broadcasts a Parquet-backed
  side under ``spark.sql.autoBroadcastJoinThreshold`` using file statistics, and
  AQE demotes a sort-merge join to a broadcast join only after measuring the
  shuffled side at runtime. Above the threshold it stays a shuffle join.
* ``broadcast="checked"``: count at most ``max_rows + 1`` rows of the dimension
  (a bounded job: ``limit`` stops early) and hint only when it fits. Use it for
  dimensions built in memory, which carry no size statistics.
* ``broadcast=True``: the caller proves the bound (e.g. fixed-size tables).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_ROWS = 1_000_000


def bounded_broadcast(dim: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only if ``dim`` provably holds at most ``max_rows`` rows."""
    n = dim.limit(max_rows + 1).count()
    return F.broadcast(dim) if n <= max_rows else dim


def _prepare(dim: DataFrame, broadcast, max_rows: int) -> DataFrame:
    if broadcast is True:
        return F.broadcast(dim)
    if broadcast == "checked":
        return bounded_broadcast(dim, max_rows)
    return dim


def join_dimension(fact: DataFrame, dim: DataFrame, key: str = "category_id", how: str = "inner",
                   broadcast="auto", max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """J1 (``how='inner'``: orphans vanish) / J2 (``how='left'``: orphans keep NULL attributes)."""
    return fact.join(_prepare(dim, broadcast, max_rows), on=key, how=how)


def orphans(fact: DataFrame, dim: DataFrame, key: str = "category_id",
            broadcast="auto", max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Fact rows whose key has no dimension row (the FK violations)."""
    return fact.join(_prepare(dim, broadcast, max_rows), on=key, how="left_anti")


def complete_domain(domain: DataFrame, agg: DataFrame, key: str, order_col: str) -> DataFrame:
    """Force every domain value (in domain order), NULL metrics where absent,
    drop aggregate keys outside the domain."""
    return domain.join(agg, on=key, how="left").orderBy(order_col).drop(order_col)
