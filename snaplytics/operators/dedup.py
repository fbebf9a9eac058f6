"""Deduplication.

Keep-max dedup is written as an aggregation, not a window: ``max`` over a struct
whose leading fields are the ordering and whose trailing fields are the rest of
the row. That is a total order (ties broken by the row's own values, so the
answer is deterministic) and, being an aggregate, it gets map-side partial
aggregation: a hot key holding a third of all rows is collapsed to one row per
map task before the shuffle instead of landing whole in one window task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedup_exact(df: DataFrame) -> DataFrame:
    """Drop rows equal in every column (NULLs compare equal)."""
    return df.dropDuplicates()


def keep_max_per_key(df: DataFrame, keys: list[str], by: str = "views",
                     tiebreak: list[str] | None = None, merged: str | None = None) -> DataFrame:
    """One row per ``keys`` with the largest ``by`` (NULL ``by`` last).

    Remaining ties are broken by ``tiebreak`` (default: all other columns, in
    frame order, larger first) - identical rows are interchangeable, so the
    result is a function of the input multiset. ``merged`` names an added column with the
    number of rows that each result row stands for.
    """
    rest = [c for c in df.columns if c not in keys and c != by]
    order = tiebreak if tiebreak is not None else rest
    payload = [c for c in rest if c not in order]
    fields: list[Column] = [F.col(by).isNotNull().alias("__has"), F.col(by).alias("__by")]
    fields += [F.col(c).alias(f"__t{i}") for i, c in enumerate(order)]
    fields += [F.col(c).alias(f"__p{i}") for i, c in enumerate(payload)]
    counted = [F.count(F.lit(1)).alias(merged)] if merged else []
    best = df.groupBy(*keys).agg(F.max(F.struct(*fields)).alias("__best"), *counted)
    names = {by: "__by"}
    names.update({c: f"__t{i}" for i, c in enumerate(order)})
    names.update({c: f"__p{i}" for i, c in enumerate(payload)})
    return best.select(*[F.col(c) if c in keys else F.col(f"__best.{names[c]}").alias(c)
                         for c in df.columns], *([merged] if merged else []))


def last_wins(df: DataFrame, key: str, value: str, precedence: list[str]) -> DataFrame:
    """One ``value`` per ``key``; the row greatest in ``precedence`` wins
    (e.g. ``['region_ord', 'pos']``: last configured region, then last entry)."""
    return df.groupBy(key).agg(
        F.max_by(F.col(value), F.struct(*[F.col(c) for c in precedence])).alias(value))
