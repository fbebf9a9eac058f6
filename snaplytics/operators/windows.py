"""Ranking windows (W1-W3) and the post-window filters.

``row_number``/``rank`` followed by ``<= n`` is planned as ``WindowGroupLimit``
(partial before the shuffle, final after) while n is within
``spark.sql.optimizer.windowGroupLimitThreshold``; the session raises that to
5,000, so a hot group is cut to n rows per map task before it is shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from snaplytics.operators.joins import bounded_broadcast


def rank_within(df: DataFrame, partition: list[str], order: list[Column], name: str = "rank",
                dense: bool = False) -> DataFrame:
    """Ties share a rank, gaps after (``dense=False``)."""
    fn = F.dense_rank() if dense else F.rank()
    return df.withColumn(name, fn.over(W.partitionBy(*partition).orderBy(*order)))


def top_n_per_group(df: DataFrame, partition: list[str], order: list[Column], n: int,
                    rank_col: str | None = None, ties: bool = False) -> DataFrame:
    """W2 / W3 + C7: first ``n`` rows per group in ``order``.

    ``ties=False`` uses ``row_number`` (pass a total order for a deterministic
    cut); ``ties=True`` keeps every row ranked ``<= n``.
    """
    fn = F.rank() if ties else F.row_number()
    name = rank_col or "__rn"
    out = df.withColumn(name, fn.over(W.partitionBy(*partition).orderBy(*order))).where(F.col(name) <= n)
    return out if rank_col else out.drop(name)


def top_n_per_group_two_level(df: DataFrame, partition: list[str], order: list[Column], n: int,
                              buckets: int | None = None) -> DataFrame:
    """Exact first ``n`` rows per group for large ``n`` over many input tasks.

    The one-level plan keeps ``n`` rows per group in every map task, so the final
    task of a group receives ``n`` x (number of map tasks) rows. Here the first
    level groups by (group, bucket of the map partition): all rows of a map task
    share a bucket, so the map-side limit still prunes to ``n`` per group, and
    each first-level task only merges the tasks of its bucket. The second level
    merges ``buckets`` x ``n`` candidates per group. Top-n of top-n is exact for a
    total ``order``; the bucket only balances work. By default ``buckets`` is about
    the square root of the session's shuffle partitions (sized to the input), which
    balances the two levels without a look at the input.
    """
    if buckets is None:
        buckets = max(8, math.isqrt(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))) + 1)
    salted = df.withColumn("__bucket", F.pmod(F.spark_partition_id(), F.lit(buckets)))
    first = top_n_per_group(salted, partition + ["__bucket"], order, n).drop("__bucket")
    return top_n_per_group(first, partition, order, n)


def value_bin(c: str) -> Column:
    """The lower bound of a number's bin, monotone in the number: its 11 leading bits (NULL and negative: -1)."""
    shift = F.greatest(F.floor(F.log2(F.greatest(F.col(c), F.lit(1)))) - 10, F.lit(0)).cast("int")
    mask = F.call_function("shiftright", F.col(c), shift)
    return F.when(F.coalesce(F.col(c), F.lit(-1)) < 0, F.lit(-1)).otherwise(F.call_function("shiftleft", mask, shift)).cast("long")


def cutoffs(df: DataFrame, group: str, value: str, n: int) -> DataFrame:
    """(group, cutoff): a value such that at least ``n`` rows of the group reach it (NULL: keep all rows).

    A histogram of leading bits, so two columns are read and a few thousand bins a group
    are shuffled. Rows in the bin of the cutoff are all above it: the cut stays exact afterwards.
    """
    bins = df.groupBy(group, value_bin(value).alias("__bin")).agg(F.count(F.lit(1)).alias("__rows"))
    above = F.sum("__rows").over(W.partitionBy(group).orderBy(F.desc("__bin")))
    reached = bins.withColumn("__above", above).where((F.col("__above") >= n) & (F.col("__bin") >= 0))
    found = reached.groupBy(F.col(group).alias("__found")).agg(F.max("__bin").alias("cutoff"))
    return bins.select(group).distinct().join(found, F.col(group).eqNullSafe(F.col("__found")), "left").select(group, "cutoff")


def top_n_by_cutoff(df: DataFrame, group: str, value: str, order: list[Column], n: int,
                    max_groups: int = 100_000) -> DataFrame:
    """W3 for a few large groups: the exact first ``n`` rows per group in ``order``, which starts with
    ``value`` descending. Wide rows below their group's cutoff are left out by a semi-join
    before anything is sorted; the rest are cut in two levels."""
    limits = bounded_broadcast(cutoffs(df, group, value, n).withColumnRenamed(group, "__group"), max_groups)
    reaches = F.col(group).eqNullSafe(F.col("__group")) & (F.col("cutoff").isNull() | (F.col(value) >= F.col("cutoff")))
    return top_n_per_group_two_level(df.join(limits, reaches, "left_semi"), [group], order, n)
