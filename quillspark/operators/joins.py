"""Joins that hold up when a few keys own much of the table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 0.001
HOT_FLOOR = 1_000_000


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality on all keys."""
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[k]) for k in keys))


def hot_keys(
    counts: DataFrame, keys: list[str], share: float = HOT_SHARE, floor: int = HOT_FLOOR
) -> DataFrame:
    """Keys that hold more than ``share`` of all rows; never more than ``1 / share`` of them.

    ``counts`` is one row per key with its number of rows in ``n``.
    """
    total = counts.agg(F.sum("n").alias("n"))
    limit = F.greatest(total.scalar() * F.lit(share), F.lit(float(floor)))
    return counts.filter(F.col("n") > limit).select(*keys)


def hot_key_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    counts: DataFrame | None = None,
    share: float = HOT_SHARE,
    floor: int = HOT_FLOOR,
) -> DataFrame:
    """Inner join of ``facts`` to a ``lookup`` with one row per key.

    Hot keys are found first, from ``counts`` where the caller has them and from
    a map-side combined count otherwise.  There are at most ``1 / share`` of
    them, so their lookup rows can be broadcast; all other keys take the
    shuffled join.  Without hot keys the plan is one plain join.
    """
    if counts is None:
        counts = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    table = hot_keys(counts, keys, share, floor).toArrow()
    if table.num_rows == 0:
        return facts.join(lookup, keys)
    hot = F.broadcast(
        facts.sparkSession.createDataFrame(table, schema=facts.select(*keys).schema)
    )
    hot_rows = facts.join(hot, keys, "left_semi").join(
        F.broadcast(lookup.join(hot, keys, "left_semi")), keys
    )
    cold_rows = facts.join(hot, keys, "left_anti").join(lookup, keys)
    return hot_rows.unionByName(cold_rows)
