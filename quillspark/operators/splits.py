"""Seeded shuffles, exact quotas, splits and folds.

A seeded shuffle orders rows by the digest of their id.  An exact quota then
only needs the digest at which to cut, and that digest is found without sorting
the table: count rows per digest prefix, see which prefix holds the cut, and
rank the rows of that prefix alone.  Wide rows are never shuffled; they are
compared with the cut where they lie.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark import fixed_values as fv
from quillspark.functions.hashing import order_key
from quillspark.operators.joins import same_keys
from quillspark.session import broadcast_if_small

PREFIX_DIGITS = 4


def _cut_points(
    df: DataFrame, row_id: str, strata: list[str], cuts: list[Column], seed: int, digits: int
) -> DataFrame:
    """Per stratum the ``(digest, id)`` of the last row inside each cut.

    ``cuts`` are row numbers written over ``n`` (rows of the stratum) and
    ``n_least`` (rows of the smallest stratum).  Cut ``j`` gives columns
    ``key_j`` and ``id_j``, null when the cut is empty.
    """
    narrow = df.select(*strata, F.col(row_id).alias("_id"), order_key(seed, F.col(row_id)).alias("_key"))
    narrow = narrow.withColumn("_prefix", F.substring("_key", 1, digits))
    counts = narrow.groupBy(*strata, "_prefix").agg(F.count(F.lit(1)).alias("_rows"))
    stratum = W.partitionBy(*strata)
    totals = counts.select(
        *strata,
        "_prefix",
        "_rows",
        (F.sum("_rows").over(stratum.orderBy("_prefix")) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(stratum).alias("n"),
    )
    least = totals.agg(F.min("n").alias("n"))
    totals = totals.withColumn("n_least", least.scalar())
    wanted = totals.select(
        "*", F.posexplode(F.array(*[c.cast("bigint") for c in cuts])).alias("_cut", "_rank")
    )
    crossing = wanted.filter(
        (F.col("_rank") > F.col("_before")) & (F.col("_rank") <= F.col("_before") + F.col("_rows"))
    ).select(*strata, "_prefix", "_cut", (F.col("_rank") - F.col("_before")).alias("_offset"))
    crossing = broadcast_if_small(crossing)
    keys = [*strata, "_prefix"]
    near = narrow.join(crossing, same_keys(narrow, crossing, keys)).select(
        *[narrow[k] for k in keys], "_cut", "_offset", "_key", "_id"
    )
    place = F.row_number().over(W.partitionBy(*keys, "_cut").orderBy("_key", "_id"))
    last = near.withColumn("_place", place).filter(F.col("_place") == F.col("_offset"))
    points = last.groupBy(*strata).agg(
        *[
            F.max(F.when(F.col("_cut") == j, F.col(part))).alias(f"{part}_{j}")
            for j in range(len(cuts))
            for part in ("_key", "_id")
        ]
    )
    return broadcast_if_small(points)


def with_cut_number(
    df: DataFrame,
    row_id: str,
    strata: list[str],
    cuts: list[Column],
    name: str,
    seed: int = 42,
    digits: int = PREFIX_DIGITS,
) -> DataFrame:
    """Number of the first cut a row lies inside; ``len(cuts)`` when it lies in none."""
    points = _cut_points(df, row_id, strata, cuts, seed, digits)
    if strata:
        joined = df.join(points, same_keys(df, points, strata), "left")
        joined = reduce(lambda d, s: d.drop(points[s]), strata, joined)
    else:
        row = points.first()
        joined = df.withColumns({c: F.lit(row[c] if row else None) for c in points.columns})
    key = order_key(seed, F.col(row_id))
    number = F.lit(len(cuts))
    for j in reversed(range(len(cuts))):
        inside = (key < F.col(f"_key_{j}")) | (
            (key == F.col(f"_key_{j}")) & (F.col(row_id) <= F.col(f"_id_{j}"))
        )
        number = F.when(inside, F.lit(j)).otherwise(number)
    return joined.withColumn(name, number).drop(
        *[f"{part}_{j}" for j in range(len(cuts)) for part in ("_key", "_id")]
    )


def _named(df: DataFrame, number: str, name: str, names: list[str]) -> DataFrame:
    lookup = F.array(*map(F.lit, names))
    return df.withColumn(name, F.get(lookup, F.col(number))).drop(number)


def stratified_split(
    df: DataFrame,
    row_id: str,
    strata: list[str],
    test: float = 0.2,
    val: float = 0.2,
    seed: int = 42,
    digits: int = PREFIX_DIGITS,
) -> DataFrame:
    """Adds ``split``: test, val or train, in exact proportion within each stratum."""
    n_test = F.round(F.col("n") * F.lit(test))
    n_val = F.round(F.col("n") * F.lit(val))
    cuts = [n_test, F.least(n_test + n_val, F.col("n"))]
    numbered = with_cut_number(df, row_id, strata, cuts, "_part", seed, digits)
    return _named(numbered, "_part", "split", ["test", "val", "train"])


def stratified_holdout(
    df: DataFrame, row_id: str, strata: list[str], test: float = 0.2, seed: int = 42
) -> DataFrame:
    cuts = [F.round(F.col("n") * F.lit(test))]
    numbered = with_cut_number(df, row_id, strata, cuts, "_part", seed)
    return _named(numbered, "_part", "split", ["test", "train"])


def stratified_kfold(
    df: DataFrame, row_id: str, strata: list[str], folds: int = 5, seed: int = 42
) -> DataFrame:
    """Adds ``fold`` 0..folds-1; sizes within a stratum differ by at most one."""
    cuts = [F.round(F.col("n") * F.lit(j) / F.lit(folds)) for j in range(1, folds)]
    return with_cut_number(df, row_id, strata, cuts, "fold", seed)


def balanced_sample(
    df: DataFrame, row_id: str, label: str, per_class: int, seed: int = 42
) -> DataFrame:
    """The same number of rows of every class: ``per_class``, or all of the smallest."""
    cuts = [F.least(F.lit(per_class), F.col("n_least"))]
    numbered = with_cut_number(df, row_id, [label], cuts, "_part", seed)
    return numbered.filter(F.col("_part") == 0).drop("_part")


def domain_quota_sample(
    df: DataFrame, row_id: str, domain: str, shares: dict[str, float], total: int, seed: int = 42
) -> DataFrame:
    """Up to ``share * total`` rows of each listed domain."""
    quota = F.lit(0)
    for name, share in shares.items():
        quota = F.when(F.col(domain) == name, F.lit(round(share * total))).otherwise(quota)
    listed = df.filter(F.col(domain).isin(*shares))
    numbered = with_cut_number(listed, row_id, [domain], [F.least(quota, F.col("n"))], "_part", seed)
    return numbered.filter(F.col("_part") == 0).drop("_part")


def assign_provider(
    df: DataFrame, row_id: str, targets: dict[str, float] = fv.PROVIDER_TARGETS, seed: int = 42
) -> DataFrame:
    """Give every request a provider so that the target shares are met exactly."""
    names = list(targets)
    bounds, reached = [], 0.0
    for name in names[:-1]:
        reached += targets[name]
        bounds.append(F.round(F.col("n") * F.lit(round(reached, 9))))
    numbered = with_cut_number(df, row_id, [], bounds, "_part", seed)
    return _named(numbered, "_part", "provider", names)


def shuffle_seeded(df: DataFrame, row_id: str, seed: int = 42) -> DataFrame:
    """Global reproducible shuffle: a range-partitioned sort on the digest."""
    return df.withColumn("shuffle_key", order_key(seed, F.col(row_id))).orderBy("shuffle_key", row_id)
