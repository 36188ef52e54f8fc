"""A seeded shuffle without a global sort: dense row numbers through a keyed permutation.

The numbers 0 .. n-1 are written as pairs over ``a * b >= n``.  Rounds add a digest of one half to the other, in turn,
modulo ``a`` or ``b``: a bijection of all pairs, whatever the digest.  A number whose place is n or more is sent on from there
until it falls below n.  ``a`` is chosen so that few pairs are left over, so those ways are a short table.

Rows then go straight to the file that holds their place: one exchange, no sampling pass, no sort over the whole table.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.operators.running import add_running, in_ranges
from quillspark.session import broadcast_if_small, stored

ROUNDS = 6
FIRST_PRIME, SECOND_PRIME = 2**31 - 1, 2**31 - 19
DIGITS = 7  # of the digest that gives a factor


@lru_cache
def factors(seed: int) -> list[list[int]]:
    """Four numbers below 2**28, not 0, for each round."""

    def number(i: int, j: int) -> int:
        return int(hashlib.md5(f"{seed}:{i}:{j}".encode()).hexdigest()[:DIGITS], 16) + 1

    return [[number(i, j) for j in range(4)] for i in range(ROUNDS)]


@lru_cache
def sides(n: int) -> tuple[int, int]:
    """The pair ``a, b`` with the least ``a * b - n``, ``a`` from the root of n on; the smallest such ``a``.

    Near the root r those differences follow squares, so some multiples of ``sqrt(r)`` are tried.
    """
    first = max(1, isqrt(max(n, 1) - 1) + 1)
    a = min(range(first, first + 1000 + 4 * isqrt(first)), key=lambda x: (-(-n // x) * x - n, x))
    return a, max(1, -(-n // a))


def _digest(half, keys: list[int]):
    p, q, r, s = keys
    return ((half * p + q) % FIRST_PRIME * r + s) % SECOND_PRIME


def place_of(number: int, n: int, seed: int = 42) -> int:
    """The place of one number; the same rule as ``permuted``."""
    (a, b), keys = sides(n), factors(seed)
    while True:
        x, y = number % a, number // a
        for i in range(ROUNDS):
            if i % 2:
                y = (y + _digest(x, keys[i])) % b
            else:
                x = (x + _digest(y, keys[i])) % a
        number = y * a + x
        if number < n:
            return number


def permuted(df: DataFrame, number: str, n: int, seed: int = 42, name: str = "place") -> DataFrame:
    """Adds the place of every row; ``number`` runs from 0 to ``n - 1``."""
    (a, b), keys = sides(n), factors(seed)
    out = df.withColumns({"_x": F.col(number) % a, "_y": F.expr(f"`{number}` div {a}")})
    for i in range(ROUNDS):
        half, other, side = ("_y", "_x", b) if i % 2 else ("_x", "_y", a)
        out = out.withColumn(half, (F.col(half) + _digest(F.col(other), keys[i])) % side)
    found = out.withColumn("_place", F.col("_y") * a + F.col("_x"))
    place: Column = F.col("_place")
    over = ",".join(str(place_of(v, n, seed)) for v in range(n, a * b) if n)
    if over:  # one literal, whatever its length
        ways = F.split(F.lit(over), ",").cast("array<long>")
        place = F.when(place < n, place).otherwise(F.get(ways, (place - n).cast("int")))
    return found.withColumn(name, place).drop("_x", "_y", "_place")


def numbered(df: DataFrame, order: list[str] | None = None, name: str = "number") -> tuple[DataFrame, int]:
    """Dense numbers from 0 on, and how many.

    Along ``order``, which must tell all rows apart, they are the same on any cluster (by ranges, each sorted on its own).
    Without one they follow the table as it is stored here: nothing but a count per split is shuffled.
    """
    if order:
        ranged = in_ranges(df.withColumn("_one", F.lit(1).cast("long")), [F.col(c) for c in order])
        running = add_running(ranged, [F.col(c) for c in order], {"_one": "all"})
        rows = running.withColumn(name, F.col("all_running") - 1).drop("_one", "_range", "all_running", "all_total")
        return rows, ranged.count()
    kept = stored(df.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    split = F.shiftright("_at", 33)
    inside = F.col("_at").bitwiseAND((1 << 33) - 1)
    counts = kept.groupBy(split.alias("_split")).agg(F.count("*").alias("_n")).collect()  # a row per stored split
    before, n = {}, 0
    for row in sorted(counts):
        before[row["_split"]], n = n, n + row["_n"]
    starts = df.sparkSession.createDataFrame(list(before.items()), "_split long, _before long")
    joined = kept.withColumn("_split", split).join(broadcast_if_small(starts), "_split")
    return joined.withColumn(name, F.col("_before") + inside).drop("_split", "_before", "_at"), n


def shuffle_places(df: DataFrame, order: list[str] | None = None, seed: int = 42) -> DataFrame:
    """Every row with its ``place`` in a reproducible shuffle."""
    rows, n = numbered(df, order, "_number")
    return permuted(rows, "_number", n, seed).drop("_number")


def write_shuffled(df: DataFrame, path: str, files: int, order: list[str] | None = None, seed: int = 42) -> None:
    """Shuffled rows in ``files`` files of equal size, in order of places within and across them."""
    rows, n = numbered(df, order, "_number")
    placed = permuted(rows, "_number", n, seed).drop("_number")
    dealt = placed.repartitionById(files, F.expr(f"cast(place * {files} div {max(n, 1)} AS int)"))
    dealt.sortWithinPartitions("place").write.parquet(path)
