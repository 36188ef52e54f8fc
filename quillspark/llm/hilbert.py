"""Sharding along a Hilbert curve: rows near each other in language, source and size share shards and files.

Each of the three dimensions is cut into 16 ranges at quantiles (strings by their first bytes, so that a range
of values stays a range); the curve's index orders the 4096 cells, ``doc_id`` orders within a cell, and the order is cut into
runs of equal row counts.  The law is ``rows``: two shards differ by one row at most; equal texts need not share
a shard.  The order is made by range partitions over narrow rows; partitions are numbered on by their counts, so no step
gathers a cell, however many rows it has.

Defined cases: a null text has size 1 and checksum 0; null values lie before all others; repeated rows are placed
each; an empty table gives an empty result; further columns are ignored by the plan and kept by ``write_shards``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import Scratch, shuffle_partitions

BITS = 4
DIMENSIONS = 3
SHARDS = 8


def hilbert_index(point: tuple[int, ...], bits: int = BITS) -> int:
    """Place of a grid point on the curve: undo the axes' exchanges bit by bit, then read the Gray code."""
    x, n = list(point), len(point)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            if x[i] & q:
                x[0] ^= low
            else:
                t = (x[0] ^ x[i]) & low
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[-1] & q:
            t ^= q - 1
        q >>= 1
    x = [v ^ t for v in x]
    out = 0
    for bit in range(bits - 1, -1, -1):
        for v in x:
            out = out << 1 | (v >> bit & 1)
    return out


def _curve() -> list[int]:
    side = 1 << BITS
    return [hilbert_index((a, b, c)) for a in range(side) for b in range(side) for c in range(side)]


def _prefix_number(column):
    """The first seven bytes of a string as a number that sorts like the string; null is smallest."""
    head = F.substring(F.rpad(F.hex(F.substring(F.encode(F.coalesce(column, F.lit("")), "utf-8"), 1, 7)), 14, "0"), 1, 14)
    return F.when(column.isNull(), F.lit(-1).cast("long")).otherwise(F.conv(head, 16, 10).cast("long"))


def shard_rows(docs: DataFrame, shards: int = SHARDS, row: str | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, cell, shard, slot`` of every row; slots count from 0 along the curve.

    ``row`` names a column of stored row numbers, which then stands in the result.
    """
    spark = docs.sparkSession
    data = F.encode(F.coalesce("text", F.lit("")), "utf-8")
    passing = [] if row else ["row"]
    with Scratch(spark, "hilbert") as scratch:
        narrow = docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(data) + 1).cast("long").alias("size"),
            F.crc32(data).alias("text_crc32"),
            _prefix_number(F.col("lang")).alias("d0"),
            _prefix_number(F.col("source")).alias("d1"),
            *([F.col(row).alias("row")] if row else []),
        )
        rows = scratch.store(narrow if row else narrow.withColumn("row", F.monotonically_increasing_id()), "rows")
        inner = [i / (1 << BITS) for i in range(1, 1 << BITS)]
        dims = ("d0", "d1", "size")
        cuts = rows.agg(F.count("*").alias("n"), *(F.percentile_approx(d, inner, 10_000).alias(d) for d in dims)).first()
        n = cuts["n"]
        # quantiles that fall on one frequent value cut once, at it
        steps = [sum(((F.col(d) > c).cast("int") for c in sorted(set(cuts[d] or []))), F.lit(0)) for d in dims]
        place = steps[0] * (1 << 2 * BITS) + steps[1] * (1 << BITS) + steps[2]
        cell = F.element_at(F.lit(_curve()), place.cast("int") + 1)
        keyed = rows.withColumn("cell", cell).select("doc_id", "size", "text_crc32", "row", "cell")
        keys = ("cell", "doc_id", "row")
        ordered = keyed.repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys)
        numbered = scratch.store(ordered.withColumn("at", F.monotonically_increasing_id()).drop(*passing), "numbered")
        part, inside = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
        counts = numbered.groupBy(part.alias("part")).agg(F.count("*").alias("c"))  # a row per range
        before = F.coalesce(F.sum("c").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        base = counts.select("part", before.alias("before"))
        ranked = numbered.withColumn("part", part).join(base, "part").withColumn("rank", F.col("before") + inside)
        shard = F.floor(F.expr(f"rank * {shards} div {max(n, 1)}")).cast("int")
        placed = ranked.withColumn("shard", shard).withColumn(
            "slot", F.expr(f"rank - (shard * {n}L + {shards - 1}) div {shards}").cast("long")
        )
        return scratch.keep(placed.select("doc_id", "size", "text_crc32", "cell", "shard", "slot", *([F.col("row").alias(row)] if row else [])))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, files_per_shard: int = 1) -> None:
    """Write whole rows into shard folders, in curve order, so that files can be skipped by any dimension.

    Every row is written once, whatever its ``doc_id``: rows are stored with a number and find their places by it.
    Columns named ``shard`` or ``slot`` give way to the places.
    """
    with Scratch(docs.sparkSession, "shards") as scratch:
        kept = docs.drop("shard", "slot", "row_number_")
        rows = scratch.store(kept.withColumn("row_number_", F.monotonically_increasing_id()), "rows")
        plan = shard_rows(rows, shards, "row_number_").select("row_number_", "shard", "slot")
        joined = rows.join(plan, "row_number_").drop("row_number_")
        dealt = joined.repartitionByRange(shards * files_per_shard, "shard", "slot").sortWithinPartitions("shard", "slot")
        dealt.write.partitionBy("shard").parquet(path)
