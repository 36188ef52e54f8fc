"""Exact top-k inner products by a Voronoi join: queries and data meet group by group, under bounds.

Queries and data are grouped by their nearest pivot.  A group of queries is known by its pivot p, its radius R (largest
distance of a query to p) and its size; for a row x, each of its queries scores within ``p.x - R|x| .. p.x + R|x|``.  A
group of data is known by its pivot, its radius and its longest row, which bound all its rows at once.  The (k+1)-th
largest lower bound per group of queries, the best one of each ``vec_id``, is a floor that each query's k-th best score meets
(one id may be the query's own, in however many rows), so a group of data meets only groups whose floor its upper bound
reaches, and of its rows only those whose own upper bound does.  They travel as packed blocks, dealt over
as many tasks as there are rows for, against blocks of queries of one or several groups; each task keeps the k best, and a
last step merges them.

Pivots are a bounded sample: about the square root of the number of queries, ``max_pivots`` at most, the first by a digest of
their ids.

A vector is the floors of 256 times its components.  Defined cases: vectors that are null or hold null or non-finite
components, and rows with a null id, take no part; shorter vectors count as padded with zeros; rows that share
the query's id are not its candidates; equal repeated query rows are one query; scores must fit a long; an empty table gives
an empty result; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import Scratch, mix

QUERY_BLOCK = 1024
DATA_BLOCK = 4096
TASK_ROWS = 32_768
EXACT = 2**53


def integer_vectors(rows: DataFrame) -> DataFrame:
    """``vec_id, v``: usable vectors as arrays of longs."""
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    scaled = F.transform(x, lambda c: F.floor(F.lit(256.0) * c.cast("double")).cast("long"))
    return rows.filter("vec_id IS NOT NULL AND embedding IS NOT NULL").filter(finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("v")
    )


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as a matrix, padded with zeros."""
    lengths = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), np.int64)
    row = np.repeat(np.arange(len(column)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def nearest(vectors: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot of each vector and the distance."""
    v, p = vectors.astype(float), pivots.astype(float)
    square = (v * v).sum(1)[:, None] - 2 * v @ p.T + (p * p).sum(1)[None]
    best = square.argmin(1)
    return best, np.linalg.norm(v - p[best], axis=1)


def scores(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """All inner products, exactly: in floating point only where no sum can leave the whole numbers."""
    if not queries.size or not data.size:
        return np.zeros((len(queries), len(data)), np.int64)
    # floats hold the sizes here: a product of longs may not fit one
    bound = float(np.abs(queries.astype(float)).max()) * float(np.abs(data.astype(float)).max()) * queries.shape[1]
    if bound < EXACT:
        return (queries.astype(float) @ data.astype(float).T).astype(np.int64)
    return queries @ data.T


def best_of(score: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int):
    """Row, id and score of each row's k best columns; ties go to smaller ids."""
    order = np.argsort(ids, kind="stable")
    score, ids = score[:, order], ids[order]
    allowed = ids[None, :] != own[:, None]
    least = np.iinfo(np.int64).min
    masked = np.where(allowed, score, least)
    if len(ids) > k:
        floor = np.partition(masked, len(ids) - k, axis=1)[:, len(ids) - k][:, None]
        above, level = masked > floor, (masked == floor) & allowed
        room = k - above.sum(1)
        allowed = above | (level & (np.cumsum(level, axis=1) <= room[:, None]))
    row, column = np.nonzero(allowed)
    return row, ids[column], score[row, column]


def _packed(vectors: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(vectors.astype("<i8").reshape(-1, 1)).view(np.uint8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _unpacked(blob: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").reshape(-1, width)


def pivot_count(asked: int, max_pivots: int) -> int:
    return max(1, min(max_pivots, math.isqrt(max(0, asked - 1)) + 1))


def best_per_id(ids: np.ndarray, low: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest bounds of a column over distinct ids, each id by its best."""
    order = np.argsort(-low, kind="stable")
    first = np.sort(np.unique(ids[order], return_index=True)[1])[:most]
    return ids[order][first], low[order][first]


class Bounds:
    """Between what all scores of a group of queries with a row, or with a group of rows, lie."""

    def __init__(self, pivots: np.ndarray, radius: np.ndarray):
        self.pivots, self.radius = pivots.astype(float), radius
        self.length = np.linalg.norm(self.pivots, axis=1)

    def of_rows(self, v: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        v = v.astype(float)
        size = np.linalg.norm(v, axis=1)[:, None]
        middle, reach = v @ self.pivots[cells].T, size * self.radius[cells]
        reach += 1e-9 * size * (self.length + self.radius)[cells] + 1e-6
        return middle - reach, middle + reach

    def of_groups(self, radius: np.ndarray, longest: np.ndarray) -> np.ndarray:
        """Upper bounds, a row per group of queries and a column per group of data."""
        reach = self.length[:, None] * radius + self.radius[:, None] * longest
        return self.pivots @ self.pivots.T + reach + 1e-9 * (self.length[:, None] * (self.length + radius) + reach) + 1e-6


def top_k(rows: DataFrame, is_query, k: int = 5, max_pivots: int = 64) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best candidates of every query."""
    spark = rows.sparkSession
    with Scratch(spark, "knn") as scratch:
        vectors = scratch.store(integer_vectors(rows), "vectors")
        queries = scratch.store(vectors.filter(is_query).distinct(), "queries")
        shape = vectors.agg(F.max(F.size("v")).alias("w"), F.count("*").alias("n")).first()
        width = max(1, shape["w"] or 1)
        tasks = max(1, -(-shape["n"] // TASK_ROWS))
        chosen = queries.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(pivot_count(queries.count(), max_pivots))
        found = chosen.select("v").toArrow().column("v").combine_chunks()
        pivots = np.unique(matrix(found, width), axis=0) if len(found) else np.zeros((1, width), np.int64)

        def group(batches):
            for batch in batches:
                v = matrix(batch.column(1), width)
                at, distance = nearest(v, pivots)
                size = np.linalg.norm(v.astype(float), axis=1)
                made = [pa.array(at.astype(np.int32)), pa.array(distance), pa.array(size)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=["vec_id", "v", "cell", "distance", "size"])

        in_cells = "vec_id long, v array<long>, cell int, distance double, size double"
        grouped = scratch.store(queries.mapInArrow(group, in_cells), "grouped")
        data = scratch.store(vectors.mapInArrow(group, in_cells), "data")
        scratch.drop("vectors")

        def summary(df):
            """Radius, longest row and number of rows of every group; radius -1 if it has none."""
            of = np.full(len(pivots), -1.0), np.zeros(len(pivots)), np.zeros(len(pivots), np.int64)
            wide = df.groupBy("cell").agg(F.max("distance").alias("r"), F.max("size").alias("s"), F.count("*").alias("n"))
            for s in wide.collect():  # a row per pivot at most
                slack = 1e-9 * (s["r"] + np.linalg.norm(pivots[s["cell"]].astype(float))) + 1e-6
                of[0][s["cell"]], of[1][s["cell"]], of[2][s["cell"]] = s["r"] + slack, s["s"] * (1 + 1e-9), s["n"]
            return of

        radius, _, sizes = summary(grouped)
        used = np.flatnonzero(sizes)
        bounds = Bounds(pivots, np.maximum(radius, 0.0))

        def floors(batches):
            kept = [(np.zeros(0, np.int64), np.zeros(0))] * len(used)
            for batch in batches:
                ids = batch.column(0).to_numpy(zero_copy_only=False)
                low, _ = bounds.of_rows(matrix(batch.column(1), width), used)
                for i, (names, lows) in enumerate(kept):
                    new = np.flatnonzero(low[:, i] > lows[-1]) if len(lows) > k else np.arange(len(ids))
                    if len(new):
                        kept[i] = best_per_id(np.concatenate([names, ids[new]]), np.concatenate([lows, low[new, i]]), k + 1)
            for cell, (names, lows) in zip(used.tolist(), kept):
                made = [pa.array(np.full(len(names), cell, np.int32)), pa.array(names), pa.array(lows)]
                yield pa.RecordBatch.from_arrays(made, names=["cell", "vec_id", "low"])

        own = Window.partitionBy("cell").orderBy(F.desc("low"), "vec_id")
        lows = data.select("vec_id", "v").mapInArrow(floors, "cell int, vec_id long, low double")
        lows = lows.groupBy("cell", "vec_id").agg(F.max("low").alias("low")).withColumn("at", F.row_number().over(own))
        floor = np.full(len(pivots), -np.inf)
        for r in lows.filter(F.col("at") == k + 1).collect():  # a row per pivot at most
            floor[r["cell"]] = r["low"]
        around, longest, _ = summary(data)
        meets = bounds.of_groups(np.maximum(around, 0.0), longest) >= floor[:, None]

        # small groups of queries travel together, a large one in several blocks
        bin_of, blocks, room = np.zeros(len(pivots), np.int64), [], 0
        for cell in used.tolist():
            if sizes[cell] > room:
                blocks.append(-(-int(sizes[cell]) // QUERY_BLOCK))
                room = QUERY_BLOCK if blocks[-1] == 1 else 0
            bin_of[cell] = len(blocks) - 1
            room = max(0, room - int(sizes[cell]))

        def deal(batches):
            for batch in batches:
                v, ids = matrix(batch.column(1), width), batch.column(0).to_numpy(zero_copy_only=False)
                at = batch.column(2).to_numpy(zero_copy_only=False)
                needed = np.zeros((len(ids), len(blocks)), bool)
                for there in np.unique(at):
                    mine, cells = np.flatnonzero(at == there), used[meets[used, there]]
                    reached = bounds.of_rows(v[mine], cells)[1] >= floor[cells]
                    for i, cell in enumerate(cells):
                        needed[mine, bin_of[cell]] |= reached[:, i]
                for group_ in range(len(blocks)):
                    mine = np.flatnonzero(needed[:, group_])
                    for low in range(0, len(mine), DATA_BLOCK):
                        some = mine[low : low + DATA_BLOCK]
                        slot = int(mix(ids[some[:1]].astype(np.uint64))[0]) % tasks
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([group_], pa.int64()),
                                pa.array([slot], pa.int64()),
                                pa.array([ids[some].astype("<i8").tobytes()], pa.binary()),
                                pa.array([_packed(v[some])], pa.binary()),
                            ],
                            names=["bin", "slot", "ids", "block"],
                        )

        def of(numbers, index):
            return F.element_at(F.array(*(F.lit(int(x)).cast("long") for x in numbers)), index.cast("int") + 1)

        dealt = data.select("vec_id", "v", "cell").mapInArrow(deal, "bin long, slot long, ids binary, block binary")
        dealt = dealt.withColumn("q", F.explode(F.sequence(F.lit(0).cast("long"), of(blocks or [1], F.col("bin")) - 1)))
        sent = grouped.withColumn("bin", of(bin_of, F.col("cell")))
        mine = F.pmod(F.xxhash64("vec_id", F.lit(3)), of(blocks or [1], F.col("bin")))
        everywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tasks - 1).cast("long")))
        sent = sent.withColumn("q", mine).withColumn("slot", everywhere).select("bin", "slot", "q", "vec_id", "v", "cell")

        def solve(key, left, right):
            left = left.sort_by("cell")
            asked, names = matrix(left.column("v").combine_chunks(), width), left.column("vec_id").to_numpy()
            cells, first = np.unique(left.column("cell").to_numpy(), return_index=True)
            edges = [*first.tolist(), len(asked)]
            kept = [np.zeros(0, np.int64)] * 3
            for ids, block in zip(right.column("ids").to_pylist(), right.column("block").to_pylist()):
                ids, vectors_ = np.frombuffer(ids, "<i8"), _unpacked(block, width)
                reached = bounds.of_rows(vectors_, cells)[1] >= floor[cells]
                for i in range(len(cells)):
                    there, near_ = ids[reached[:, i]], vectors_[reached[:, i]]
                    for low in range(edges[i], edges[i + 1] if len(there) else 0, 256):
                        some = slice(low, min(low + 256, edges[i + 1]))
                        row, candidate, score = best_of(scores(asked[some], near_), there, names[some], k)
                        kept = [np.concatenate(c) for c in zip(kept, (row + low, candidate, score))]
                order = np.lexsort((kept[1], -kept[2], kept[0]))
                kept = [c[order] for c in kept]
                place = np.arange(len(order)) - np.searchsorted(kept[0], kept[0])
                kept = [c[place < k] for c in kept]
            digest = [hash_of(v) for v in asked]
            return pa.table(
                {
                    "query_id": names[kept[0]],
                    "digest": pa.array([digest[i] for i in kept[0].tolist()], pa.binary()),
                    "vec_id": kept[1],
                    "score": kept[2],
                }
            )

        near = (
            sent.groupBy("bin", "slot", "q")
            .cogroup(dealt.groupBy("bin", "slot", "q"))
            .applyInArrow(solve, "query_id long, digest binary, vec_id long, score long")
        )
        order = Window.partitionBy("query_id", "digest").orderBy(F.desc("score"), "vec_id")
        ranked = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        return scratch.keep(ranked.select("query_id", "rank", "vec_id", "score"))


def hash_of(vector: np.ndarray) -> bytes:
    """Tells apart queries that share an id."""
    return zstandard.ZstdCompressor(level=1).compress(np.trim_zeros(vector, "b").tobytes())
