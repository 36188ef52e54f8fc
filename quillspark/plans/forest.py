"""A random forest over sparse vectors: large nodes are split by histograms of all blocks, small ones are finished in tasks of their own.

Rows are dealt into blocks by their id's digest and written once, features in a byte of bins each, a column at a time.  A pass over the
blocks counts, for every open node of every tree, the classes per bin of the node's features; the counts are added up by the shuffle and
the best split of a node comes back, a row per node.  A node with at most ``NODE_ROWS`` rows is not split this way: its rows are sent to
one task, which grows the rest of its tree.  So the number of passes is bounded by the depth, whatever the number of nodes, and no task
holds more rows than a node may have.

A row's place in a tree's bootstrap is drawn from Poisson(1) by seed, block and tree; a node's features by seed, tree and node.
Blocks are stored, so a task that runs again draws the same.

The number of a node is its path (1 at the root, ``2 n`` and ``2 n + 1`` below ``n``), which has no largest value: trees may be of any depth.
As draws go by tree and path, a forest of fewer trees, of less depth or with larger nodes to split is a part of a larger one: ``limited``
judges them all by one forest.
"""

from __future__ import annotations

import base64
import hashlib
import io
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.session import drop_scratch, drop_stored, scratch_path, shuffles_dropped, stored

BINS = 32
BLOCK_ROWS = 2048
NODE_ROWS = 32768
SENT_ROWS = 4_000_000  # rows of small nodes that travel at once
_PART = "tree int, node string, rows int, y binary, w binary, lengths binary, indices binary, bins binary"
_NODE = {"feature": np.int32, "cut": np.uint8, "left": np.int32, "ones": np.float64, "total": np.float64, "gain": np.float64, "held": np.int32}
_GROWN = "tree int, node string, " + ", ".join(f"{name} binary" for name in _NODE)
_BEST_DDL = (
    "tree int, node string, feature int, bin int, ones double, total double, gain double, left_ones double, left_total double, "
    "left_held double, held double"
)
_BEST = pa.schema(
    [("tree", pa.int32()), ("node", pa.string()), ("feature", pa.int32()), ("bin", pa.int32())]
    + [(name, pa.float64()) for name in ("ones", "total", "gain", "left_ones", "left_total", "left_held", "held")]
)
_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)


# --- one node --------------------------------------------------------------------


class Columns:
    """Binned rows by feature: the places and bins of the cells that are not in the first bin."""

    def __init__(self, size: int, rows: int, at: np.ndarray, features: np.ndarray, bins: np.ndarray):
        order = np.argsort(features, kind="stable")
        self.rows, self.at, self.bins = rows, at[order].astype(np.int32), bins[order]
        self.starts = np.searchsorted(features[order], np.arange(size + 1))

    def cells(self, features: np.ndarray):
        """Which of the features, place and bin of all their cells."""
        low, n = self.starts[features], self.starts[features + 1] - self.starts[features]
        which = np.repeat(np.arange(len(features)), n)
        spot = np.arange(len(which)) + np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        return which, self.at[spot], self.bins[spot]

    def above(self, feature: int, cut: int) -> np.ndarray:
        """Places of the rows whose bin of the feature lies above the cut."""
        low, high = self.starts[feature], self.starts[feature + 1]
        return self.at[low:high][self.bins[low:high] > cut]

    def histogram(self, features, inside, *measures) -> np.ndarray:
        """Sums of the measures, a value per row each, per feature and bin over the rows ``inside``."""
        which, at, bins = self.cells(features)
        met = inside[at]
        cell, at = which[met] * BINS + bins[met], at[met]
        out = np.stack([np.bincount(cell, v[at], len(features) * BINS).reshape(-1, BINS) for v in measures])
        whole = np.array([v[inside].sum() for v in measures])
        out[:, :, 0] = whole[:, None] - out[:, :, 1:].sum(axis=2)
        return out


def chosen(seed: int, tree: int, node: int, size: int) -> np.ndarray:
    """The features of a node, the square root of their number: the first different ones of a row of mixed numbers."""
    wanted = min(size, int(np.ceil(np.sqrt(size))))
    start = np.uint64(int.from_bytes(hashlib.blake2b(f"{seed} {tree} {node}".encode(), digest_size=8).digest()))
    draws = 2 * wanted
    while True:
        x = start + np.arange(1, draws + 1, dtype=np.uint64) * _MIX[0]
        x = (x ^ (x >> np.uint64(30))) * _MIX[1]
        x = (x ^ (x >> np.uint64(27))) * _MIX[2]
        drawn = (x ^ (x >> np.uint64(31))) % np.uint64(size)
        first = np.unique(drawn, return_index=True)[1]
        if len(first) >= wanted:
            return np.sort(drawn[np.sort(first)[:wanted]]).astype(np.int64)
        draws *= 2


def best_split(counts: np.ndarray, features: np.ndarray) -> tuple[int, int, float]:
    """Feature, last bin of the left side and fall of the Gini impurity; feature -1 if nothing falls."""
    left = np.cumsum(counts[:2], axis=2)[:, :, :-1]
    whole = counts[:2, 0].sum(axis=1)
    right = whole[:, None, None] - left
    with np.errstate(divide="ignore", invalid="ignore"):
        kept = left[0] * (1 - left[0] / left[1]) + right[0] * (1 - right[0] / right[1])
    kept[(left[1] <= 1e-9) | (right[1] <= 1e-9)] = np.inf
    spot = int(np.argmin(kept))
    gain = 2 * (whole[0] * (1 - whole[0] / whole[1]) - kept.flat[spot]) if np.isfinite(kept.flat[spot]) else 0.0
    if gain <= 1e-9:
        return -1, 0, 0.0
    return int(features[spot // (BINS - 1)]), spot % (BINS - 1), float(gain)


def pure(ones: float, total: float) -> bool:
    return ones <= 1e-9 or total - ones <= 1e-9


def deepest(node: int, depth: int | None) -> bool:
    return depth is not None and node.bit_length() > depth


def grown(columns: Columns, size: int, ones, total, seed: int, tree: int, node: int, depth: int | None) -> list[np.ndarray]:
    """The subtree of a node whose rows are all of ``columns``, an array for each of ``_NODE``.

    A leaf has feature and left child -1; a right child follows its left one.
    """
    out, open_ = [None], [(0, node, columns, ones, total, np.ones(columns.rows, bool))]
    while open_:
        place, node, columns, ones, total, inside = open_.pop()
        a, n, held = float(ones[inside].sum()), float(total[inside].sum()), int(inside.sum())
        out[place] = (-1, 0, -1, a, n, 0.0, held)
        if pure(a, n) or deepest(node, depth):
            continue
        if held * 2 < columns.rows:  # most cells belong to other nodes: keep those of this one
            at = np.cumsum(inside) - 1
            cells = np.flatnonzero(inside[columns.at])
            features = np.repeat(np.arange(size), np.diff(columns.starts))[cells]
            columns = Columns(size, held, at[columns.at[cells]], features, columns.bins[cells])
            ones, total, inside = ones[inside], total[inside], np.ones(held, bool)
        features = chosen(seed, tree, node, size)
        feature, cut, gain = best_split(columns.histogram(features, inside, ones, total), features)
        if feature >= 0:
            left = len(out)
            out[place] = (feature, cut, left, a, n, gain, held)
            out += [None, None]
            right = np.zeros(columns.rows, bool)
            right[columns.above(feature, cut)] = True
            open_ += [
                (left, 2 * node, columns, ones, total, inside & ~right), (left + 1, 2 * node + 1, columns, ones, total, inside & right)
            ]
    return [np.array(values, kind) for values, kind in zip(zip(*out), _NODE.values())]


# --- blocks ----------------------------------------------------------------------


def bin_edges(rows: DataFrame, size: int) -> np.ndarray:
    """Per feature the upper edges of its bins: zero, then quantiles of its other values over all rows."""
    raw = F.unwrap_udt(F.col("features"))
    at = F.coalesce(raw["indices"], F.sequence(F.lit(0), F.lit(size - 1)))
    cells = rows.select(F.explode(F.arrays_zip(at.alias("at"), raw["values"].alias("v"))).alias("c")).filter("c.v > 0")
    shares = F.array(*[F.lit(k / (BINS - 1)) for k in range(1, BINS - 1)])
    found = cells.groupBy("c.at").agg(F.percentile_approx("c.v", shares, 1000).alias("edges")).toArrow()  # as the vocabulary
    edges = np.full((size, BINS - 1), np.inf)
    edges[:, 0] = 0.0
    for place, values in zip(found["at"].to_pylist(), found["edges"].to_pylist()):
        edges[place, 1:] = values
    return edges


def binned(edges: np.ndarray, features: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The bin of each cell: the number of its feature's edges below the value."""
    out = np.zeros(len(values), np.uint8)
    for k in range(BINS - 1):
        out += values > edges[features, k]
    return out


def packed_blocks(rows: DataFrame, row_id: str, size: int, n_rows: int, edges: np.ndarray, weight: str | None) -> DataFrame:
    """``rows (row_id, label, features)`` in blocks of their binned cells."""
    shared = rows.sparkSession.sparkContext.broadcast(edges)
    raw = F.unwrap_udt(F.col("features"))
    dealt = rows.select(
        F.pmod(F.xxhash64(F.col(row_id).cast("string")), F.lit(n_rows // BLOCK_ROWS + 1)).cast("int").alias("block"),
        F.col(row_id).cast("string").alias("row"),
        F.col("label").cast("double").alias("y"),
        (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("w"),
        F.coalesce(raw["indices"], F.sequence(F.lit(0), F.lit(size - 1))).alias("indices"),
        raw["values"].alias("vals"),
    )

    def pack(key, table: pa.Table) -> pa.Table:
        table = table.sort_by("row").combine_chunks()
        lengths = np.diff(table["vals"].combine_chunks().offsets.to_numpy()) if table.num_rows else np.zeros(0, int)
        indices, values = (table[c].combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("indices", "vals"))
        bins = binned(shared.value, indices, values)
        at = np.repeat(np.arange(table.num_rows), lengths)
        met = bins > 0
        made = [table["y"].to_numpy(), table["w"].to_numpy(), np.bincount(at[met], minlength=table.num_rows).astype(np.int32), indices[met].astype(np.int32), bins[met]]
        return pa.table(
            [pa.array([key[0].as_py()], pa.int32()), pa.array([table.num_rows], pa.int32()), *(pa.array([a.tobytes()], pa.binary()) for a in made)],
            names=["block", "rows", "y", "w", "lengths", "indices", "bins"],
        )

    schema = "block int, rows int, y binary, w binary, lengths binary, indices binary, bins binary"
    return dealt.groupBy("block").applyInArrow(lambda key, table: pack(key, table), schema)


def unpacked(row: dict, size: int) -> tuple[Columns, np.ndarray, np.ndarray]:
    lengths = np.frombuffer(row["lengths"], np.int32)
    at = np.repeat(np.arange(row["rows"]), lengths)
    columns = Columns(size, row["rows"], at, np.frombuffer(row["indices"], np.int32), np.frombuffer(row["bins"], np.uint8))
    return columns, np.frombuffer(row["y"]), np.frombuffer(row["w"])


def bag(seed: int, block: int, tree: int, rows: int) -> np.ndarray:
    return np.random.default_rng([seed, 1, block, tree]).poisson(1, rows)


def placed(columns: Columns, splits: dict, drawn: np.ndarray) -> tuple[np.ndarray, dict]:
    """Per row of a block a number of its node under a tree's splits so far, -1 if it was not drawn; and the nodes' numbers."""
    number, node = {1: 0}, np.where(drawn > 0, 0, -1)
    for at in sorted(splits):  # a node comes before those below it
        right = columns.above(*splits[at])
        here = node == number[at]
        number[2 * at], number[2 * at + 1] = len(number), len(number) + 1
        node[here] = number[2 * at]
        right = right[here[right]]
        node[right] = number[2 * at + 1]
    return node, number


# --- fitting ---------------------------------------------------------------------


def _histograms(blocks: DataFrame, size: int, seed: int, splits: dict, wanted: dict) -> list:
    """The best split, the weights and the drawn rows of each wanted node, all blocks counted."""
    shared = blocks.sparkSession.sparkContext.broadcast((splits, wanted))

    def count(batches):
        splits, wanted = shared.value
        sums: dict = {}
        for batch in batches:
            for row in batch.to_pylist():
                columns, y, w = unpacked(row, size)
                for tree, nodes in wanted.items():
                    drawn = bag(seed, row["block"], tree, row["rows"])
                    (at, number), total = placed(columns, splits[tree], drawn), drawn * w
                    for node in nodes:
                        cells = columns.histogram(chosen(seed, tree, node, size), at == number[node], total * y, total, (drawn > 0) * 1.0)
                        sums[tree, node] = sums.get((tree, node), 0) + cells
        for (tree, node), cells in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([tree], pa.int32()), pa.array([str(node)]), pa.array([cells.tobytes()], pa.binary())], names=["tree", "node", "cells"]
            )

    def best(key, table: pa.Table) -> pa.Table:
        tree, node = key[0].as_py(), int(key[1].as_py())
        features = chosen(seed, tree, node, size)
        # pieces come in any order: their sums are taken in one
        cells = sum(np.frombuffer(c).reshape(3, len(features), BINS) for c in sorted(table["cells"].to_pylist()))
        feature, cut, gain = best_split(cells, features)
        whole = cells[:, 0].sum(axis=1)
        left = cells[:, int(np.searchsorted(features, feature)), : cut + 1].sum(axis=1) if feature >= 0 else whole
        values = [tree, str(node), feature, cut, float(whole[0]), float(whole[1]), gain, *map(float, left), float(whole[2])]
        return pa.table([pa.array([v], t) for v, t in zip(values, _BEST.types)], names=_BEST.names)

    # each task sums up in its own memory and sends one histogram a node: no more tasks than cores
    few = blocks.coalesce(blocks.sparkSession.sparkContext.defaultParallelism)
    parts = few.mapInArrow(count, "tree int, node string, cells binary")
    with shuffles_dropped(blocks.sparkSession):
        found = parts.groupBy("tree", "node").applyInArrow(lambda key, table: best(key, table), _BEST_DDL).collect()  # a row per open node
    shared.destroy()
    return found


def _finished(blocks: DataFrame, size: int, seed: int, depth: int | None, splits: dict, small: dict) -> DataFrame:
    """The subtrees below all small nodes, a row each."""
    shared = blocks.sparkSession.sparkContext.broadcast((splits, small))

    def send(batches):
        splits, small = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                columns, y, w = unpacked(row, size)
                lengths = np.frombuffer(row["lengths"], np.int32)
                starts = np.concatenate([[0], np.cumsum(lengths)])
                indices, bins = np.frombuffer(row["indices"], np.int32), np.frombuffer(row["bins"], np.uint8)
                for tree, nodes in small.items():
                    drawn = bag(seed, row["block"], tree, row["rows"])
                    at, number = placed(columns, splits[tree], drawn)
                    for node in nodes:
                        mine = np.flatnonzero(at == number[node])
                        if not len(mine):
                            continue
                        n = lengths[mine]
                        spot = np.repeat(starts[mine] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                        made = [y[mine], drawn[mine] * w[mine], n, indices[spot], bins[spot]]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([tree], pa.int32()), pa.array([str(node)]), pa.array([len(mine)], pa.int32()), *(pa.array([a.tobytes()], pa.binary()) for a in made)],
                            names=["tree", "node", "rows", "y", "w", "lengths", "indices", "bins"],
                        )

    def grow(key, table: pa.Table) -> pa.Table:
        tree, node = key[0].as_py(), int(key[1].as_py())
        parts = {c: table[c].to_pylist() for c in ("y", "w", "lengths", "indices", "bins")}
        # sums of weights are taken over rows in one order, whatever the order in which the pieces came
        order = sorted(range(table.num_rows), key=lambda i: tuple(parts[c][i] for c in parts))
        row = {c: b"".join(v[i] for i in order) for c, v in parts.items()} | {"rows": sum(table["rows"].to_pylist())}
        columns, y, w = unpacked(row, size)
        made = [a.tobytes() for a in grown(columns, size, y * w, w, seed, tree, node, depth)]
        head = [pa.array([tree], pa.int32()), pa.array([str(node)])]
        return pa.table([*head, *(pa.array([m], pa.binary()) for m in made)], names=["tree", "node", *_NODE])

    return blocks.mapInArrow(send, _PART).groupBy("tree", "node").applyInArrow(lambda key, table: grow(key, table), _GROWN)


def in_blocks(rows: DataFrame, row_id: str, size: int, weight: str | None = None) -> tuple[DataFrame, np.ndarray, int]:
    """Stored blocks, the edges of their bins, and the number of rows."""
    n_rows = rows.count()
    edges = bin_edges(rows, size)
    return stored(packed_blocks(rows, row_id, size, n_rows, edges, weight), "blocks"), edges, n_rows


def trees_at_once(n_rows: int) -> int:
    """So many that their rows and nodes, which are sent at once, stay within a bound."""
    return max(1, SENT_ROWS // max(n_rows, 1))


def grow_trees(
    blocks: DataFrame, size: int, n_rows: int, trees: range, depth: int | None, seed: int, node_rows: int = NODE_ROWS
) -> dict[str, np.ndarray]:
    """All nodes of the trees, as ``in_order`` gives them."""
    spark = blocks.sparkSession
    splits: dict = {t: {} for t in trees}
    told = {}  # the large nodes; there are few
    small: dict = {t: [] for t in trees}
    open_ = {(t, 1): n_rows for t in trees}
    while open_:
        wanted: dict = {}
        for (t, node), held in open_.items():
            if held <= node_rows:
                small[t].append(node)
            else:
                wanted.setdefault(t, []).append(node)
        open_ = {}
        for r in _histograms(blocks, size, seed, splits, wanted) if wanted else []:
            t, node = r["tree"], int(r["node"])
            if r["feature"] < 0 or deepest(node, depth) or pure(r["ones"], r["total"]):
                told[t, node] = (-1, 0, -1, r["ones"], r["total"], 0.0, r["held"])
                continue
            told[t, node] = (r["feature"], r["bin"], -1, r["ones"], r["total"], r["gain"], r["held"])
            splits[t][node] = (r["feature"], r["bin"])
            open_[t, 2 * node] = r["left_held"]
            open_[t, 2 * node + 1] = r["held"] - r["left_held"]
    path, most, subtrees = scratch_path(spark, "trees"), trees_at_once(n_rows), []
    for low in range(trees.start, trees.stop, most):
        some = {t: small[t] for t in range(low, min(low + most, trees.stop)) if small[t]}
        if some:
            with shuffles_dropped(spark):
                _finished(blocks, size, seed, depth, splits, some).write.mode("append").parquet(path)
    if any(small.values()):  # a model's nodes, as arrays
        subtrees = spark.read.schema(_GROWN).parquet(path).toArrow().to_pylist()
        drop_scratch(spark, path)
    return in_order(told, subtrees)


def in_order(told: dict, subtrees: list[dict]) -> dict[str, np.ndarray]:
    """Nodes as flat arrays, tree by tree and level by level, so that a right child follows its left one; and the trees' ``roots``."""
    place = {key: k for k, key in enumerate(told)}
    parts = [[np.array(c, kind) for c, kind in zip(zip(*told.values()), _NODE.values())]] if told else []
    trees, base = [np.array([t for t, _ in told], np.int64)], len(told)
    for row in subtrees:
        made = [np.frombuffer(row[name], kind) for name, kind in _NODE.items()]
        place[row["tree"], int(row["node"])] = base
        made[2] = np.where(made[2] >= 0, made[2] + base, -1)
        parts.append(made)
        trees.append(np.full(len(made[0]), row["tree"], np.int64))
        base += len(made[0])
    nodes = dict(zip(_NODE, (np.concatenate(c) for c in zip(*parts)))) if parts else {name: np.zeros(0, kind) for name, kind in _NODE.items()}
    tree, left = np.concatenate(trees), nodes["left"].astype(np.int64)
    right = np.where(left >= 0, left + 1, -1)
    for (t, node), k in place.items():
        if k < len(told) and nodes["feature"][k] >= 0:
            left[k], right[k] = place[t, 2 * node], place[t, 2 * node + 1]
    level = np.array([k for (_, node), k in sorted(place.items()) if node == 1], np.int64)
    levels = [level]
    while len(level):
        inner = level[left[level] >= 0]
        level = np.stack([left[inner], right[inner]], 1).ravel()
        levels.append(level)
    order = np.concatenate(levels)
    order = order[np.argsort(tree[order], kind="stable")]
    spot = np.empty(len(order), np.int64)
    spot[order] = np.arange(len(order))
    out = {name: values[order] for name, values in nodes.items()}
    out["left"] = np.where(left[order] >= 0, spot[left[order]], -1).astype(np.int32)
    return out | {"roots": np.sort(spot[levels[0]]).astype(np.int32)}


def fit_forest(
    rows: DataFrame, size: int, row_id: str, trees: int = 100, depth: int | None = 30, seed: int = 42, weight: str | None = None,
    node_rows: int = NODE_ROWS,
) -> ForestModel:
    """Bagged trees of Gini splits, each node over the square root of the features, grown until pure or ``depth`` deep."""
    blocks, edges, n_rows = in_blocks(rows, row_id, size, weight)
    nodes = grow_trees(blocks, size, n_rows, range(trees), depth, seed, node_rows)
    drop_stored(blocks)
    return ForestModel(inputCol="features", size=size, forest=encoded(size, edges, nodes))


# --- parts of a forest -----------------------------------------------------------


def limited(rows: DataFrame, size: int, edges: np.ndarray, nodes: dict, limits: list[tuple[int | None, int]]) -> DataFrame:
    """Adds ``sums``: per limit the class shares of the trees' leaves, added up, where trees end by the limit.

    A limit is ``(depth, rows)``: nodes so deep, and nodes that drew fewer rows, have no children.
    """
    kept = {name: nodes[name] for name in ("roots", "feature", "cut", "left", "held")} | {"edges": edges}
    shared = rows.sparkSession.sparkContext.broadcast(kept | {"p": (nodes["ones"] / nodes["total"]).astype(np.float32)})

    @F.pandas_udf("array<double>")
    def judge(indices: pd.Series, values: pd.Series) -> pd.Series:
        held, out = shared.value, []
        for low in range(0, len(values), 256):
            bins = row_bins(indices[low : low + 256], values[low : low + 256], held["edges"], size)
            out += list(limited_sums(held, bins, limits))
        return pd.Series(out)

    raw = F.unwrap_udt(F.col("features"))
    return rows.withColumn("sums", judge(raw["indices"], raw["values"]))


def limited_sums(held: dict, bins: np.ndarray, limits: list[tuple[int | None, int]]) -> np.ndarray:
    """A row of sums for each row of bins."""
    rows, trees = len(bins), len(held["roots"])
    node = np.tile(held["roots"], rows)
    row = np.repeat(np.arange(rows), trees)
    ends = [node.copy() for _ in limits]
    open_ = [np.ones(len(node), bool) for _ in limits]
    pairs, level = np.arange(len(node)), 0
    while True:
        here = node[pairs]
        going = held["left"][here] >= 0
        pairs, here = pairs[going], here[going]
        for k, (depth, least) in enumerate(limits):
            open_[k] = open_[k][going] & (held["held"][here] >= least)
            if depth is not None and level >= depth:
                open_[k][:] = False
        if not len(pairs) or not any(o.any() for o in open_):
            break
        node[pairs] = held["left"][here] + (bins[row[pairs], held["feature"][here]] > held["cut"][here])
        for end, o in zip(ends, open_):
            end[pairs[o]] = node[pairs[o]]
        level += 1
    return np.stack([held["p"][end].reshape(rows, trees).astype(np.float64).sum(axis=1) for end in ends], axis=1)


# --- the model -------------------------------------------------------------------


def encoded(size: int, edges: np.ndarray, nodes: dict[str, np.ndarray]) -> str:
    """The trees as one text."""
    feature, gain, roots, inner = nodes["feature"], nodes["gain"], nodes["roots"], nodes["feature"] >= 0
    importance = np.zeros(size)
    for low, high in zip(roots, [*roots[1:], len(feature)]):
        own = np.bincount(feature[low:high][inner[low:high]].astype(np.int64), gain[low:high][inner[low:high]], size)
        importance += own / own.sum() if own.sum() > 0 else 0
    made = io.BytesIO()
    np.savez_compressed(
        made, edges=edges, roots=roots, feature=np.maximum(feature, 0), cut=nodes["cut"], left=nodes["left"],
        p=(nodes["ones"] / nodes["total"]).astype(np.float32), importance=importance / max(importance.sum(), 1e-300),
    )
    return base64.b64encode(made.getvalue()).decode()


@lru_cache(maxsize=2)
def decoded(text: str) -> dict:
    with np.load(io.BytesIO(base64.b64decode(text))) as held:
        return {name: held[name] for name in held.files}


def row_bins(indices, values, edges: np.ndarray, size: int) -> np.ndarray:
    """The bins of sparse rows, features without a cell in the first one."""
    bins = np.zeros((len(values), size), np.uint8)
    for k, (at, cells) in enumerate(zip(indices, values)):
        at = np.arange(size) if at is None else at
        bins[k, at] = binned(edges, at, cells)
    return bins


class ForestModel(Transformer, HasInputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability``, the mean over the trees of their leaves' class shares, and ``prediction``."""

    size = Param(Params._dummy(), "size", "number of features", TypeConverters.toInt)
    forest = Param(Params._dummy(), "forest", "all trees, encoded", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol=None, size=None, forest=None):
        super().__init__()
        self._set(**self._input_kwargs)

    @property
    def featureImportances(self):
        return Vectors.dense(decoded(self.getOrDefault(self.forest))["importance"])

    @property
    def totalNumNodes(self) -> int:
        return len(decoded(self.getOrDefault(self.forest))["left"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        size = self.getOrDefault(self.size)
        shared = dataset.sparkSession.sparkContext.broadcast(self.getOrDefault(self.forest))

        @F.pandas_udf("double")
        def judge(indices: pd.Series, values: pd.Series) -> pd.Series:
            held, out = decoded(shared.value), np.zeros(len(values))
            for low in range(0, len(values), 256):
                bins = row_bins(indices[low : low + 256], values[low : low + 256], held["edges"], size)
                node = np.tile(held["roots"], (len(bins), 1))
                row = np.arange(len(bins))[:, None]
                while (inner := held["left"][node] >= 0).any():
                    right = bins[row, held["feature"][node]] > held["cut"][node]
                    node = np.where(inner, held["left"][node] + right, node)
                out[low : low + 256] = held["p"][node].astype(np.float64).mean(axis=1)
            return pd.Series(out)

        raw = F.unwrap_udt(F.col(self.getInputCol()))
        judged = dataset.withColumn("_p", judge(raw["indices"], raw["values"]))
        both = array_to_vector(F.array(1 - F.col("_p"), F.col("_p")))
        return judged.withColumn("probability", both).withColumn("prediction", (F.col("_p") > 0.5).cast("double")).drop("_p")
