"""The forest: nodes split over blocks and nodes finished in a task give the same trees."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from quillspark.plans import forest


@pytest.fixture(scope="module")
def rows(spark):
    a, b = (F.pmod(F.xxhash64(F.lit(k), "id"), F.lit(97)) / 97.0 for k in (1, 2))
    cells = F.array(a, b, F.when(F.col("id") % 3 == 0, a * b).otherwise(0.0), F.lit(0.0))
    label = ((a > 0.5) != (b > 0.4)).cast("double")
    return spark.range(400).select("id", label.alias("label"), array_to_vector(cells).alias("features")).localCheckpoint()


def told(model):
    held = forest.decoded(model.getOrDefault(model.forest))
    return {name: values.tolist() for name, values in held.items() if name != "importance"}


def test_passes_over_blocks_and_finished_nodes_agree(rows):
    at_once = forest.fit_forest(rows, 4, "id", trees=5)
    by_passes = forest.fit_forest(rows, 4, "id", trees=5, node_rows=40)
    only_passes = forest.fit_forest(rows, 4, "id", trees=5, node_rows=0)
    assert told(at_once) == told(by_passes) == told(only_passes)


def test_learns_a_rule_of_two_features(rows):
    model = forest.fit_forest(rows, 4, "id", trees=20)
    scored = model.transform(rows).select("label", "prediction", vector_to_array("probability")[1].alias("p")).toPandas()
    assert (scored.label == scored.prediction).mean() > 0.97
    assert ((scored.p > 0.5) == (scored.prediction == 1)).all()
    importance = model.featureImportances.toArray()
    assert importance[:2].min() > importance[2:].max() and abs(importance.sum() - 1) < 1e-9


def test_depth_is_a_limit(rows):
    model = forest.fit_forest(rows, 4, "id", trees=3, depth=2, node_rows=0)
    assert model.totalNumNodes <= 3 * 7


def test_best_split_of_a_node():
    counts = np.zeros((2, 2, forest.BINS))
    counts[0, 1, 3], counts[1, 1, 3], counts[1, 1, 0] = 5, 5, 7  # class 1 lies above bin 0 of the second feature
    counts[0, 0, 0], counts[1, 0, 0] = 5, 12
    feature, cut, gain = forest.best_split(counts, np.array([4, 9]))
    assert (feature, cut) == (9, 0) and gain == pytest.approx(2 * 5 * 7 / 12)


def test_a_forest_holds_those_of_fewer_trees_less_depth_and_larger_nodes(rows):
    blocks, edges, n = forest.in_blocks(rows, "id", 4)
    nodes = forest.grow_trees(blocks, 4, n, range(12), None, 42)
    limits = [(None, 2), (3, 2), (5, 10)]
    first = forest.grow_trees(blocks, 4, n, range(7), 3, 42)
    again = forest.grow_trees(blocks, 4, n, range(7, 12), 3, 42)  # the trees that are grown later

    def sums(some, of):
        return {r["id"]: np.array(r["sums"]) for r in forest.limited(rows, 4, edges, some, of).collect()}

    whole, low, high = sums(nodes, limits), sums(first, [(None, 2)]), sums(again, [(None, 2)])
    assert all(low[i][0] + high[i][0] == pytest.approx(whole[i][1]) for i in whole)
    model = forest.fit_forest(rows, 4, "id", trees=12, depth=None)
    scored = model.transform(rows).select("id", vector_to_array("probability")[1].alias("p")).collect()
    assert all(r["p"] * 12 == pytest.approx(whole[r["id"]][0]) for r in scored)
    assert any(whole[i][2] != whole[i][0] for i in whole)
    ended = (nodes["held"] < 10) & (nodes["left"] >= 0)
    assert ended.any() and not ((nodes["held"] < 2) & (nodes["left"] >= 0)).any()


def test_trees_without_a_limit_grow_past_the_bits_of_a_number(spark):
    """One row at a time can be split off, so the tree is a chain."""
    n = 30  # features of one value each: a row's label is told by its own feature alone
    cells = [(i, float(i % 2), [1.0 if j == i else 0.0 for j in range(n)]) for i in range(n)]
    data = spark.createDataFrame(cells * 6, "id int, label double, cells array<double>").select("id", "label", array_to_vector("cells").alias("features"))
    chains = [forest.grow_trees(*_blocks(data, n), range(4), depth, 1) for depth in (None, 5)]
    depths = [_depth(nodes) for nodes in chains]
    assert depths[0] > depths[1] == 5
    number = 2**100 + 1
    assert len(set(forest.chosen(1, 2, number, 50).tolist())) == 8 and (forest.chosen(1, 2, number, 50) != forest.chosen(1, 2, number - 1, 50)).any()
    columns = forest.Columns(80, 160, np.arange(160), np.repeat(np.arange(80), 2), np.ones(160, np.uint8))
    feature, _, left, *_ = forest.grown(columns, 80, np.arange(160) // 2 % 2 * 1.0, np.ones(160), 3, 0, 1 << 60, None)
    assert (feature >= 0).sum() >= 39 and (left[feature >= 0] > 0).all()


def _blocks(data, size):
    blocks, _, n = forest.in_blocks(data, "id", size)
    return blocks, size, n


def _depth(nodes):
    level, depth = nodes["roots"], -1
    while len(level):
        below = nodes["left"][level]
        below = below[below >= 0]
        level, depth = np.concatenate([below, below + 1]), depth + 1
    return depth
