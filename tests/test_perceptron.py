"""The perceptron: gradients against differences, sums that do not depend on the deal, early stopping, persistence."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from quillspark.plans import perceptron as nn


def csr(rows):
    lengths = np.array([len(r) for r in rows], np.int32)
    return lengths, np.concatenate([list(r) for r in rows]).astype(np.int32), np.concatenate([list(r.values()) for r in rows])


def test_gradient_equals_differences():
    rng = np.random.default_rng(3)
    layers = [6, 5, 4, 1]
    rows = [{int(i): float(rng.normal()) for i in rng.choice(6, rng.integers(1, 6), replace=False)} for _ in range(9)]
    labels, weights = rng.integers(0, 2, 9).astype(float), nn.initial_weights(layers, 1)
    _, gradient = nn.loss_gradient(weights, layers, labels, *csr(rows))
    for i in range(len(weights)):
        step = np.zeros(len(weights))
        step[i] = 1e-6
        up, down = (nn.loss_gradient(weights + s, layers, labels, *csr(rows))[0] for s in (step, -step))
        assert gradient[i] == pytest.approx((up - down) / 2e-6, abs=1e-5)


def circle(spark, n, seed=0):
    """Points inside of a ring against those on it: no line parts them."""
    rng = np.random.default_rng(seed)
    angle, label = rng.uniform(0, 2 * np.pi, n), np.arange(n) % 2
    radius = 1 + label + rng.normal(0, 0.05, n)
    points = zip(radius * np.cos(angle), radius * np.sin(angle))
    rows = [(i, float(label[i]), Vectors.dense(p) if i % 3 else Vectors.sparse(2, [0, 1], list(p))) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, ["id", "label", "features"])


def test_sums_do_not_depend_on_the_deal(spark):
    layers = [2, 7, 1]
    weights = nn.initial_weights(layers, 5)
    seen = []
    for parts in (1, 3, 8):
        shards = nn.packed_shards(circle(spark, 900).repartition(parts), "id", F.lit(False), 900, 2)
        seen.append(nn.step_sums(shards.repartition(parts), weights, layers, 900))
    assert all(np.array_equal(seen[0][0], s[0]) and seen[0][1] == s[1] for s in seen)
    rows = circle(spark, 900).collect()
    dense = [dict(enumerate(r.features.toArray())) for r in rows]
    _, want = nn.loss_gradient(weights, layers, np.array([r.label for r in rows]), *csr(dense))
    assert np.allclose(seen[0][0], want / 900, atol=1e-9)


def test_learns_what_no_line_parts_stops_early_and_saves(spark, tmp_path):
    rows = circle(spark, 600)
    held_out = F.col("id") % 10 == 0
    model = nn.fit_perceptron(rows, 2, "id", held_out, (16, 8), rate=0.05, max_iter=60, patience=5, most_steps=2)
    history = model.getOrDefault(model.history)
    assert max(history) >= 0.95 and len(history) < 60  # it stopped by itself
    judged = model.transform(circle(spark, 200, 9)).withColumn("right", (F.col("prediction") == F.col("label")).cast("int"))
    assert judged.agg(F.avg("right")).first()[0] > 0.93
    model.write().overwrite().save(str(tmp_path / "m"))
    again = nn.PerceptronModel.load(str(tmp_path / "m")).transform(rows).select("probability").collect()
    assert again == model.transform(rows).select("probability").collect()


def test_no_held_out_rows_and_one_class(spark):
    rows = circle(spark, 20)
    model = nn.fit_perceptron(rows, 2, "id", F.lit(False), (3,), max_iter=2)
    assert model.getOrDefault(model.history) == [] and model.transform(rows).count() == 20
    one = rows.withColumn("label", F.lit(1.0))
    assert nn.fit_perceptron(one, 2, "id", F.col("id") == 0, (3,), max_iter=3).transform(one).count() == 20


def test_adam_takes_steps_of_its_rate():
    adam = nn.Adam(3, 0.1)
    assert np.allclose(adam.step(np.zeros(3), np.array([5.0, -0.001, 0.0])), [-0.1, 0.1, 0.0], atol=1e-5)


def test_tasks_of_a_step_do_not_grow_with_the_shards(spark, monkeypatch):
    assert nn.packed_shards(circle(spark, 900), "id", F.lit(False), 900, 2).rdd.getNumPartitions() == 1
    monkeypatch.setattr(nn, "SHARD_ROWS", 4)
    shards = nn.packed_shards(circle(spark, 900).repartition(40), "id", F.lit(False), 900, 2)
    assert shards.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert shards.agg(F.sum("n")).first()[0] == 900
    monkeypatch.setattr(nn, "MOST_SHARDS", 5)  # then shards grow with the rows
    assert nn.packed_shards(circle(spark, 900), "id", F.lit(False), 900, 2).select("shard").distinct().count() == 6
