"""Boosted trees: traversal against plain recursion, accuracy on held-out labels, odd rows."""

import zlib

import numpy as np

from quillspark.llm import quality
from quillspark.llm.queries import op8_quality


def auc(score, label):
    order = np.argsort(score)
    rank = np.empty(len(order))
    rank[order] = np.arange(len(order))
    good = label == 1
    return (rank[good].sum() - good.sum() * (good.sum() - 1) / 2) / (good.sum() * (~good).sum())


def test_flat_walk_equals_recursion():
    r = np.random.default_rng(1)
    x = r.normal(size=(400, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < -0.2)).astype(float)
    forest = quality.fit(x, y, trees=12, depth=3)

    def walk(tree, row, node=0):
        if node >= forest.feature.shape[1]:
            return forest.leaf[tree, node - forest.feature.shape[1]]
        return walk(tree, row, 2 * node + (2 if row[forest.feature[tree, node]] > forest.threshold[tree, node] else 1))

    want = [1 / (1 + np.exp(-forest.base - sum(walk(t, row) for t in range(12)))) for row in x]
    assert np.allclose(forest.probability(x), want)
    assert ((forest.probability(x) > 0.5) == (y > 0)).mean() > 0.9


def test_statistics_do_not_depend_on_neighbours():
    texts = ["", "One two two. THREE!!\nx | y", "é" * 30, " \n\n ", "a b a b a b", "12 34,"]
    data = [t.encode() for t in texts]
    whole = quality.statistics(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0] + [len(d) for d in data]))
    for i, d in enumerate(data):
        assert np.allclose(whole[i], quality.statistics(np.frombuffer(d, np.uint8), np.array([0, len(d)]))[0])
    assert np.isfinite(whole).all() and not whole[0].any()
    names = dict(zip(quality.STATISTICS, whole[1]))
    assert np.isclose(names["same_next"], 0.0) or names["same_next"] <= 1 / 7
    assert np.isclose(dict(zip(quality.STATISTICS, whole[4]))["distinct_word"], 2 / 6)


def test_query_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = op8_quality(spark, sf_dir).collect()
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert len(rows) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in label]
    assert auc(np.array([r.score for r in held]), np.array([label[r.doc_id] for r in held])) > 0.85


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, 1), (2, "", 2), (None, "words", 3), (3, "w " * 50_000, 4), (3, "w " * 50_000, 4)], "doc_id long, text string, score int"
    )
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.classify(docs, none).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1, 0), (3, 1, 0), (None, 0, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    assert all(r.score > 0.9 for r in quality.classify(docs, one).collect())
    assert quality.classify(docs.limit(0), one).count() == 0
