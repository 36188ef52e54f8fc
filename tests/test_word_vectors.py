"""Word vectors without a vocabulary on the driver."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.plans import evaluate, word_vectors


def test_the_tree_is_the_cheapest():
    counts = np.array([5, 3, 2, 1, 1])
    flat, lengths = word_vectors.paths(*word_vectors.huffman(counts), np.arange(5))
    assert lengths.tolist() == [1, 2, 3, 4, 4]
    codes, at = set(), 0
    for n in lengths:
        codes.add(tuple(sorted(flat[at : at + n].tolist())))
        at += n
    assert len(codes) == 5 and {step >> 1 for step in flat.tolist()} == {0, 1, 2, 3}


def test_a_step_moves_as_plain_recursion_does():
    """One token a step: the sums are those of single moves."""
    rng = np.random.default_rng(2)
    counts = np.array([9, 7, 5, 4, 3, 2])
    flat, lengths = word_vectors.paths(*word_vectors.huffman(counts), np.arange(6))
    starts, tokens, sentence = np.concatenate([[0], np.cumsum(lengths)]), rng.integers(0, 6, 40), np.arange(40) // 13
    nodes, sides = flat.astype(np.int64) >> 1, flat.astype(np.int64) & 1
    start = word_vectors.initial(np.arange(6), 8)
    plain, inner = start.astype(np.float64), np.zeros((nodes.max() + 1, 8))
    reach = np.random.default_rng(5).integers(1, word_vectors.WINDOW + 1, 40)
    for i in range(40):
        moves, moved = np.zeros_like(plain), np.zeros_like(inner)
        for j in range(max(0, i - reach[i]), min(40, i + reach[i] + 1)):
            if j == i or sentence[j] != sentence[i]:
                continue
            for k in range(starts[tokens[i]], starts[tokens[i] + 1]):
                f = plain[tokens[j]] @ inner[nodes[k]]
                g = (1 - sides[k] - 1 / (1 + np.exp(-f))) * word_vectors.RATE * (1 - i / 40)
                moves[tokens[j]] += g * inner[nodes[k]]
                moved[nodes[k]] += g * plain[tokens[j]]
        plain, inner = plain + moves, inner + moved
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(word_vectors, "STEP_TOKENS", 1)
        found = word_vectors.trained(start.copy(), starts, nodes, sides, tokens, sentence, 5)
    assert np.abs(found - plain).max() < 1e-6 and np.abs(found - start).max() > 1e-5


@pytest.fixture(scope="module")
def topics(spark):
    rng, rows = np.random.default_rng(1), []
    for i in range(1500):
        rows.append((i % 1400, " ".join(f"{'ab'[i % 2]}{w}word" for w in rng.integers(0, 12, 20))))
    rows += [(None, "a1word b1word rare"), (5000, ""), (5001, "never seen before")]
    return spark.createDataFrame(rows, "id long, text string").repartition(3)


def test_texts_of_a_topic_are_near_each_other(topics):
    found = evaluate.word_vector_mean(topics, "id", "text", 8, 5, 2).collect()
    assert len(found) == 1503 and sum(r["id"] is None for r in found) == 1
    means = {r["id"]: np.array(r["mean"]) for r in found}
    assert not means[5000].any() and not means[5001].any() and all(len(v) == 8 for v in means.values())
    kinds = [np.array([means[i] for i in range(1400) if i % 2 == k]) for k in (0, 1)]
    centers = [k.mean(axis=0) for k in kinds]
    spread = max(np.linalg.norm(k - c, axis=1).mean() for k, c in zip(kinds, centers))
    assert np.linalg.norm(centers[0] - centers[1]) > 3 * spread


def test_a_mean_is_over_all_tokens_of_a_text(topics):
    found = {r["id"]: np.array(r["mean"]) for r in evaluate.word_vector_mean(topics, "id", "text", 8, 5, 1).collect()}
    known = evaluate.word_vector_mean(
        topics.unionByName(topics.sparkSession.createDataFrame([(9000, "a1word"), (9001, "b1word")], "id long, text string")), "id", "text", 8, 5, 1
    )
    one = {r["id"]: np.array(r["mean"]) for r in known.filter(F.col("id") >= 9000).collect()}
    assert found[None] == pytest.approx((one[9000] + one[9001]) / 3, abs=0.05)


def test_no_word_reaches_the_driver(topics, monkeypatch):
    """Neither Spark's ``Word2Vec``, which collects the vocabulary, nor a table is read by the driver."""
    from pyspark.ml.feature import Word2Vec
    from pyspark.sql.classic.dataframe import DataFrame

    def refused(*a, **b):
        raise AssertionError("collected")

    monkeypatch.setattr(Word2Vec, "fit", refused)
    for name in ("collect", "toArrow", "toPandas"):
        plain = getattr(DataFrame, name)
        monkeypatch.setattr(DataFrame, name, lambda self, *a, plain=plain, **b: plain(self.limit(2), *a, **b) if self.columns[0].startswith("sum(") else refused())
    found = evaluate.word_vector_mean(topics, "id", "text", 8, 5)
    monkeypatch.undo()
    assert found.count() == 1503
