"""The bigram score beside plain counting, and the shape of its job."""

import math
import random
from collections import Counter

import pytest

from quillspark.operators import bayes


def test_score_equals_plain_counting(spark):
    draw = random.Random(5)
    texts = {i: [f"w{int(draw.paretovariate(0.8))}" for _ in range(draw.choice([0, 1, 2, 30]))] for i in range(120)}
    texts[120] = ["aa", "bb", "aa", "aa"]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "d int, t string")
    words = Counter(w for t in texts.values() for w in t)
    pairs = Counter(p for t in texts.values() for p in zip(t, t[1:]))
    plain = {
        i: (len(t) - 1, -sum(math.log((pairs[p] + 1) / (words[p[0]] + len(words))) for p in zip(t, t[1:])) / (len(t) - 1))
        for i, t in texts.items() if len(t) > 1
    }
    mine = {r["d"]: (r["pairs"], r["cross_entropy"]) for r in bayes.bigram_lm_score(docs, "d", "t").collect()}
    assert mine.keys() == plain.keys()
    assert all(mine[i][0] == n and mine[i][1] == pytest.approx(x, abs=1e-6) for i, (n, x) in plain.items())


def test_terms_meet_in_one_exchange(spark):
    docs = spark.createDataFrame([(1, "aa bb aa"), (2, "aa bb")], "d int, t string")
    plan = bayes.bigram_lm_score(docs, "d", "t")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Window ") == 1
