"""Context-tree weighting against a plain recursion over dictionaries; the base score against Python counts."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from quillspark.llm import context_tree as ct
from quillspark.llm.queries import op3_context_tree

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def base(rows):
    train = [lower(t) for d, t in rows if d is not None and zlib.crc32(str(d).encode()) % 5 != 1]
    c = Counter(w for t in train for w in WORD.findall(t))
    c["\n"] = len(train)
    n, v = sum(c.values()), sum(1 for x in c.values() if x)
    out = {}
    for d, t in rows:
        tokens = [*WORD.findall(lower(t)), "\n"]
        s = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        out[d] = (len(tokens), sum(c[w] > 0 for w in tokens), n, s)
    return out


def tree(texts, depth):
    """(context, prefix) -> counts; contexts are bytes, prefixes tuples of bits."""
    nodes = {}
    for t in texts:
        data = b"\0" * depth + lower(t).encode() + b"\xff"
        for i in range(depth, len(data)):
            bits = [data[i] >> (7 - k) & 1 for k in range(8)]
            for d in range(depth + 1):
                for k in range(8):
                    nodes.setdefault((data[i - d : i], tuple(bits[:k])), [0, 0])[bits[k]] += 1
    return nodes


def model(texts, depth):
    nodes = tree(texts, depth)

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    longer, weighted = {}, {}
    for context, prefix in sorted(nodes, key=lambda k: -len(k[0])):
        own = kt(*nodes[context, prefix])
        below = longer.get((context, prefix))
        weighted[context, prefix] = own if below is None else np.logaddexp(own, below) - math.log(2)
        if context:
            up = (context[1:], prefix)
            longer[up] = longer.get(up, 0.0) + weighted[context, prefix]

    def score(text):
        data, total = b"\0" * depth + lower(text).encode() + b"\xff", 0.0
        for i in range(depth, len(data)):
            bits = [data[i] >> (7 - k) & 1 for k in range(8)]
            for k in range(8):
                p = None
                for d in range(depth, -1, -1):
                    key = (data[i - d : i], tuple(bits[:k]))
                    if key not in nodes:
                        continue
                    own = (nodes[key][bits[k]] + 0.5) / (sum(nodes[key]) + 1)
                    if p is not None:
                        w = 1 / (1 + math.exp(min(700, longer[key] - kt(*nodes[key]))))
                        own = w * own + (1 - w) * p
                    p = own
                total += math.log10(0.5 if p is None else p)
        return total

    return score


@pytest.mark.parametrize("chunk_nodes", [10**7, 40])
def test_scores_equal_a_plain_recursion(spark, chunk_nodes):
    texts = ["the cat sat", "The hat", "", None, "äö ä", "cats and hats " * 3, "zq", "the the the", "\x00a", "tail"] * 2
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double").repartition(3)
    got = {r.doc_id: r for r in ct.score_texts(docs, depth=3, parts=5, chunk_nodes=chunk_nodes).collect()}
    train = [t for d, t in rows if zlib.crc32(str(d).encode()) % 5 != 1]
    score, want = model(train, 3), base(rows)
    assert len(got) == len(rows) and any(r.held_out for r in got.values())
    for d, t in rows:
        assert math.isclose(got[d].score, score(t), rel_tol=1e-5, abs_tol=1e-6)  # nodes are kept in single precision
        r = got[d]
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[d][:3] and math.isclose(r.base_score, want[d][3], rel_tol=1e-9)


def test_a_byte_has_probability_one_in_all():
    texts = ["abab", "abc", "b"]
    data = b"".join(t.encode() for t in texts)
    grams, begin = ct.strings(np.frombuffer(data, np.uint8), np.cumsum([0] + [len(t) for t in texts]), 2)
    keys, zeros, ones = ct.leaf_nodes(*np.unique(grams, return_counts=True))
    levels, longer = [], None
    for size in (2, 1, 0):
        weight, weighted = ct.weigh(zeros.astype(float), ones.astype(float), longer)
        levels.insert(0, (keys, (ones + 0.5) / (zeros + ones + 1), weight))
        keys, zeros, ones, longer = ct._merge(ct.shorten(keys, max(size - 1, 0)), zeros, ones, weighted)
    nodes = ct.Nodes(*(list(c) for c in zip(*levels)))
    for context in (b"ab", b"zz", b"\0a"):
        every = np.array([context[0] << 16 | context[1] << 8 | s for s in range(256)], np.uint64)
        assert math.isclose(np.exp2(-nodes.bits(every)).sum(), 1.0, rel_tol=1e-9)


def test_log_gamma():
    x = np.array([0.5, 1.0, 3.25, 1000.5, 1e7])
    assert np.allclose(ct.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-10, atol=1e-10)


def test_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = op3_context_tree(spark, sf_dir).collect()
    want = base([(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()])
    assert len(rows) == len(want)
    for r in rows:
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:3]
        assert math.isclose(r.base_score, want[r.doc_id][3], rel_tol=1e-9)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1)
    held = [r for r in rows if r.held_out]
    n_bytes = {r.doc_id: len(r.text.encode()) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    # bits per byte; the corpus is small, larger ones come to about two
    assert -sum(r.score for r in held) / np.log10(2) < 2.8 * sum(n_bytes[r.doc_id] for r in held)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, "a b"), (6, "held " * 30_000), (6, "again"), (6, None)], "doc_id long, text string")
    got = ct.score_texts(docs).collect()
    assert len(got) == 4 and all(math.isfinite(r.score) for r in got)
    alone = ct.score_texts(docs.filter("doc_id IS NULL")).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in alone] == [(3, 0, 0, 0.0)]
    assert math.isclose(alone[0].score, 4 * 8 * math.log10(0.5))
    assert ct.score_texts(docs.limit(0)).count() == 0
