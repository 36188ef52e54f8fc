"""FM-index search against plain Python; the query itself is compared with SQL in test_queries."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspark.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = WORD.findall(lower(text))
        size = min(13, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(item)
    out = []
    for text in docs:
        w, hit, found = WORD.findall(lower(text)), set(), set()
        for gram, names in windows.items():
            for i in range(len(w) - len(gram) + 1):
                if tuple(w[i : i + len(gram)]) == gram:
                    hit.update(range(i, i + len(gram)))
                    found |= names
        out.append((len(w), len(hit), sorted(map(str, found))))
    return out


def mine(docs, items):
    texts = [(t or "").encode() for t in docs]
    offsets = np.cumsum([0] + [len(t) for t in texts])
    n, spans, names = dc.search_shard(np.frombuffer(b"".join(texts), np.uint8), offsets, dc.Windows.of([(str(i), t) for i, t in items]))
    assert all(a < b and (not i or s[i - 1][1] < a) for s in spans for i, (a, b) in enumerate(s))
    return [(int(n[i]), sum(b - a for a, b in spans[i]), names[i]) for i in range(len(docs))]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6))
def test_search_equals_brute_force(seed):
    r = random.Random(seed)
    words = r.choice((["a", "b"], ["a", "b", "c", "é", "x1"], [f"w{i}" for i in range(40)]))
    items = [(k, " ".join(r.choices(words, k=r.choice((0, 1, 2, 5, 13, 14, 20))))) for k in range(4)]
    docs = []
    for _ in range(12):
        parts = r.choices(words + ["zz", "Q!"], k=r.randrange(0, 40))
        if r.random() < 0.6:
            parts.insert(r.randrange(len(parts) + 1), r.choice(items)[1].upper())
        docs.append(r.choice((", ", " ", "\n")).join(parts))
    docs += docs[:2]
    assert mine(docs, items) == brute(docs, items)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60))
def test_suffix_order(text):
    text = np.array(text)
    assert dc.suffix_order(text).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 150])
def test_odd_rows(spark, chunk_bytes):
    item = " ".join(f"word{i}" for i in range(15))
    rows = [(1, None), (2, ""), (3, item), (3, item), (4, "x " * 40_000 + item), (None, item.upper()), (5, "Short one!"), (6, "!!! ???")]
    docs = spark.createDataFrame([(*r, "k", 7) for r in rows], "doc_id long, text string, spans string, n_words int")
    bench = spark.createDataFrame(
        [(10, item), (9, item), (9, item), (8, None), (None, "short"), (7, "short ONE"), (6, "")], "item_id long, text string"
    )
    got = dc.find_benchmark(docs, bench, ("doc_id",), chunk_bytes).collect()
    want = brute([r[1] for r in rows], [(10, item), (9, item), (7, "short ONE")])
    key = lambda r: (r[0] is not None, r)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in got), key=key) == sorted(
        ((d[0], *w) for d, w in zip(rows, want)), key=key
    )
    assert {r.doc_id for r in got if r.contaminated} == {3, 5, None}
    whole = dc.find_benchmark(docs, bench, tuple(docs.columns), chunk_bytes)
    assert whole.filter("contaminated").count() == 4 and "text" in whole.columns


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 100])
def test_items_without_id_hit(spark, chunk_bytes):
    own, other, both = (" ".join(f"{k}{i}" for i in range(14)) for k in ("own", "other", "both"))
    docs = spark.createDataFrame([(1, f"x {own} y"), (2, other), (3, f"{both} {own}"), (4, "clean")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, own), (None, both), (5, both), (6, other)], "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.item_ids, r.contaminated) for r in dc.find_benchmark(docs, bench, chunk_bytes=chunk_bytes).collect()}
    assert got == {1: (16, 14, [], True), 2: (14, 14, ["6"], True), 3: (28, 28, ["5"], True), 4: (1, 0, [], False)}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in dc.find_benchmark(docs, none).collect()] == [0]
    assert dc.find_benchmark(docs.limit(0), none).count() == 0


def test_words_that_share_a_hash_do_not_hit(monkeypatch):
    plain = dc.words_of

    def crowded(data, offsets):
        low, starts, stops, hashes = plain(data, offsets)
        for i, (a, b) in enumerate(zip(starts, stops)):
            if low[a:b].tobytes() in (b"other", b"third"):
                hashes[i] = plain(np.frombuffer(b"same", np.uint8), np.array([0, 4]))[3][0]
        return low, starts, stops, hashes

    monkeypatch.setattr(dc, "words_of", crowded)
    items = [("i", "same one two"), ("k", "two same")]
    docs = ["other one two same one two", "third one two", "two other", "x two same y two third", None]
    assert mine(docs, items) == brute(docs, items)
