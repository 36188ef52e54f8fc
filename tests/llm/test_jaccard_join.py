"""The similarity join against all pairs of plain Python sets; sf tables against SQL are in test_queries."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspark.llm import jaccard_join as jj
from quillspark.llm.shingles import shingle_sets

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def shingles(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]) and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    least = {}
    for (doc, _), x in zip(rows, label):
        least[x] = min((v for v in (least.get(x), doc) if v is not None), default=None)
    return [(rows[i][0], len(sets[i]), least[label[i]]) for i in range(len(rows))]


def edited(r, words, share):
    return [w if r.random() > share else f"new{r.randrange(10**6)}" for w in words]


def corpus(seed, groups=6, copies=30):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = r.choices(vocabulary, k=30)
    texts = [None, "", " \t ", "one", "One", "one two three four", "ONE two\x0bthree four", "a b c d e", "é x é"]
    for _ in range(groups):
        base = r.choices(vocabulary, k=r.choice((5, 6, 8, 12, 20, 40, 90, 300)))
        for _ in range(r.randrange(copies)):
            words = edited(r, base, r.choice((0, 0.01, 0.03, 0.06)))
            if r.random() < 0.3:
                words = words[r.randrange(3) :]
            if r.random() < 0.2:
                words = words + passage
            texts.append(" ".join(words))
    for _ in range(60):  # a passage that many texts share
        texts.append(" ".join(passage + r.choices(vocabulary, k=r.randrange(3, 60))))
    return [(i * 7 % 1009, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_equal_all_pairs(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, handle int").repartition(3)
    hot = 2 if seed == 3 else jj.HOT  # nearly every signature takes the way of the hot ones
    got = jj.link_documents(docs, parts=7, hot_size=hot).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows))


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 400), st.integers(0, 10**9))
def test_similar_sets_share_a_signature(size, seed):
    """After allocation too, if all but one common signature were the most frequent ones."""
    r = np.random.default_rng(seed)
    a = r.integers(0, 2**63, size, np.uint64)
    drop = int(r.integers(0, size // 4 + 1))
    b = a[drop:]
    add = int(r.integers(0, size // 4 + 1))
    b = np.concatenate([b, r.integers(0, 2**63, add, np.uint64)])
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b))
    if 100 * both < 75 * (len(a) + len(b) - both):
        return
    sig, doc, band, slack = jj.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
    by_set = [{(int(s), int(k)): int(x) for s, k, x, d in zip(sig, band, slack, doc) if d == i} for i in (0, 1)]
    common = set(by_set[0]) & set(by_set[1])
    assert common
    found = False
    for scheme in {k for _, k in common}:
        hot = sorted(c for c in common if c[1] == scheme)  # the worst case: all common signatures are the most frequent
        cut = [max([x for (_, k), x in s.items() if k == scheme], default=0) for s in by_set]
        found |= len(hot) > max(cut)
    assert found


def test_pairs_whose_shingles_fall_into_few_segments_meet():
    """Sets of 6 and 8 shingles at 0.75, and others that small: no pair is lost, wherever the shingles fall."""
    r = np.random.default_rng(11)
    for small, large, pairs in ((6, 8, 60_000), (7, 9, 20_000), (9, 12, 20_000), (3, 4, 20_000), (12, 16, 5_000)):
        # a third of the pairs crowd into one segment or two of the larger set's scheme
        flat = r.integers(0, 2**63, (pairs, large), np.uint64)
        m = int(jj.segments_of(np.searchsorted(jj.BANDS, [large]))[0])
        crowd = flat[: pairs // 3]
        crowd[:] = (((crowd >> np.uint64(24)) * np.uint64(m) + (crowd & np.uint64(1)) * (crowd[:, :1] & np.uint64(1))) << np.uint64(20)) | (crowd & np.uint64(0xFFFFF))
        both = np.concatenate([flat, flat[:, :small]], axis=1).ravel()
        at = np.concatenate([[0], np.cumsum(np.tile([large, small], pairs))])
        sig, doc, band, _ = jj.signatures(both, at)
        key = np.stack([sig, band.astype(np.uint64), (doc // 2).astype(np.uint64)], axis=1)
        of = [np.unique(key[doc % 2 == i], axis=0) for i in (0, 1)]
        rows, count = np.unique(np.concatenate(of), axis=0, return_counts=True)
        assert len(np.unique(rows[count == 2][:, 2])) == pairs


def test_a_pair_in_one_segment_is_linked(spark):
    words = (
        "w704128507 w214064940 w397765063 w455610068 w63569151 w615324659 w743420517 w10415717 w836713322 "
        "w921706004 w598475240 w644827132"
    ).split()
    rows = [(1, " ".join(words)), (2, " ".join(words[:10])), (3, "other words that link with nothing at all")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, jj.link_documents(docs).collect())) == [(1, 8, 1), (2, 6, 1), (3, 4, 3)]


def test_sketch_never_exceeds_the_difference():
    r = np.random.default_rng(5)
    for _ in range(200):
        a = np.unique(r.integers(0, 2**63, int(r.integers(1, 300)), np.uint64))
        b = np.unique(np.concatenate([a[int(r.integers(0, len(a))) :], r.integers(0, 2**63, int(r.integers(0, 900)), np.uint64)]))
        if len(b):
            assert jj.sketch_distance(jj.sketch(a), jj.sketch(b)) <= len(np.setxor1d(a, b))


def test_packed_records_come_back():
    r = np.random.default_rng(6)
    columns = [r.integers(0, 2**40, 500, np.uint64), r.integers(0, 2**60, 500), r.integers(0, 70, 500), r.integers(0, 9, 500)]
    order = np.argsort(columns[1], kind="stable")
    for mine, back in zip(columns, jj._unpack(jj._pack(columns))):
        assert (mine[order] == back).all()


def test_long_texts_and_odd_rows(spark):
    long = " ".join(f"t{i % 7919}x{i}" for i in range(30_000))
    rows = [(1, long), (2, long + " end"), (None, "a b c"), (None, "a b c"), (3, "a b c"), (4, "x y"), (4, "x y"), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted(map(tuple, jj.link_documents(docs).collect()), key=key) == sorted(brute(rows), key=key)
    assert jj.link_documents(docs.limit(0)).count() == 0


def test_words_shorter_than_a_shingle():
    texts = [b"a b", b"A B", b"a b c d e", b"", b"b a"]
    flat, at = shingle_sets(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts]))
    assert np.diff(at).tolist() == [1, 1, 1, 0, 1] and flat[0] == flat[1] and flat[0] != flat[3]
