"""Spelling variants against comparing all words, at every way to deal them."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest

from quillspark.llm import spelling
from quillspark.llm.spelling import Acceptor, Composition

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def counted(docs, noise):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % noise == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    return n


def plain(docs, min_chars=6, min_count=5, noise=199):
    n = {w: c for w, c in counted(docs, noise).items() if len(w) >= min_chars and c >= min_count}
    near = {w: [] for w in n}
    for a, b in combinations(n, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w in n:
        best = min(near[w], key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] is not None else None))
    return sorted(out, key=repr)


def found(spark, docs, **options):
    table = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, word string, n int")
    return sorted((tuple(r[c] for c in COLUMNS) for r in spelling.group_variants(table, **options).collect()), key=repr)


def test_acceptor_and_pairs():
    draw = random.Random(5)
    for _ in range(60):
        signs = draw.choice(["ab", "abc", "aé"])
        words = sorted({"".join(draw.choice(signs) for _ in range(draw.randint(0, 6))) for _ in range(draw.randint(1, 60))})
        acceptor = Acceptor(words)
        assert len({(f, *a.items()) for f, a in zip(acceptor.final, acceptor.arcs)}) == len(acceptor.arcs)  # minimal
        assert all(acceptor.final[acceptor.path(w)[-1]] for w in words)
        assert sorted(Composition(acceptor).suffixes(acceptor.root, acceptor.root)) == words
        pairs = [tuple(sorted(p)) for p in Composition(acceptor).pairs(words)]
        assert sorted(pairs) == sorted(tuple(sorted(p)) for p in combinations(words, 2) if one_edit(*p))


@pytest.mark.parametrize("group_words", [1, 5, 40, 20_000])
def test_equals_comparing_all_words(spark, group_words):
    draw = random.Random(11)
    stems = ["".join(draw.choice("abÀé") for _ in range(draw.randint(5, 9))) for _ in range(25)]
    docs = []
    for i in range(400):
        words = []
        for _ in range(30):
            word = stems[min(int(draw.expovariate(0.25)), 24)]
            if draw.random() < 0.25:
                at = draw.randrange(len(word))
                word = word[:at] + draw.choice(["", "a", "b", "B"]) + word[at + draw.randint(0, 1) :]
            words.append(word)
        docs.append((i, draw.choice([" ", "-", "1"]).join(words)))
    docs += [(7, "Straße ×÷×÷×÷ naïve5naïve " * 30), (None, "abcdef " * 40), (None, "abcdeg " * 6)]
    want = plain(docs, noise=19)
    assert sum(r[1] is not None for r in want) > 20
    assert found(spark, docs, group_words=group_words, noise=19) == want


def test_chain_of_forms(spark):
    words = ["abcdef" + "x" * i for i in range(7)]
    docs = [(1, " ".join(w for i, w in enumerate(words) for _ in range(5 * 5**i)))]
    got = {r[0]: r for r in found(spark, docs, noise=10**10)}
    assert {r[2] for r in got.values()} == {words[-1]}
    assert got["abcdef"][1] == words[1] and got[words[-1]][1] is None
    assert sorted(got.values(), key=repr) == plain(docs, noise=10**10)


def test_odd_rows(spark):
    long = "a" * 30_000
    docs = [(1, None), (2, ""), (3, "12 __ ."), (4, f"{long} {long}b " * 5), (4, f"{long} {long}b " * 5), (5, f"{long} " * 50)]
    got = found(spark, docs, noise=10**10)
    assert got == sorted([(long, None, long, 60, 1, None), (long + "b", long, long, 10, 1, 60)], key=repr)
    assert found(spark, [(1, f"{'a' * 12} {'a' * 13} " * 5)], noise=10**10, group_words=1) == [("a" * 12, None, "a" * 12, 5, 1, None), ("a" * 13, None, "a" * 13, 5, 1, None)]
    assert found(spark, docs[:3]) == [] and found(spark, []) == []
