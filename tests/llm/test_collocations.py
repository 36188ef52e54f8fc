"""Collocations against plain counting of all phrases."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from quillspark.llm import collocations

DOCS = "doc_id long, text string, lang string, words string, w1 int"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, order=5, min_count=3, top=2000, inside=100):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, order + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    found = {key: c for key, c in f.items() if len(key[1]) > 1 and c >= min_count}
    held = Counter()
    for (lang, words), c in found.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                held[lang, words[i : i + size]] = max(held[lang, words[i : i + size]], c)
    rows = []
    for (lang, words), a in found.items():
        if held[lang, words] and 100 * held[lang, words] >= inside * a:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = f[lang, words[:k]], f[lang, words[k:]]
            cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        rows.append((lang, " ".join(words), a, left, right, n[lang], score))
    out = []
    for lang in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(lang, i + 1, *r[1:]) for i, r in enumerate(mine[:top])]
    return sorted(out)


def found(spark, docs, **options):
    table = spark.createDataFrame([(*d, "x", 1) for d in docs], DOCS)
    return sorted(map(tuple, collocations.find_collocations(table, **options).collect()))


@pytest.mark.parametrize("seed, block", [(0, 300), (1, 2000), (2, 1 << 20)])
def test_equals_plain_counting(spark, seed, block):
    draw = random.Random(seed)
    vocabulary = ["the", "The", "of", "a", "É", "é", "b c", "\x00", "—"] + [f"w{i}" for i in range(20)]
    ends = [" ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", "; "]
    docs = []
    for i in range(300):
        text = "".join(draw.choice(vocabulary) + draw.choice(ends) for _ in range(draw.randint(0, 40)))
        if draw.random() < 0.3:
            text += " the same five words again and again"
        docs.append((i, text, draw.choice(["en", "en", "en", "fr", None])))
    options = {"min_count": 8, "block_bytes": block}
    assert found(spark, docs, **options) == plain(docs, min_count=8)
    assert found(spark, docs, top=7, inside_percent=60, order=3, **options) == plain(docs, order=3, min_count=8, top=7, inside=60)
    assert found(spark, docs, order=2, **options) == plain(docs, order=2, min_count=8)


def test_odd_rows(spark):
    docs = [
        (None, None, "en"),
        (1, "", None),
        (1, " \t.,\n", "en"),
        (2, "a b a b a b a b", "en"),  # overlaps count
        (2, "a b a b a b a b", "en"),
        (3, "x y " * 60_000, None),
        (4, "z", "fr"),
        (5, "q" * 300_000 + " r " + "q" * 300_000 + " r", "fr"),
        (6, "q" * 300_000 + " r", "fr"),
    ]
    assert found(spark, docs, min_count=3) == plain(docs, min_count=3)
    assert found(spark, docs[:3], min_count=1) == []
    assert found(spark, [], min_count=1) == []


def test_score_is_exact_beyond_64_bits(spark):
    counted = spark.createDataFrame([("en", ["a", "b"], 4 * 10**9), ("en", ["a"], 5 * 10**9), ("en", ["b"], 4 * 10**9)], "lang string, words array<string>, f long")
    totals = spark.createDataFrame([("en", 9 * 10**12)], "lang string, n long")
    real, collocations.count_phrases = collocations.count_phrases, lambda *a: (counted, totals)
    try:
        (row,) = collocations.find_collocations(counted.selectExpr("lang", "'' AS text")).collect()
    finally:
        collocations.count_phrases = real
    assert row.score == 1000 * 4 * 10**9 * 9 * 10**12 // (5 * 10**9 * 4 * 10**9)


def test_windows_end_where_triples_do():
    stream = np.array([0, 1, 2, 3, -1, 0, 1, 2, 3, 0, 1])
    goes_on = np.array([1, 1, 0, 0, 0, 1, 1, 0, 0, 0, 0]).astype(bool)
    lead, n = collocations.windows_of(stream, goes_on, 4, 5, 3)
    assert sorted(zip(map(tuple, lead.tolist()), n.tolist())) == [((0, 1, 2, 3, -1), 2), ((1, 2, 3, -1, -1), 2)]
