"""Vocabularies from the pairs of frequent words alone."""

import random

import pytest
from pyspark.sql import functions as F

from quillspark.functions.tokens import bigrams, term_counts
from quillspark.operators import vocabulary
from quillspark.plans import features

ASKED = [(30, 2, 0.95), (60, 1, 1.0)]


@pytest.fixture(scope="module")
def tokens(spark):
    """Few words make most of the texts, and many occur once or twice; one is in every text."""
    draw = random.Random(3)
    rows = []
    for i in range(150):
        words = [f"w{int(draw.paretovariate(0.7))}" for _ in range(40)] + ["all_", "over"]
        rows.append((i, i % 5, words if i % 40 else []))
    return spark.createDataFrame(rows, "id int, fold int, kept array<string>").cache()


def plain(tokens):
    both = F.concat("kept", bigrams(F.col("kept")))
    return vocabulary.term_doc_freq(tokens.select(F.inline(term_counts(both))))


def top(frequencies, n, limits):
    return sorted(vocabulary.vocabulary(frequencies, n, *limits).select("term", "corpus_count", "doc_freq").collect())


@pytest.mark.parametrize("asked", [[a] for a in ASKED] + [ASKED, [(10**6, 1, 1.0)]])
def test_vocabularies_are_whole(tokens, asked):
    found, whole = vocabulary.candidate_frequencies(tokens, "kept", asked), plain(tokens)
    assert all(top(found, 150, limits) == top(whole, 150, limits) for limits in asked)


@pytest.mark.parametrize("most", [0, 1000])
def test_folds_have_vocabularies_of_their_own(tokens, most):
    found = vocabulary.candidate_frequencies(tokens, "kept", ASKED, range(5), most)
    for k in range(5):
        outside = tokens.filter(F.col("fold") != k)
        n, whole = outside.count(), plain(outside)
        assert all(top(vocabulary.outside_fold(found, k), n, limits) == top(whole, n, limits) for limits in ASKED)


def test_rare_pairs_are_not_counted(tokens):
    pairs = plain(tokens).filter(F.col("term").contains(" ")).count()
    kept = vocabulary.candidate_frequencies(tokens, "kept", ASKED).filter(F.col("term").contains(" ")).count()
    assert 0 < kept < pairs / 5


@pytest.fixture(scope="module")
def texts(tokens):
    return tokens.select("id", F.concat_ws(" ", "kept").alias("t"))


@pytest.mark.parametrize("top, first", [(5, 4), (20, 12), (20, 300), (100, 3), (10**5, 50)])
def test_leading_ngrams_are_whole(tokens, texts, top, first):
    found = vocabulary.ngram_frequencies(texts, "t", top, first=first).collect()
    grams = {1: {}, 2: {}, 3: {}}
    for row in tokens.collect():
        for n in grams:
            for i in range(len(row.kept) - n + 1):
                gram = " ".join(row.kept[i : i + n])
                grams[n][gram] = grams[n].get(gram, 0) + 1
    for n, counts in grams.items():
        plain = sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:top]
        mine = sorted((r.place, r.gram, r.n) for r in found if r.size == n)
        assert mine == [(i + 1, gram, c) for i, (gram, c) in enumerate(plain)]


def test_ngrams_of_rare_words_are_not_made(texts, monkeypatch):
    seen, made = [], vocabulary.whole_ngrams
    monkeypatch.setattr(vocabulary, "whole_ngrams", lambda t, n: seen.append(n) or made(t, n))
    listed, used = [], vocabulary.words_used
    monkeypatch.setattr(vocabulary, "words_used", lambda *a: listed.append(used(*a)) or listed[-1])
    vocabulary.ngram_frequencies(texts, "t", 3, first=12).collect()
    assert seen == [2, 3] and len(listed) == 1 and 12 <= len(listed[0]) < 30


def test_weights_of_a_tokenised_table(spark, texts):
    docs = texts.withColumnRenamed("t", "clean_text")
    vocab = vocabulary.vocabulary(plain_terms(docs), 150, 30, 2, 0.95)
    weights = [
        {(r.id, r.term): r.weight for r in features.tfidf_table(table, "id", "clean_text", vocab, 150).collect()}
        for table in (docs, features.tokenised(docs))
    ]
    assert weights[0] == weights[1] and len(weights[0]) > 30


def plain_terms(docs):
    return vocabulary.term_doc_freq(vocabulary.document_terms(docs, "id", "clean_text"))
