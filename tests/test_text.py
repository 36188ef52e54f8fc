"""Cleaning, tokens, keywords and style features against hand-worked answers."""

import re

import pytest
from pyspark.sql import functions as F

from quillspark.functions import generation, labels, style, text, tokens

T = F.col("t")


def python_clean(t):
    if t is None:
        return ""
    t = re.sub(r"\s+", " ", t).strip()
    if not 50 <= len(t) <= 5000:
        return ""
    return re.sub(r"\s+", " ", re.sub(r"[^\w\s.,;:!?\-()]", " ", t)).strip()


ODD = "Café naïve é x² y z　a​b — 50% · #tag <b> \U0001d4d0 "


@pytest.mark.parametrize(
    "t",
    [None, "", "   ", "a" * 49, "a" * 50, "a" * 5000, "a" * 5001, "#" * 60, " " * 100 + "a" * 49,
     "a " * 25 + "  b", ODD * 3, "x\x0b\x1cy\x85z" * 20, "word   line  " * 10],
)
def test_clean_text_equals_its_plain_statement(value, t):
    assert value(t, text.clean_text(T)) == python_clean(t)


def test_clean_for_scoring_has_no_band(value):
    assert value("  short   text # ", text.clean_for_scoring(T)) == "short text"


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("Rewritten Abstract:  We study.", "We study."),
        ("HERE IS the text\nhere's more", "the text more"),
        ('"quoted"', "quoted"),
        ("\"'both'\"", "both"),
        ('"', ""),
        ("text\n--- \nend", "text end"),
        ("a [AI-Generated by x] b (generated by y) c", "a b c"),
        ("good. As an AI I refuse\nnext", "good. next"),
        ("Summary: x. Let's go still gone\nkept", "x. kept"),
        (None, ""),
    ],
)
def test_clean_generated(value, raw, expected):
    assert value(raw, text.clean_generated(T)) == expected


def test_word_count_and_sentences(value):
    assert value(" a b  c ", text.word_count(T)) == 3
    assert value("  ", text.word_count(T)) == 0
    assert value("A. B!? ... C", text.sentences(T)) == ["A", "B", "C"]


def test_links_and_marks(value):
    assert value("see http://a.b/c?d and me@x.org ok", text.strip_urls_emails(T)) == "see and ok"
    assert value("no!!! why?? end...", text.squeeze_punctuation(T)) == "no! why? end."


def test_entry_ids(value):
    url = "http://feed.example.org/abs/cond-mat/9312101v1"
    assert value(url, text.last_segment(T)) == "9312101v1"
    assert value(url, text.id_after_abs(T)) == "cond-mat/9312101v1"


def test_tokens_and_ngrams(value):
    assert value("The cat's 2nd été, a_b!", tokens.tokenize(T)) == ["the", "cat", "2nd", "été", "a_b"]
    assert value("the quick brown fox", tokens.unigrams_and_bigrams(T)) == [
        "quick", "brown", "fox", "quick brown", "brown fox",
    ]
    assert value("one", tokens.unigrams_and_bigrams(T)) == ["one"]
    assert value("", tokens.unigrams_and_bigrams(T)) == []
    assert value("aa bb cc", tokens.ngrams(tokens.tokenize(T), 3)) == ["aa bb cc"]
    assert value("ab", tokens.char_ngrams(T, 3)) == []
    assert value("a\U0001d4d0bc", tokens.char_ngrams(T, 3)) == ["a\U0001d4d0b", "\U0001d4d0bc"]


def test_term_counts(value):
    rows = value("bb aa bb cc aa bb", tokens.term_counts(tokens.tokenize(T)))
    assert [(r["term"], r["n"]) for r in rows] == [("aa", 2), ("bb", 3), ("cc", 1)]
    assert value("", tokens.term_counts(tokens.tokenize(T))) == []


def python_keywords(t, top, stop, pattern, least):
    counts = {}
    for w in re.findall(pattern, t.lower()):
        if w not in stop and len(w) >= least:
            counts[w] = counts.get(w, 0) + 1
    return sorted(counts, key=lambda w: counts[w], reverse=True)[:top]


KEYWORD_TEXTS = [
    "Alpha beta gamma beta data method alpha delta",
    "caféterie foo_barre state-of-the-art foo-éclair x—dash word3 3dmodel pre-été foo--barr",
    "graph-based graph based deep-learning2 deep-learning2 end- -start a-b-c-d tail_ mid-_x",
    "", "aaaa " * 30 + "bbbb " * 30,
]


@pytest.mark.parametrize("t", KEYWORD_TEXTS)
def test_keywords_equal_their_plain_statement(value, t):
    from quillspark import fixed_values as fv

    assert value(t, tokens.keywords(T)) == python_keywords(
        t, 10, fv.CHECK_STOP_WORDS, r"\b[a-zA-Z]{4,}\b", 4
    )
    assert value(t, tokens.prompt_keywords(T, 8)) == python_keywords(
        t, 8, fv.PROMPT_STOP_WORDS, r"\b[a-zA-Z][a-zA-Z0-9-]*[a-zA-Z0-9]\b|\b[a-zA-Z]{3,}\b", 4
    )


def test_linguistic_features(spark):
    t = "The cat and the Dog, of old. Yes! Why?"
    row = spark.createDataFrame([(t,), ("",)], "t string").select(
        *[c.alias(k) for k, c in style.linguistic_features(T).items()]
    ).collect()
    got = row[0].asDict()
    assert got["char_length"] == len(t) and got["word_total"] == 9
    assert got["sentence_total"] == 2 and got["exclaim_question"] == 2
    assert got["comma_density"] == pytest.approx(1 / len(t) * 1000)
    assert got["uppercase_share"] == pytest.approx(4 / len(t) * 100)
    assert got["common_words"] == t.count("the") + t.count("and") + t.count("of")
    assert got["vocabulary_diversity"] == pytest.approx(8 / 9)
    assert set(row[1].asDict().values()) == {0}


def test_burstiness_and_readability(value):
    assert value("a b. a b. a b.", style.burstiness(T)) == 0
    assert value("a. a b c.", style.burstiness(T)) == pytest.approx(0.5)
    assert value("", style.burstiness(T)) == 0
    assert value("The cat sat. It ran.", style.flesch_kincaid(T)) == pytest.approx(
        0.39 * 2.5 + 11.8 * 1.0 - 15.59
    )


def test_rewrites_touch_substrings_and_repeat(value):
    t = "we show between our method and results this paper shows analysis technique"
    first = value(t, generation.synthetic_rewrite_basic(T, F.lit(7)))
    assert first == value(t, generation.synthetic_rewrite_basic(T, F.lit(7))) != t


def test_rewrite_group_count(spark):
    t = "we this paper method analysis"
    changed = {"the researchers": 0, "this study": 1, "approach": 2, "examination": 3}
    rows = spark.range(200).select(
        generation.synthetic_rewrite_basic(F.lit(t), F.col("id")).alias("r")
    ).collect()
    assert {sum(w in r["r"] for w in changed) for r in rows} == {2, 3}


def test_mixed_document(spark):
    mixed = generation.mixed_document(F.lit("A. B. C"), F.lit("X. Y. Z. W"))
    assert spark.range(1).select(mixed).first()[0] == "A. B. Z. W"


def test_prompt_has_no_slots_left_and_keeps_braces_of_the_text(spark):
    docs = spark.range(50).withColumn("template", generation.template_name(F.col("id")))
    prompt = generation.build_prompt(
        F.col("template"), F.lit("Title {text}"), F.lit("body {title} words graph " * 5), F.array()
    )
    rows = docs.select("template", prompt.alias("p")).collect()
    assert len({r["template"] for r in rows}) > 3
    for r in rows:
        assert "{min_length}" not in r["p"] and "{categories}" not in r["p"]
        if r["template"] != "template_e":
            assert "Title {text}" in r["p"]


@pytest.mark.parametrize(
    "c, band", [(0.95, "Very High"), (0.9, "Very High"), (0.8, "High"), (0.7, "Moderate"), (0.69, "Low")]
)
def test_confidence_bands_are_inclusive(value, c, band):
    assert value("", labels.confidence_band(F.lit(c))) == band


@pytest.mark.parametrize("f1, grade", [(0.86, "PROCEED"), (0.85, "IMPROVE"), (0.75, "REDESIGN")])
def test_grade_edges_are_exclusive(value, f1, grade):
    assert value("", labels.performance_grade(F.lit(f1))) == grade


def test_length_targets(spark):
    row = spark.range(1).select(
        *[c.alias(k) for k, c in generation.length_targets(F.lit(1001)).items()]
    ).first()
    assert row.asDict() == {
        "min_length": int(1001 * 0.7), "max_length": int(1001 * 1.3),
        "target_words": int(1001 * 1.3) // 5, "max_tokens": 1000,
    }
