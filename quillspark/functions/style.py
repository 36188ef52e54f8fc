"""Numeric style features of one text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.text import (
    NOT_SPACE,
    let,
    occurrences,
    sentences,
    word_count,
    words,
)


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def distinct_word_share(text: Column) -> Column:
    return let(
        words(F.lower(text)), lambda w: _ratio(F.size(F.array_distinct(w)), F.size(w))
    )


def linguistic_features(text: Column) -> dict[str, Column]:
    """Eight features; empty text scores zero throughout."""
    length = F.length(text)
    pieces = F.filter(F.split(text, r"\."), lambda s: s.rlike(NOT_SPACE))
    marks = F.regexp_count(text, F.lit("[!?]"))
    capitals = F.regexp_count(text, F.lit(r"\p{Lu}"))
    common = occurrences(text, "the") + occurrences(text, "and") + occurrences(text, "of")
    return {
        "char_length": length.cast("bigint"),
        "word_total": word_count(text).cast("bigint"),
        "sentence_total": F.size(pieces).cast("bigint"),
        "comma_density": _ratio(occurrences(text, ","), length) * 1000,
        "exclaim_question": marks.cast("bigint"),
        "uppercase_share": _ratio(capitals, length) * 100,
        "common_words": common.cast("bigint"),
        "vocabulary_diversity": distinct_word_share(text),
    }


def style_features(text: Column) -> dict[str, Column]:
    n_words = word_count(text)
    letters = F.length(F.regexp_replace(text, r"[^\p{L}\p{N}]", ""))
    marks = F.regexp_count(text, F.lit(r"[.,;:!?\-()]"))
    return {
        "mean_sentence_words": _ratio(n_words, F.size(sentences(text))),
        "mean_word_chars": _ratio(letters, n_words),
        "type_token_ratio": distinct_word_share(text),
        "punctuation_density": _ratio(marks, F.length(text)),
    }


def flesch_kincaid(text: Column) -> Column:
    """Grade level, with vowel groups standing in for syllables."""
    n_words = word_count(text)
    syllables = F.regexp_count(F.lower(text), F.lit("[aeiouy]+"))
    grade = (
        0.39 * _ratio(n_words, F.size(sentences(text)))
        + 11.8 * _ratio(syllables, n_words)
        - 15.59
    )
    return F.when((n_words > 0) & (F.size(sentences(text)) > 0), grade).otherwise(F.lit(0.0))


def burstiness(text: Column) -> Column:
    """Spread of sentence lengths: population deviation over mean."""
    lengths = F.transform(sentences(text), lambda s: word_count(s).cast("double"))

    def spread(a: Column) -> Column:
        total = F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
        return let(
            total / F.size(a),
            lambda mean: F.sqrt(
                F.aggregate(a, F.lit(0.0), lambda s, x: s + (x - mean) * (x - mean)) / F.size(a)
            )
            / mean,
        )

    return let(lengths, lambda a: F.when(F.size(a) > 0, spread(a)).otherwise(F.lit(0.0)))
