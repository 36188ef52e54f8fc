"""The seven checks a generated text has to face, and the gate that weighs them."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark import fixed_values as fv
from quillspark.functions.text import WORD, let, sentences, strip, word_count
from quillspark.functions.tokens import keywords, max_bigram_count

CHECKS = (
    "length_valid",
    "topic_consistent",
    "not_empty",
    "not_too_short",
    "no_prompt_leakage",
    "no_repetition",
    "scientific_style",
)


def _any_of(phrases: tuple[str, ...]) -> str:
    return "|".join(re.escape(p) for p in phrases)


def length_bounds(length: Column, tolerance: float = fv.LENGTH_TOLERANCE) -> tuple[Column, Column]:
    """Shortest and longest acceptable counterpart, truncated to whole characters."""
    return (
        F.floor(length * F.lit(1 - tolerance)).cast("bigint"),
        F.floor(length * F.lit(1 + tolerance)).cast("bigint"),
    )


def length_valid(original: Column, generated: Column) -> Column:
    low, high = length_bounds(F.length(original))
    size = F.length(generated)
    return size.between(low, high) & size.between(fv.MIN_GENERATED_CHARS, fv.MAX_GENERATED_CHARS)


def keyword_overlap(wanted: Column, found: Column, floor: int = 0) -> Column:
    """Share of the wanted keywords that were found; ``floor`` guards an empty set."""
    whole = F.greatest(F.size(wanted), F.lit(floor)) if floor else F.size(wanted)
    return F.try_divide(F.size(F.array_intersect(wanted, found)).cast("double"), whole)


def topic_consistent(original: Column, generated: Column, title: Column) -> Column:
    found = keywords(generated)
    return let(
        F.struct(keywords(original).alias("text"), keywords(title).alias("title"), found.alias("found")),
        lambda k: (F.size(k["text"]) == 0)
        | (keyword_overlap(k["text"], k["found"]) >= fv.TOPIC_THRESHOLD)
        | (keyword_overlap(k["title"], k["found"], 1) >= fv.TOPIC_THRESHOLD),
    )


def not_empty(generated: Column) -> Column:
    return F.length(strip(generated)) > 0


def not_too_short(generated: Column) -> Column:
    return F.length(generated) >= fv.MIN_GENERATED_CHARS


def no_prompt_leakage(generated: Column) -> Column:
    return ~F.lower(generated).rlike(_any_of(fv.LEAKAGE_PHRASES))


def distinct_sentence_share(text: Column) -> Column:
    return let(
        sentences(text),
        lambda s: F.try_divide(F.size(F.array_distinct(s)).cast("double"), F.size(s)),
    )


def no_repetition(generated: Column) -> Column:
    n_words = word_count(generated)
    repeated_sentences = distinct_sentence_share(generated) < fv.DISTINCT_SENTENCE_SHARE
    repeated_pairs = (n_words >= fv.REPETITION_MIN_WORDS) & (
        max_bigram_count(generated) > n_words * fv.REPEATED_BIGRAM_SHARE
    )
    enough = F.size(sentences(generated)) >= 2
    return ~F.when(enough, repeated_sentences | repeated_pairs).otherwise(F.lit(False))


def scientific_style(generated: Column) -> Column:
    lowered = F.lower(generated)
    n_words = word_count(generated)
    personal = F.regexp_count(
        lowered, F.lit(rf"(?<!{WORD})(?:{'|'.join(fv.FIRST_PERSON)})(?!{WORD})")
    )
    informal = sum(
        (lowered.contains(word).cast("int") for word in fv.INFORMAL_WORDS), start=F.lit(0)
    )
    too_personal = (n_words > 0) & (personal / n_words > fv.FIRST_PERSON_SHARE)
    return ~(
        F.coalesce(too_personal, F.lit(False))
        | (informal > fv.INFORMAL_LIMIT)
        | lowered.rlike(_any_of(fv.CONVERSATIONAL))
    )


def quality_checks(original: Column, generated: Column, title: Column) -> dict[str, Column]:
    return {
        "length_valid": length_valid(original, generated),
        "topic_consistent": topic_consistent(original, generated, title),
        "not_empty": not_empty(generated),
        "not_too_short": not_too_short(generated),
        "no_prompt_leakage": no_prompt_leakage(generated),
        "no_repetition": no_repetition(generated),
        "scientific_style": scientific_style(generated),
    }


def quality_gate(
    checks: dict[str, Column],
    strict: bool = False,
    required: tuple[str, ...] = fv.REQUIRED_CHECKS,
    share: float = fv.PASS_SHARE,
) -> Column:
    """Lenient: at least ``share`` of the checks.  Strict: every required check."""
    if strict:
        passed = F.lit(True)
        for name in required:
            passed = passed & checks.get(name, F.lit(True))
        return passed
    total = sum((c.cast("int") for c in checks.values()), start=F.lit(0))
    return total >= F.lit(len(checks) * share)
