"""Tokens, n-grams and per-document counts, all inside one row.

Counting a document's terms in its own row (sort, then run lengths) leaves
nothing to shuffle but the per-term totals.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark import fixed_values as fv
from quillspark.functions.text import WORD, let, squash

TOKEN_PATTERN = WORD + "{2,}"
KEYWORD_PATTERN = rf"(?<!{WORD})[a-z]{{4,}}+(?!{WORD})"
HYPHEN_KEYWORD_PATTERN = (
    rf"(?<!{WORD})[a-z][a-z0-9]*+(?!{WORD})(?:-+[a-z0-9]++(?!{WORD}))*"
)


def tokenize(text: Column) -> Column:
    """Lower-case tokens of at least two word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def remove_stopwords(tokens: Column, stop_words: Sequence[str] = fv.ENGLISH_STOP_WORDS) -> Column:
    return F.filter(tokens, lambda t: ~t.isin(*stop_words))


def bigrams(tokens: Column) -> Column:
    return F.zip_with(
        F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(0))),
        F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b),
    )


def ngrams(tokens: Column, n: int) -> Column:
    """Every run of ``n`` consecutive tokens, joined by a space."""
    return let(
        tokens,
        lambda t: F.when(
            F.size(t) >= n,
            F.transform(
                F.sequence(F.lit(1), F.size(t) - n + 1),
                lambda i: F.array_join(F.slice(t, i, F.lit(n)), " "),
            ),
        ).otherwise(F.array().cast("array<string>")),
    )


def char_ngrams(text: Column, n: int) -> Column:
    """Every run of ``n`` consecutive characters."""
    return let(
        F.split(text, ""),
        lambda t: F.when(
            F.size(t) >= n,
            F.transform(
                F.sequence(F.lit(1), F.size(t) - n + 1),
                lambda i: F.array_join(F.slice(t, i, F.lit(n)), ""),
            ),
        ).otherwise(F.array().cast("array<string>")),
    )


def unigrams_and_bigrams(
    text: Column, stop_words: Sequence[str] = fv.ENGLISH_STOP_WORDS
) -> Column:
    """Terms of a document: stop words go first, then bigrams are formed."""
    return let(
        remove_stopwords(tokenize(text), stop_words), lambda t: F.concat(t, bigrams(t))
    )


def _run_starts(run: Column, same: Callable[[Column, Column], Column]) -> Column:
    """Positions in a sorted array where a new value begins."""
    return F.filter(
        F.sequence(F.lit(0), F.size(run) - 1),
        lambda i: (i == 0) | ~same(F.get(run, i), F.get(run, i - 1)),
    )


def term_counts(terms: Column) -> Column:
    """``array<struct<term, n>>``: each distinct term and its count."""
    empty = F.array().cast("array<struct<term:string,n:int>>")

    def measured(run: Column) -> Column:
        return let(
            _run_starts(run, lambda a, b: a == b),
            lambda starts: F.transform(
                starts,
                lambda at, k: F.struct(
                    F.get(run, at).alias("term"),
                    (F.coalesce(F.get(starts, k + 1), F.size(run)) - at).alias("n"),
                ),
            ),
        )

    return let(
        F.sort_array(terms), lambda run: F.when(F.size(run) > 0, measured(run)).otherwise(empty)
    )


def _ranked_terms(terms: Column) -> Column:
    """Distinct terms by falling count, equal counts by first position."""
    placed = F.transform(terms, lambda t, i: F.struct(t.alias("term"), i.alias("at")))
    empty = F.array().cast("array<struct<less:int,first:int,term:string>>")

    def measured(run: Column) -> Column:
        return let(
            _run_starts(run, lambda a, b: a["term"] == b["term"]),
            lambda starts: F.transform(
                starts,
                lambda at, k: F.struct(
                    (at - F.coalesce(F.get(starts, k + 1), F.size(run))).alias("less"),
                    F.get(run, at)["at"].alias("first"),
                    F.get(run, at)["term"].alias("term"),
                ),
            ),
        )

    counted = let(
        F.sort_array(placed), lambda run: F.when(F.size(run) > 0, measured(run)).otherwise(empty)
    )
    return F.sort_array(counted)


def _top_terms(candidates: Column, top: int) -> Column:
    return F.transform(F.slice(_ranked_terms(candidates), 1, top), lambda c: c["term"])


def keywords(
    text: Column, top: int = 10, stop_words: Sequence[str] = fv.CHECK_STOP_WORDS
) -> Column:
    """Most frequent plain words of four letters or more; ties go to the earlier word."""
    found = F.regexp_extract_all(F.lower(text), F.lit(KEYWORD_PATTERN), F.lit(0))
    return _top_terms(F.filter(found, lambda w: ~w.isin(*stop_words)), top)


def prompt_keywords(
    text: Column, top: int = 10, stop_words: Sequence[str] = fv.PROMPT_STOP_WORDS
) -> Column:
    """As :func:`keywords`, but hyphenated terms and digits count as part of a word."""
    found = F.regexp_extract_all(F.lower(text), F.lit(HYPHEN_KEYWORD_PATTERN), F.lit(0))
    return _top_terms(
        F.filter(
            found,
            lambda w: (F.length(w) >= fv.KEYWORD_MIN_CHARS) & ~w.isin(*stop_words),
        ),
        top,
    )


def max_bigram_count(text: Column) -> Column:
    """How often the most frequent adjacent word pair occurs."""
    pairs = let(F.split(F.lower(squash(text)), " "), bigrams)
    return F.coalesce(
        F.array_max(F.transform(term_counts(pairs), lambda c: c["n"])), F.lit(0)
    )
