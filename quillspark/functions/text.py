"""Cleaning and measuring text.

Character classes are spelled out because ``\\w`` and ``\\s`` are ASCII-only in
Java: a word character is a letter, a number or ``_``; whitespace includes the
Unicode separators.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark import fixed_values as fv

WORD = r"[\p{L}\p{N}_]"
SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
NOT_SPACE = r"[^\s\x0b\x1c-\x1f\x{85}\p{Z}]"
NOT_KEPT = r"[^\p{L}\p{N}_ .,;:!?\-()]"
URL = r"(?:https?://|www\.)[^\s\x{85}\p{Z}]+"
EMAIL = r"[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside lambda functions.

    An aggregate over an empty array starts from ``value`` and finishes with
    ``body``; unlike ``transform`` it does not copy the result.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda acc, _: acc, body)


def strip(text: Column) -> Column:
    """Drop Unicode whitespace at both ends."""
    return F.regexp_replace(text, rf"^{SPACE}++|(?<!{SPACE}){SPACE}++$", "")


def squash(text: Column) -> Column:
    """Every run of whitespace becomes one space; none at the ends."""
    return F.trim(F.regexp_replace(text, f"{SPACE}+", " "))


def clean_text(
    text: Column, low: int | None = fv.CLEAN_MIN_CHARS, high: int | None = fv.CLEAN_MAX_CHARS
) -> Column:
    """Normalise a text for training; out-of-band lengths become ``''``.

    The length is taken after whitespace is collapsed and before punctuation
    goes, so a result may be shorter than ``low``.
    """

    def keep(flat: Column) -> Column:
        kept = squash(F.regexp_replace(flat, NOT_KEPT, " "))
        if low is None or high is None:
            return kept
        return F.when(F.length(flat).between(low, high), kept).otherwise(F.lit(""))

    return let(squash(F.coalesce(text, F.lit(""))), keep)


def clean_for_scoring(text: Column) -> Column:
    """The same cleaning at prediction time, where no length band applies."""
    return clean_text(text, None, None)


def clean_generated(text: Column) -> Column:
    """Strip lead-ins, markers and one pair of wrapping quotes from model output."""
    out = F.coalesce(text, F.lit(""))
    for pattern in fv.GENERATED_NOISE:
        spelled = pattern.replace("{S}", SPACE).replace("{L}", r"[^\n]*")
        out = F.regexp_replace(out, "(?imdu)" + spelled, "")
    out = squash(out)
    for quote in ('"', "'"):
        out = let(out, partial(_unwrap, quote))
    return F.trim(out)


def _unwrap(quote: str, text: Column) -> Column:
    wrapped = text.startswith(quote) & text.endswith(quote)
    inner = F.substring(text, F.lit(2), F.length(text) - 2)
    return F.when(wrapped, inner).otherwise(text)


def words(text: Column) -> Column:
    """Whitespace-separated words; an empty array for blank text."""
    return F.regexp_extract_all(text, F.lit(NOT_SPACE + "+"), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(NOT_SPACE + "+"))


def sentences(text: Column) -> Column:
    """Non-blank pieces between runs of ``.``, ``!`` and ``?``."""
    pieces = F.transform(F.split(text, r"[.!?]+"), strip)
    return F.filter(pieces, lambda s: s != "")


def occurrences(text: Column, piece: str) -> Column:
    """Non-overlapping count of a literal piece."""
    return (F.length(text) - F.length(F.replace(text, F.lit(piece), F.lit("")))) / len(piece)


def strip_urls_emails(text: Column) -> Column:
    return squash(F.regexp_replace(F.regexp_replace(text, URL, " "), EMAIL, " "))


def squeeze_punctuation(text: Column) -> Column:
    """``!!!`` becomes ``!``; likewise for the other closing marks."""
    return F.regexp_replace(text, r"([!?.,;:])\1+", "$1")


def record_text(title: Column, abstract: Column) -> Column:
    return F.concat(title, F.lit("\n\n"), abstract)


def last_segment(url: Column) -> Column:
    """Text after the last ``/``."""
    return F.element_at(F.split(url, "/"), -1)


def id_after_abs(url: Column) -> Column:
    """Entry id that keeps an archive prefix such as ``cond-mat/``."""
    return F.when(url.contains("/abs/"), F.regexp_replace(url, r"^.*?/abs/", "")).otherwise(
        last_segment(url)
    )
