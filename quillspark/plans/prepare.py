"""From two raw corpora to a clean, split one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import word_count
from quillspark.operators.corpus import clean_nonempty, dedupe_keep_first, with_text_stats
from quillspark.operators.splits import stratified_split
from quillspark.session import stored


def clean_corpus(corpus: DataFrame, row_id: str = "id") -> DataFrame:
    """Clean, drop empty texts, drop repeats (the earlier corpus wins), measure."""
    return with_text_stats(dedupe_keep_first(clean_nonempty(corpus), ["corpus_rank", row_id]))


def prepare_corpus(
    corpus: DataFrame, row_id: str = "id", test: float = 0.2, val: float = 0.2, seed: int = 42
) -> DataFrame:
    """The cleaned corpus with its split.

    The cleaned table is written once: the split looks at ids and labels only,
    and must not clean the text again for each look.
    """
    cleaned = stored(clean_corpus(corpus, row_id), "corpus")
    return stratified_split(cleaned, row_id, ["label"], test, val, seed)


def corpus_filter(
    docs: DataFrame, language: str = "en", low: int = 100, high: int = 500
) -> DataFrame:
    """One language, and a word count inside the band."""
    return docs.filter(
        (F.col("lang") == language) & word_count(F.col("text")).between(low, high)
    )

