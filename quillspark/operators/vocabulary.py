"""Terms and vocabularies as long tables; TF-IDF weights are made in ``plans.features``.

A document's counts come out of its own row, so a corpus pass shuffles only
per-term partial totals.  A vocabulary is cut to ``max_features`` rows; joins
with it count it before they broadcast it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark import fixed_values as fv
from quillspark.functions.text import let
from quillspark.functions.tokens import (
    bigrams,
    char_ngrams,
    remove_stopwords,
    term_counts,
    tokenize,
    unigrams_and_bigrams,
)
from quillspark.session import broadcast_if_small, stored

MOST_WORDS = 50_000  # that a list in a plan holds
FIRST_WORDS = 3_000


def document_terms(
    docs: DataFrame,
    doc: str,
    text: str,
    bigrams: bool = True,
    stop_words: Sequence[str] = fv.ENGLISH_STOP_WORDS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``(doc, *keep, term, n)`` without a shuffle."""
    terms = (
        unigrams_and_bigrams(F.col(text), stop_words)
        if bigrams
        else remove_stopwords(tokenize(F.col(text)), stop_words)
    )
    exploded = docs.select(doc, *keep, F.explode(term_counts(terms)).alias("t"))
    return exploded.select(doc, *keep, F.col("t.term").alias("term"), F.col("t.n").cast("bigint").alias("n"))


def term_doc_freq(terms: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Corpus count and document frequency; each (doc, term) is already one row."""
    return terms.groupBy(*by, "term").agg(
        F.sum("n").alias("corpus_count"), F.count(F.lit(1)).alias("doc_freq")
    )


def _sums(long: DataFrame, folds: Sequence[int]) -> DataFrame:
    """Counts per term; with folds a pair of columns a fold, of the rows outside of it."""
    if not folds:
        return term_doc_freq(long)
    sums = []
    for k in folds:
        outside = F.col("fold") != k
        sums += [
            F.sum(F.when(outside, F.col("n")).otherwise(0)).alias(f"corpus_count_{k}"),
            F.count(F.when(outside, 1)).alias(f"doc_freq_{k}"),
        ]
    return long.groupBy("term").agg(*sums)


def outside_fold(frequencies: DataFrame, k: int) -> DataFrame:
    """``(term, corpus_count, doc_freq)`` of the rows outside of one fold."""
    counts = frequencies.select("term", F.col(f"corpus_count_{k}").alias("corpus_count"), F.col(f"doc_freq_{k}").alias("doc_freq"))
    return counts.filter(F.col("doc_freq") > 0)


def lowest_count(words: DataFrame, n_docs: int, asked: Sequence[tuple[int, int, float]]) -> int:
    """A count that no term of the vocabularies asked for can stay below, as single words alone fill them; 1 if they do not."""
    lowest = []
    for max_features, min_df, max_df in asked:
        kept = words.filter((F.col("doc_freq") >= min_df) & (F.col("doc_freq") <= F.lit(max_df) * F.lit(n_docs)))
        step = F.floor(8 * F.log2("corpus_count")).alias("step")
        # eight rows a power of two
        steps = kept.groupBy(step).agg(F.count(F.lit(1)).alias("words"), F.min("corpus_count").alias("least"))
        reached, found = 0, 1
        for row in steps.orderBy(F.desc("step")).collect():
            reached += row["words"]
            if reached >= max_features:
                found = row["least"]
                break
        lowest.append(found)
    return min(lowest, default=1)


def _counted(tokens: DataFrame, terms: Column, folds: Sequence[int]) -> DataFrame:
    long = tokens.select(*(["fold"] if folds else []), F.inline(term_counts(terms)))
    return _sums(long.withColumn("n", F.col("n").cast("bigint")), folds)


def word_frequencies(tokens: DataFrame, kept: str, folds: Sequence[int] = ()) -> DataFrame:
    """Frequencies of the words of an array column; with folds, outside of each."""
    return _counted(tokens, F.col(kept), folds)


def candidate_frequencies(
    tokens: DataFrame, kept: str, asked: Sequence[tuple[int, int, float]], folds: Sequence[int] = (), most: int = MOST_WORDS
) -> DataFrame:
    """Frequencies of every word, and of every word pair that may enter one of the vocabularies asked for.

    ``asked`` is ``(max_features, min_df, max_df)`` each; ``tokens`` a stored table with the array ``kept``, and with ``fold`` if
    there are folds: then each has its own vocabularies, of the rows outside of it.  A pair occurs no more often than either of its
    words, so words that occur less often than the last of the vocabulary make no pair of it: pairs are made of the others only.
    """
    words = stored(word_frequencies(tokens, kept, folds), "words")
    if folds:
        sizes = {r["fold"]: r["count"] for r in tokens.groupBy("fold").count().collect()}  # a row a fold
        n = sum(sizes.values())
        lowest = {
            f"corpus_count_{k}": lowest_count(outside_fold(words, k), n - sizes.get(k, 0), asked) for k in folds
        }
    else:
        lowest = {"corpus_count": lowest_count(words, tokens.count(), asked)}
    often = F.lit(False)
    for name, least in lowest.items():
        often |= F.col(name) >= least
    frequent = words.filter(often).select("term").limit(most + 1).toArrow()["term"].to_pylist()
    if min(lowest.values()) <= 1 or len(frequent) > most:
        return words.unionByName(_counted(tokens, bigrams(F.col(kept)), folds))
    pairs = let(only_words(kept, frequent), lambda words_: whole_ngrams(words_, 2))
    return words.unionByName(_counted(tokens, pairs, folds).filter(often))


def vocabulary(
    frequencies: DataFrame,
    n_docs: Column | int,
    max_features: int = 3000,
    min_df: int = 1,
    max_df: float = 1.0,
) -> DataFrame:
    """The most frequent terms within the document-frequency limits, ties by term.

    Most terms are rare.  The admissible ones are written once; a histogram of
    their counts by order of magnitude says which magnitudes can hold the
    winners, and the final top-k sees little more than ``max_features`` rows
    instead of that many from every task.
    """
    limit = F.lit(max_df) * (F.lit(n_docs) if isinstance(n_docs, int) else n_docs)
    kept = frequencies
    if min_df > 1:
        kept = kept.filter(F.col("doc_freq") >= min_df)
    if max_df < 1.0:
        kept = kept.filter(F.col("doc_freq") <= limit)
    kept = stored(kept, "terms")
    magnitude = F.length(F.bin("corpus_count"))
    # at most 64 rows
    histogram = kept.groupBy(magnitude.alias("m")).agg(F.count(F.lit(1)).alias("terms"))
    reached = F.sum("terms").over(W.orderBy(F.desc("m")))
    floor = histogram.withColumn("reached", reached).filter(F.col("reached") >= max_features)
    lowest = floor.agg(F.coalesce(F.max("m"), F.lit(0)).alias("m")).scalar()
    likely = kept.filter(magnitude >= lowest)
    return likely.orderBy(F.desc("corpus_count"), "term").limit(max_features)


def vocab_lookup(terms: DataFrame, vocab: DataFrame) -> DataFrame:
    """Keep the terms of a fitted vocabulary."""
    return terms.join(broadcast_if_small(vocab.select("term")), "term")


def idf(doc_freq: Column, n_docs: Column) -> Column:
    """Smoothed inverse document frequency, never below one."""
    return F.log((1 + n_docs) / (1 + doc_freq)) + 1


def fit_scale(weights: DataFrame, n_docs: Column | int) -> DataFrame:
    """Population deviation per term over all documents, absent ones included."""
    total = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    sums = weights.groupBy("term").agg(
        F.sum("weight").alias("s"), F.sum(F.col("weight") * F.col("weight")).alias("s2")
    )
    variance = F.greatest(F.col("s2") / total - (F.col("s") / total) * (F.col("s") / total), F.lit(0.0))
    return sums.select("term", F.when(variance > 0, F.sqrt(variance)).otherwise(F.lit(1.0)).alias("scale"))


def scale_sparse(weights: DataFrame, scale: DataFrame) -> DataFrame:
    """Divide by the fitted deviation without centring, so absent terms stay absent."""
    joined = weights.join(broadcast_if_small(scale), "term")
    return joined.withColumn("scaled", F.col("weight") / F.col("scale")).drop("scale")


def word_uses(tokens: DataFrame, column: str) -> DataFrame:
    """``(term, n)``: every word of an array column with its number of uses, written once."""
    long = tokens.select(F.explode(column).alias("term"))
    return stored(long.groupBy("term").agg(F.count(F.lit(1)).alias("n")), "words")


def words_used(words: DataFrame, least: int, most: int = MOST_WORDS) -> list[str] | None:
    """The words with at least ``least`` uses; None if they are more than ``most``."""
    found = words.filter(F.col("n") >= least).select("term").limit(most + 1).toArrow()["term"].to_pylist()
    return found if len(found) <= most else None


def uses_of_place(words: DataFrame, place: int) -> int:
    """The uses of the word at a place by falling uses; 1 if there are fewer words."""
    table = words.orderBy(F.desc("n")).limit(place).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("n")).first()
    return table["n"] if table["words"] == place else 1


def only_words(column: str, listed: Sequence[str]) -> Column:
    """An array of words with nulls for those that are not listed."""
    # a word is letters, digits and underscores: it needs no escape
    quoted = ", ".join(f"'{w}'" for w in listed)
    return F.expr(f"transform(`{column}`, w -> IF(w IN ({quoted}), w, NULL))" if listed else f"transform(`{column}`, w -> CAST(NULL AS STRING))")


def whole_ngrams(tokens: Column, n: int) -> Column:
    """Runs of ``n`` consecutive words without a null among them."""
    grams = tokens
    for k in range(2, n + 1):
        kept = F.greatest(F.size(tokens) - (k - 1), F.lit(0))
        grams = F.zip_with(
            F.slice(grams, F.lit(1), kept), F.slice(tokens, F.lit(k), kept), lambda a, b: F.concat(a, F.lit(" "), b)
        )
    return F.array_compact(grams)


def ngram_frequencies(docs: DataFrame, text: str, top: int, sizes: Sequence[int] = (1, 2, 3), first: int = FIRST_WORDS):
    """The most frequent word n-grams of each size over the whole corpus.

    An n-gram occurs no more often than any of its words.  N-grams of the ``first`` words are counted; where the last
    leader of a size occurs less often than a word left out may, its count is the bound for a second count.  With words
    too many to list, n-grams of all words are counted.
    """
    tokens = stored(docs.select(tokenize(F.col(text)).alias("tokens")), "tokens")
    words = word_uses(tokens, "tokens")
    longer = [n for n in sizes if n > 1]

    def leaders(listed: list[str] | None) -> DataFrame:
        shown = F.col("tokens") if listed is None else only_words("tokens", listed)
        grams = let(shown, lambda t: F.array(
            *[F.struct(F.lit(n).alias("size"), whole_ngrams(t, n).alias("grams")) for n in longer]
        ))
        counted = (
            tokens.select(F.inline(grams))
            .select("size", F.explode("grams").alias("gram"))
            .groupBy("size", "gram")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        return stored(top_per_group(counted, "size", top), "leaders")

    parts = []
    if 1 in sizes:
        parts.append(top_per_group(words.select(F.lit(1).alias("size"), F.col("term").alias("gram"), "n"), "size", top))
    if longer:
        least = uses_of_place(words, first)
        listed = words_used(words, least)
        found = leaders(listed)
        if listed is not None and least > 1:
            last = {r["size"]: r["n"] for r in found.filter(F.col("place") == top).collect()}  # a row a size
            bound = min(last.get(n, 1) for n in longer)
            if bound < least:
                found = leaders(words_used(words, bound) if bound > 1 else None)
        parts.append(found)
    return reduce(DataFrame.unionByName, parts)


def char_ngram_counts(docs: DataFrame, text: str, size: int) -> DataFrame:
    return (
        docs.select(F.explode(char_ngrams(F.col(text), size)).alias("gram"))
        .groupBy("gram")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def top_per_group(counted: DataFrame, group: str, top: int) -> DataFrame:
    """A window with a small rank limit: each map task keeps only its own leaders."""
    w = W.partitionBy(group).orderBy(F.desc("n"), "gram")
    return counted.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= top)


def anova_f(weights: DataFrame, labels: DataFrame, top: int) -> DataFrame:
    """Terms by the F statistic of their weights between the classes, absent terms counting as zero.

    ``weights`` is ``(label, term, weight)``; ``labels`` one row per document.  Classes are few: their sizes and sums
    are one row per class, and per term and class.
    """
    sizes = labels.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    totals = sizes.agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("k"))
    n, k = totals.select("n").scalar(), totals.select("k").scalar()
    w = F.col("weight")
    sums = weights.groupBy("term", "label").agg(F.sum(w).alias("s"), F.sum(w * w).alias("q"))
    per_term = sums.join(F.broadcast(sizes), "label").groupBy("term").agg(
        F.sum("s").alias("s"), F.sum("q").alias("q"), F.sum(F.col("s") * F.col("s") / F.col("size")).alias("of_means")
    )
    between = F.greatest(F.col("of_means") - F.col("s") * F.col("s") / n, F.lit(0.0)) / (k - 1)
    within = F.greatest(F.col("q") - F.col("of_means"), F.lit(0.0)) / (n - k)
    return (
        per_term.select("term", F.round(between / within, 6).alias("f"))
        .filter(F.col("f").isNotNull())
        .orderBy(F.desc("f"), "term")
        .limit(top)
    )


def mutual_information(terms: DataFrame, labels: DataFrame, top: int) -> DataFrame:
    """Terms by mutual information of their presence with the class.

    ``terms`` carries ``label``; ``labels`` is one row per document.
    """
    totals = labels.agg(
        F.count(F.lit(1)).alias("docs"), F.count(F.when(F.col("label") == "ai", 1)).alias("ai")
    )
    n, n_ai = totals.select("docs").scalar(), totals.select("ai").scalar()
    seen = terms.groupBy("term").agg(
        F.count(F.when(F.col("label") == "ai", 1)).alias("with_ai"),
        F.count(F.when(F.col("label") != "ai", 1)).alias("with_human"),
    )
    counts = seen.withColumns({"docs": n, "ai": n_ai})
    docs, ai = F.col("docs").cast("double"), F.col("ai").cast("double")
    human = docs - ai
    present = F.col("with_ai") + F.col("with_human")

    def part(cell: Column, row: Column, column: Column) -> Column:
        return F.when(
            cell > 0, cell / docs * F.log(cell * docs / (row * column))
        ).otherwise(F.lit(0.0))

    absent = docs - present
    information = (
        part(F.col("with_ai"), present, ai)
        + part(F.col("with_human"), present, human)
        + part(ai - F.col("with_ai"), absent, ai)
        + part(human - F.col("with_human"), absent, human)
    )
    return (
        counts.select("term", F.round(information, 9).alias("information"))
        .orderBy(F.desc("information"), "term")
        .limit(top)
    )
