"""Multinomial naive Bayes and an add-one bigram model, as aggregates and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.functions.text import let
from quillspark.functions.tokens import bigrams, term_counts, tokenize
from quillspark.session import broadcast_if_small, stored

CLASSES = ("human", "ai")


def fit_naive_bayes(weights: DataFrame, docs: DataFrame, alpha: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """Per-term log probabilities of both classes, and the class priors.

    ``weights`` is ``(label, term, weight)``; ``docs`` one row per document with
    its label.  The term table has at most one row per vocabulary entry.
    """
    per_term = weights.groupBy("term").agg(
        *[
            F.sum(F.when(F.col("label") == c, F.col("weight")).otherwise(0.0)).alias(f"w_{c}")
            for c in CLASSES
        ]
    )
    sums = per_term.agg(
        F.count(F.lit(1)).alias("terms"), *[F.sum(f"w_{c}").alias(f"t_{c}") for c in CLASSES]
    )
    size = sums.select("terms").scalar()
    log_prob = per_term.select(
        "term",
        *[
            F.log((F.col(f"w_{c}") + alpha) / (sums.select(f"t_{c}").scalar() + alpha * size)).alias(
                f"log_{c}"
            )
            for c in CLASSES
        ],
    )
    counts = docs.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(F.when(F.col("label") == c, 1)).alias(f"n_{c}") for c in CLASSES],
    )
    priors = counts.select(*[F.log(F.col(f"n_{c}") / F.col("n")).alias(f"prior_{c}") for c in CLASSES])
    return log_prob, priors


def nb_log_ratio_features(log_prob: DataFrame, top: int = 15) -> DataFrame:
    """The terms that speak most for either class."""
    ratio = F.col("log_human") - F.col("log_ai")
    ranked = log_prob.select("term", F.round(ratio, 8).alias("log_ratio"))
    human = ranked.orderBy(F.desc("log_ratio"), "term").limit(top).withColumn("side", F.lit("human"))
    ai = ranked.orderBy("log_ratio", "term").limit(top).withColumn("side", F.lit("ai"))
    return human.unionByName(ai)


def score_naive_bayes(
    weights: DataFrame, docs: DataFrame, log_prob: DataFrame, priors: DataFrame, doc: str
) -> DataFrame:
    """Probability of ``ai`` for every document, those without known terms included."""
    evidence = (
        weights.join(broadcast_if_small(log_prob), "term")
        .groupBy(doc)
        .agg(*[F.sum(F.col("weight") * F.col(f"log_{c}")).alias(f"e_{c}") for c in CLASSES])
    )
    margins = docs.join(evidence, doc, "left").withColumn(
        "margin",
        F.coalesce("e_ai", F.lit(0.0))
        + priors.select("prior_ai").scalar()
        - F.coalesce("e_human", F.lit(0.0))
        - priors.select("prior_human").scalar(),
    )
    return margins.withColumn("score", 1 / (1 + F.exp(-F.col("margin")))).drop(
        "margin", *[f"e_{c}" for c in CLASSES]
    )


def bigram_lm_score(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """Mean negative log probability of each text's word pairs, add-one smoothed.

    The model is the corpus itself.  A text's cost is a sum over its pairs' first words less a sum over its pairs, and a term's
    share of it needs the term's own uses only: rows of a term meet in one exchange, where their sum is its uses.  There is a row
    for each text and term, so no term has more rows than there are texts.
    """
    # cutting texts into words costs far more than writing the words: do it once
    tokens = stored(docs.select(doc, tokenize(F.col(text)).alias("tokens")), "tokens")
    size = tokens.select(F.explode("tokens")).distinct().count()
    terms = let(F.col("tokens"), lambda t: term_counts(F.concat(t, bigrams(t))))
    counted = tokens.select(doc, F.element_at("tokens", -1).alias("last"), F.inline(terms))
    is_pair = F.col("term").contains(" ")
    # the last word of a text begins no pair, but is a use
    begins = F.col("n") - (F.col("term") == F.col("last")).cast("int")
    rows = counted.select(
        F.xxhash64("term").alias("hash"), "term", doc, "n", F.when(is_pair, -F.col("n")).otherwise(begins).alias("times")
    )
    # the hash comes first because it sorts faster than words
    used = rows.withColumn("uses", F.sum("n").over(W.partitionBy("hash", "term")))
    cost = F.col("times") * F.log(F.col("uses") + F.when(is_pair, 1).otherwise(size))
    pairs = F.when(is_pair, F.col("n")).otherwise(0).cast("bigint")
    return (
        used.groupBy(doc)
        .agg(F.sum(pairs).alias("pairs"), F.sum(cost).alias("cost"))
        .filter(F.col("pairs") > 0)
        .select(doc, "pairs", F.round(F.col("cost") / F.col("pairs"), 6).alias("cross_entropy"))
    )
