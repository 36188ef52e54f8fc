"""TF-IDF as a fitted ``pyspark.ml`` pipeline.

Stock stages only, so a fitted pipeline saves and loads.  The vocabulary and
its document frequencies come from one aggregate over the corpus; weights
follow from them without a second pass.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    NGram,
    Normalizer,
    RegexTokenizer,
    SQLTransformer,
    StandardScaler,
    StopWordsRemover,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark import fixed_values as fv
from quillspark.functions.tokens import TOKEN_PATTERN
from quillspark.operators.vocabulary import candidate_frequencies, vocabulary, word_frequencies
from quillspark.session import stored

KEPT = "_kept"
TOKEN_STAGES = 2  # of a pipeline: from the text to its kept tokens


def term_stages(text: str, bigrams: bool) -> list:
    """Stages from a text column to an array column ``terms``."""
    stages = [
        RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=TOKEN_PATTERN, gaps=False),
        StopWordsRemover(
            inputCol="_tokens", outputCol=KEPT, stopWords=list(fv.ENGLISH_STOP_WORDS), locale="en_US"
        ),
    ]
    if not bigrams:
        return [*stages, SQLTransformer(statement="SELECT *, _kept AS terms FROM __THIS__")]
    return [
        *stages,
        NGram(inputCol="_kept", outputCol="_pairs", n=2),
        SQLTransformer(statement="SELECT *, concat(_kept, _pairs) AS terms FROM __THIS__"),
    ]


def tokenised(df: DataFrame, text: str = "clean_text") -> DataFrame:
    """The table with its kept tokens in place of the text, written once: every fit and every score of it reads them."""
    if KEPT in df.columns:
        return df
    kept = PipelineModel(term_stages(text, False)[:TOKEN_STAGES]).transform(df).drop("_tokens", text)
    return stored(kept, "tokens").withColumn("_tokens", F.lit(None).cast("array<string>"))


def transformed(model: PipelineModel, df: DataFrame) -> DataFrame:
    """A fitted pipeline on texts, or on a table that holds their kept tokens already."""
    return PipelineModel(model.stages[TOKEN_STAGES if KEPT in df.columns else 0 :]).transform(df)


def term_frequencies(
    known: DataFrame, bigrams: bool, asked: Sequence[tuple[int, int, float]], folds: Sequence[int] = ()
) -> DataFrame:
    """Frequencies in a tokenised table, of all words and of the pairs that may enter the vocabularies ``asked`` for.

    Those are ``(max_features, min_df, max_df)`` each; with ``folds`` there are counts outside of each (``outside_fold``).
    """
    return candidate_frequencies(known, KEPT, asked, folds) if bigrams else word_frequencies(known, KEPT, folds)


def fit_vocabulary(
    frequencies: DataFrame, n_docs: int, max_features: int, min_df: int = 1, max_df: float = 1.0
) -> tuple[list[str], list[int]]:
    """Terms and their document frequencies (at most ``max_features``)."""
    table = vocabulary(frequencies, n_docs, max_features, min_df, max_df)
    rows = table.orderBy("term").toArrow().to_pydict()
    return rows["term"], rows["doc_freq"]


def tfidf_stages(terms: list[str], doc_freq: list[int], n_docs: int, output: str) -> list:
    weights = [math.log((1 + n_docs) / (1 + df)) + 1 for df in doc_freq]
    return [
        CountVectorizerModel.from_vocabulary(terms, inputCol="terms", outputCol="_counts"),
        ElementwiseProduct(
            scalingVec=Vectors.dense(weights), inputCol="_counts", outputCol="_weighted"
        ),
        Normalizer(inputCol="_weighted", outputCol=output, p=2.0),
    ]


def tfidf_table(
    docs: DataFrame, doc: str, text: str, vocab: DataFrame, n_docs: int, bigrams: bool = True, keep: tuple = ()
) -> DataFrame:
    """``(doc, *keep, term, weight)`` with unit-length rows, without a shuffle.

    A document's terms are counted, weighted and normalised in its own row, against a vocabulary that
    ``max_features`` bounds; only then does the row become one per term.  ``docs`` may be a tokenised table.
    """
    rows = vocab.select("term", "doc_freq").orderBy("term").toArrow().to_pydict()
    empty = docs.select(doc, *keep, F.lit("").alias("term"), F.lit(0.0).alias("weight")).limit(0)
    if not rows["term"]:
        return empty
    stages = [*term_stages(text, bigrams), *tfidf_stages(rows["term"], rows["doc_freq"], n_docs, "_vector")]
    given = [KEPT, "_tokens"] if KEPT in docs.columns else [text]
    vectors = transformed(PipelineModel(stages), docs.select(doc, *keep, *given))
    raw = F.unwrap_udt(F.col("_vector"))
    pairs = F.explode(F.arrays_zip(raw["indices"].alias("at"), raw["values"].alias("weight"))).alias("p")
    # one literal that is cut once; a literal per term would take the driver seconds (no term holds a line feed)
    term = F.element_at(F.split(F.lit("\n".join(rows["term"])), "\n"), F.col("p.at") + 1)
    return vectors.select(doc, *keep, pairs).select(doc, *keep, term.alias("term"), F.col("p.weight").alias("weight"))


def fit_features(
    train: DataFrame,
    text: str = "clean_text",
    max_features: int = 3000,
    bigrams: bool = True,
    min_df: int = 1,
    max_df: float = 1.0,
    scale: bool = False,
    frequencies: DataFrame | None = None,
) -> PipelineModel:
    """Fit on the training rows alone; yields a sparse ``features`` column.

    ``frequencies`` are those of the training rows, where several models share them.
    """
    train = tokenised(train, text)
    if frequencies is None:
        frequencies = term_frequencies(train, bigrams, [(max_features, min_df, max_df)])
    n_docs = train.count()
    terms, doc_freq = fit_vocabulary(frequencies, n_docs, max_features, min_df, max_df)
    name = "_unit" if scale else "features"
    stages = [*term_stages(text, bigrams), *tfidf_stages(terms, doc_freq, n_docs, name)]
    if scale:
        # StandardScaler divides by the sample deviation: bring it to the population one
        fitted = StandardScaler(inputCol="_unit", outputCol="_scaled", withMean=False).fit(
            transformed(PipelineModel(stages), train)
        )
        factor = math.sqrt(n_docs / (n_docs - 1)) if n_docs > 1 else 1.0
        stages += [
            fitted,
            ElementwiseProduct(
                scalingVec=Vectors.dense([factor] * len(terms)),
                inputCol="_scaled",
                outputCol="features",
            ),
        ]
    drop = [c for c in ("_tokens", "_kept", "_pairs", "_counts", "_weighted", "_unit", "_scaled")]
    return PipelineModel([*stages, SQLTransformer(statement=_keep_statement(drop, bigrams, scale))])


def _keep_statement(drop: list[str], bigrams: bool, scale: bool) -> str:
    gone = [c for c in drop if bigrams or c != "_pairs"]
    gone = [c for c in gone if scale or c not in ("_unit", "_scaled")]
    return f"SELECT * EXCEPT ({', '.join([*gone, 'terms'])}) FROM __THIS__"


def feature_names(model: PipelineModel) -> list[str]:
    """The vocabulary, read from the JVM once."""
    for stage in model.stages:
        if isinstance(stage, CountVectorizerModel):
            return list(stage.vocabulary)
    raise ValueError("no vocabulary in this pipeline")
