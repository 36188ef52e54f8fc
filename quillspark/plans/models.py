"""The classifiers: what each is fitted on and how it scores.

Every fitted model is a ``PipelineModel`` from ``clean_text`` to ``prediction``
and ``probability``; scoring a table is one ``transform``.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
)
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions.labels import encode_label
from quillspark.operators.splits import stratified_holdout
from quillspark.plans.features import KEPT, feature_names, fit_features, term_frequencies, tokenised, transformed
from quillspark.plans.forest import fit_forest
from quillspark.plans.fourier import RandomFourierFeatures
from quillspark.plans.landmarks import fit_landmarks
from quillspark.plans.perceptron import fit_perceptron
from quillspark.session import drop_stored, release, stored

SEED = 42
LOGISTIC_TOLERANCE = 1e-4
MARGIN_TOLERANCE = 1e-3
ROWS_PER_TASK = 1_000
ROWS_PER_SUM = 5_000
HELD_OUT_SHARE = 0.2
JUDGED_SHARE = 0.1


@dataclass(frozen=True)
class ModelSpec:
    name: str
    fit: Callable[[DataFrame, int, str], list]
    max_features: int = 10_000
    bigrams: bool = True
    min_df: int = 1
    max_df: float = 1.0
    scale: bool = False


def _weights(train: DataFrame) -> dict[str, str]:
    return {"weightCol": "weight"} if "weight" in train.columns else {}


def with_balanced_weights(train: DataFrame) -> DataFrame:
    """Adds ``weight``, which gives both classes the same total; the weights sum to the number of rows."""
    counts = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}  # a row per class
    n, weight = sum(counts.values()), F.lit(1.0)
    for label, count in counts.items():
        weight = F.when(F.col("label") == label, F.lit(n / (len(counts) * count))).otherwise(weight)
    return train.withColumn("weight", weight)


def dealt_for_sums(rows: DataFrame, row_id: str, n: int) -> DataFrame:
    """``n`` rows of vectors in as many parts as cores, or fewer: a solver runs a job per iteration and sums a gradient a part.

    Rows are dealt and sorted by id, so that sums repeat.
    """
    tasks = min(n // ROWS_PER_SUM + 1, rows.sparkSession.sparkContext.defaultParallelism)
    return rows.repartition(tasks, row_id).sortWithinPartitions(row_id)


def fit_logistic(train: DataFrame, size: int, row_id: str, c: float = 1.0, max_iter: int = 1000):
    """L2 with strength ``1 / C`` on the summed loss, which Spark averages."""
    n = train.count()
    estimator = LogisticRegression(
        regParam=1.0 / (c * n), elasticNetParam=0.0, standardization=False, maxIter=max_iter,
        tol=LOGISTIC_TOLERANCE, **_weights(train),
    )
    return [estimator.fit(dealt_for_sums(train, row_id, n))]


def fit_naive_bayes(train: DataFrame, size: int, row_id: str, alpha: float = 1.0):
    """Multinomial; Spark also smooths the class priors."""
    return [NaiveBayes(modelType="multinomial", smoothing=alpha, **_weights(train)).fit(train)]


def fit_random_forest(
    train: DataFrame, size: int, row_id: str, trees: int = 100, depth: int = 30
):
    """Thirty levels, as Spark's own forest allows."""
    return [fit_forest(train, size, row_id, trees, depth, SEED, _weights(train).get("weightCol"))]


def fit_mlp(train: DataFrame, size: int, row_id: str, hidden: tuple = (100, 50), max_iter: int = 300, **options):
    """Rectified units, Adam, and an end when a held-out tenth gets no better; takes no weights."""
    split = stratified_holdout(train, row_id, ["label"], JUDGED_SHARE)
    rows = split.select(row_id, "label", "features", "split")
    return [fit_perceptron(rows, size, row_id, F.col("split") == "test", hidden, max_iter=max_iter, seed=SEED, **options)]


def scale_gamma(train: DataFrame, size: int) -> float:
    """One over the number of features times the variance of all matrix cells."""
    values = F.unwrap_udt(F.col("features"))["values"]
    total = F.aggregate(values, F.lit(0.0), lambda s, x: s + x)
    square = F.aggregate(values, F.lit(0.0), lambda s, x: s + x * x)
    row = train.agg(F.count(F.lit(1)).alias("n"), F.sum(total).alias("s"), F.sum(square).alias("s2")).first()
    cells = row["n"] * size
    variance = row["s2"] / cells - (row["s"] / cells) ** 2
    return 1.0 / (size * variance) if variance > 0 else 1.0


def fit_svm(
    train: DataFrame,
    size: int,
    row_id: str,
    c: float = 1.0,
    kernel: str = "rbf",
    num_features: int = 256,
    max_iter: int = 100,
    feature_map: str = "landmarks",
):
    """Large-margin classifier with Platt probabilities.

    The RBF kernel is approximated by ``landmarks`` taken from the fitting rows, or by
    random Fourier features (``cosines``).  Margins are
    calibrated on rows the machine was not fitted on, both classes in proportion.
    """
    if kernel not in ("rbf", "linear") or feature_map not in ("landmarks", "cosines"):
        raise ValueError(f"unknown kernel or feature map: {kernel}, {feature_map}")
    train = stratified_holdout(train, row_id, ["label"], HELD_OUT_SHARE)  # a digest per look is cheaper than a second copy of all vectors
    held_out = F.col("split") == "test"
    stages, inputs = [], "features"
    if kernel == "rbf":
        inputs, gamma = "mapped", scale_gamma(train, size)
        if feature_map == "landmarks":
            stages.append(fit_landmarks(train.filter(~held_out), row_id, size, gamma, num_features, seed=SEED))
        else:
            stages.append(
                RandomFourierFeatures(
                    inputCol="features", outputCol=inputs, gamma=gamma, inputSize=size, numFeatures=num_features, seed=SEED
                )
            )
    mapped = PipelineModel(stages).transform(train).select(row_id, "label", "split", inputs, *_weights(train).values())
    mapped = mapped.persist(StorageLevel.MEMORY_AND_DISK)
    rows = mapped.filter(~held_out).count()
    fitting = dealt_for_sums(mapped.filter(~held_out), row_id, rows)
    machine = LinearSVC(
        featuresCol=inputs,
        regParam=1.0 / (c * max(rows, 1)), maxIter=max_iter, tol=MARGIN_TOLERANCE,
        standardization=False,
        rawPredictionCol="margins", predictionCol="side", **_weights(train),
    ).fit(fitting)
    slicer = VectorSlicer(inputCol="margins", outputCol="margin", indices=[1])
    judged = PipelineModel([machine, slicer]).transform(mapped.filter(held_out))
    platt = LogisticRegression(featuresCol="margin", **_weights(train)).fit(dealt_for_sums(judged, row_id, rows))
    mapped.unpersist()
    return [*stages, machine, slicer, platt]


SVM = ModelSpec("SVM", fit_svm)
RANDOM_FOREST = ModelSpec("Random_Forest", fit_random_forest, max_features=5000)
NAIVE_BAYES = ModelSpec("Naive_Bayes", fit_naive_bayes, bigrams=False)
LOGISTIC = ModelSpec("Logistic_Regression", fit_logistic)
TRAINING_SUITE = (SVM, RANDOM_FOREST, NAIVE_BAYES, LOGISTIC)

_SHARED = {"max_features": 3000, "min_df": 2, "max_df": 0.95, "scale": True}
PROTOTYPE_SUITE = (
    replace(NAIVE_BAYES, bigrams=True, **_SHARED),
    replace(LOGISTIC, **_SHARED),
    replace(SVM, **_SHARED),
    ModelSpec("MLP", fit_mlp, **_SHARED),
)
MLP = ModelSpec("MLP", fit_mlp, max_features=2000, scale=True)


def packed(df: DataFrame) -> DataFrame:
    """Fewer tasks for a small training set: iterative fitting runs a job per step.

    Beyond ``ROWS_PER_TASK`` rows per input split the partitioning is left alone.
    """
    tasks = df.rdd.getNumPartitions()
    wanted = df.count() // ROWS_PER_TASK + 1
    return df.coalesce(wanted) if wanted < tasks else df


def binary_label(label: Column) -> Column:
    return encode_label(label).cast("double")


def fit_model(
    spec: ModelSpec, train: DataFrame, row_id: str = "id", text: str = "clean_text", balanced: bool = False,
    frequencies: DataFrame | None = None, **options
) -> PipelineModel:
    """Features first, cached once, then the classifier on top.

    ``balanced`` weighs rows so that a small class counts as much as a large one (not for the MLP, which takes
    no weights).  Texts are cut into tokens once; a tokenised ``train`` brings its own.
    """
    counts = {} if frequencies is None else {spec.bigrams: frequencies}
    return fit_models((spec,), train, row_id, text, balanced, counts, **options)[spec.name]


def fit_models(
    specs: tuple[ModelSpec, ...], train: DataFrame, row_id: str = "id", text: str = "clean_text", balanced: bool = False,
    frequencies: dict[bool, DataFrame] | None = None, seconds: dict[str, float] | None = None, **options,
) -> dict[str, PipelineModel]:
    """Several models of the same rows, which share what they can: tokens, term counts, and vectors of like features.

    ``frequencies`` are those of the training rows, without and with word pairs; ``seconds`` takes each model's time
    (that of its features included).
    """
    known = train if KEPT in train.columns else tokenised(train.select(row_id, text, "label"), text)
    alike: dict[tuple, list[ModelSpec]] = {}
    for spec in specs:
        alike.setdefault((spec.max_features, spec.bigrams, spec.min_df, spec.max_df, spec.scale), []).append(spec)
    counts = dict(frequencies or {})
    for kind in {key[1] for key in alike} - counts.keys():
        found = term_frequencies(known, kind, [(key[0], key[2], key[3]) for key in alike if key[1] == kind])
        counts[kind] = stored(found, "frequencies") if sum(key[1] == kind for key in alike) > 1 else found
    models = {}
    for key, members in alike.items():
        started = time.perf_counter()
        features = fit_features(known, text, *key, frequencies=counts[key[1]])
        # stored tokens come back in any order of files: rows are dealt by id, so that sums repeat
        tasks = min(known.count() // ROWS_PER_TASK + 1, 4 * known.sparkSession.sparkContext.defaultParallelism)
        vectors = (
            transformed(features, known.withColumn("label", binary_label(F.col("label"))))
            .select(row_id, "label", "features")
            .repartition(tasks, row_id)
            .sortWithinPartitions(row_id)
        ).persist(StorageLevel.MEMORY_AND_DISK)
        size, rows = len(feature_names(features)), with_balanced_weights(vectors) if balanced else vectors
        shared = time.perf_counter() - started
        for spec in members:
            started = time.perf_counter()
            models[spec.name] = PipelineModel([*features.stages, *spec.fit(rows, size, row_id, **options)])
            release(known.sparkSession)
            if seconds is not None:
                seconds[spec.name] = shared + time.perf_counter() - started
        vectors.unpersist()
    for kind, found in counts.items():
        if kind not in (frequencies or {}) and hasattr(found, "stored_path"):
            drop_stored(found)
    return {spec.name: models[spec.name] for spec in specs}


def score(
    model: PipelineModel, df: DataFrame, name: str, row_id: str = "id", keep: tuple = ()
) -> DataFrame:
    """``(model, row, label, predicted, score)``; a row without a label keeps a null."""
    out = transformed(model, df.withColumn("_truth", encode_label(F.col("label"))).drop("label"))
    return out.select(
        F.lit(name).alias("model"),
        row_id,
        *keep,
        F.col("_truth").alias("label"),
        F.col("prediction").cast("int").alias("predicted"),
        vector_to_array("probability")[1].alias("score"),
    )


def score_all_models(models: dict[str, PipelineModel], df: DataFrame, row_id: str = "id"):
    """Every model on the same rows, as one long table."""
    df = tokenised(df.select(row_id, "label", "clean_text")) if len(models) > 1 and KEPT not in df.columns else df
    parts = [score(m, df, name, row_id) for name, m in models.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def linear_weights(model: PipelineModel) -> DataFrame:
    """``(term, weight)`` of a fitted linear model or forest, one row per feature."""
    terms = feature_names(model)
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        weights = last.featureImportances.toArray()
    elif hasattr(last, "coefficients"):
        weights = last.coefficients.toArray()
    else:
        raise ValueError("this model has no weight per feature")
    rows = [(t, float(w)) for t, w in zip(terms, weights)]
    return SparkSession.active().createDataFrame(rows, "term string, weight double")


def top_features_abs(weights: DataFrame, top: int = 20) -> DataFrame:
    return (
        weights.withColumn("importance", F.abs("weight"))
        .orderBy(F.desc("importance"), "term")
        .limit(top)
        .select("term", "importance")
    )


def top_features_signed(weights: DataFrame, top: int = 20) -> DataFrame:
    """Largest weights speak for ai, smallest for human (class 1 is ai)."""
    ai = weights.orderBy(F.desc("weight"), "term").limit(top).withColumn("side", F.lit("ai"))
    human = weights.orderBy("weight", "term").limit(top).withColumn("side", F.lit("human"))
    return ai.unionByName(human)
