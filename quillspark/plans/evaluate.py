"""Fit, score and compare: driver loops over models and folds, tables in between."""

from __future__ import annotations

import time
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark import fixed_values as fv
from quillspark.functions.style import linguistic_features, style_features
from quillspark.functions.tokens import tokenize
from quillspark.operators import metrics as m
from quillspark.operators.comparison import cv_summary
from quillspark.operators.splits import stratified_holdout, stratified_kfold
from quillspark.operators.vocabulary import outside_fold
from quillspark.plans.features import KEPT, feature_names, fit_features, term_frequencies, tokenised, transformed
from quillspark.plans.forest import grow_trees, in_blocks, limited, trees_at_once
from quillspark.plans.landmarks import fit_landmarks
from quillspark.plans.models import (
    LOGISTIC_TOLERANCE,
    MARGIN_TOLERANCE,
    SEED,
    ModelSpec,
    binary_label,
    dealt_for_sums,
    fit_model,
    fit_models,
    packed,
    scale_gamma,
    score,
    score_all_models,
)
from quillspark.plans.word_vectors import mean_vectors
from quillspark.session import drop_stored, scratch_path, stored


FOLDS_AT_ONCE = 5  # their solvers run many short jobs, which leave cores idle one by one
ROWS_SIDE_BY_SIDE = 300_000  # of all fits at once


def folds_at_once(folds: int, rows: int) -> int:
    """Fits of few rows leave cores idle and run side by side; those of many rows fill the cores, and would only hold more at once."""
    return max(1, min(folds, FOLDS_AT_ONCE, ROWS_SIDE_BY_SIDE // max(rows, 1)))


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def metrics_with_auc(scored: DataFrame, by: list[str], pos_label: int = 1) -> DataFrame:
    """``pos_label`` may be either class; its own probability ranks the rows."""
    oriented = scored if pos_label == 1 else scored.withColumn("score", 1 - F.col("score"))
    auc = m.roc_auc(oriented, by, pos_label)
    return m.binary_metrics(scored, by, pos_label).join(auc, by)


def out_of_fold(
    specs: tuple[ModelSpec, ...], train: DataFrame, row_id: str = "id", folds: int = 5, **options
) -> DataFrame:
    """``(model, row, fold, label, predicted, score)``: each row scored by models that have not seen its fold.

    Vocabulary and weights are refitted for each fold, from tokens cut once and terms counted once by fold.  Folds are fitted
    side by side.
    """
    folded, without = tokenised_folds(train, row_id, folds, {(s.bigrams, s.max_features, s.min_df, s.max_df) for s in specs})

    def fold_scores(k: int) -> list[DataFrame]:
        known, held = folded.filter(F.col("fold") != k), folded.filter(F.col("fold") == k)
        counts = {b: without(k, b) for b in {s.bigrams for s in specs}}
        members = fit_models(specs, known, row_id, frequencies=counts, **options)
        return [score(model, held, name, row_id, keep=("fold",)) for name, model in members.items()]

    n = folded.count()
    with ThreadPool(folds_at_once(folds, n - n // folds)) as pool:
        return union([part for found in pool.map(fold_scores, range(folds), 1) for part in found])


def tokenised_folds(train: DataFrame, row_id: str, folds: int, asked: set[tuple[bool, int, int, float]]):
    """The rows' tokens with their fold, written once, and a function from a fold to the frequencies outside of it.

    ``asked`` are the vocabularies that are learnt of them: whether with word pairs, and their limits.
    """
    text = KEPT if KEPT in train.columns else "clean_text"
    numbered = stratified_kfold(train.select(row_id, "label", text), row_id, ["label"], folds)
    folded = tokenised(numbered) if text != KEPT else _again(numbered)
    counts = {}
    for pairs in {a[0] for a in asked}:
        found = term_frequencies(folded, pairs, [a[1:] for a in asked if a[0] == pairs], range(folds))
        counts[pairs] = stored(found, "frequencies")

    def without(k: int, bigrams: bool) -> DataFrame:
        return outside_fold(counts[bigrams], k)

    return folded, without


def _again(numbered: DataFrame) -> DataFrame:
    return stored(numbered, "folds").withColumn("_tokens", F.lit(None).cast("array<string>"))


def cross_validate(
    specs: ModelSpec | tuple[ModelSpec, ...], train: DataFrame, row_id: str = "id", folds: int = 5, **options
) -> DataFrame:
    """``(model, fold, accuracy)``; vocabulary and weights are refitted for each fold."""
    specs = (specs,) if isinstance(specs, ModelSpec) else specs
    scored = out_of_fold(specs, train, row_id, folds, **options)
    return m.binary_metrics(scored, ["model", "fold"]).select("model", "fold", "accuracy")


def fit_eval_record(
    specs: ModelSpec | tuple[ModelSpec, ...],
    train: DataFrame,
    test: DataFrame,
    row_id: str = "id",
    pos_label: int = 1,
    folds: int = 5,
    **options,
) -> DataFrame:
    """One row a model: metrics, AUC, cross-validation, confusion cells and timings."""
    specs = (specs,) if isinstance(specs, ModelSpec) else specs
    train, test = (
        df if KEPT in df.columns else tokenised(df.select(row_id, "label", "clean_text")) for df in (train, test)
    )
    train_time: dict[str, float] = {}
    members = fit_models(specs, train, row_id, seconds=train_time, **options)
    predict_time, parts = {}, []
    for name, model in members.items():
        started = time.perf_counter()
        parts.append(stored(score(model, test, name, row_id), "scored"))
        predict_time[name] = time.perf_counter() - started
    scored = union(parts)
    cells = scored.groupBy("model").agg(*[c.alias(k) for k, c in m.outcome_counts(1).items()])
    matrix = F.array(F.array("tn", "fp"), F.array("fn", "tp")).alias("confusion_matrix")
    record = metrics_with_auc(scored, ["model"], pos_label).join(cells.select("model", matrix), "model")
    if folds > 1:
        cv = cv_summary(cross_validate(specs, train, row_id, folds, **options))
        record = record.join(cv, "model")
    times = [(name, train_time[name], predict_time[name]) for name in members]
    spent = train.sparkSession.createDataFrame(times, "model string, train_time double, predict_time double")
    return record.join(F.broadcast(spent), "model")


def evaluate_on_test(
    models: dict[str, PipelineModel], test: DataFrame, row_id: str = "id"
) -> DataFrame:
    scored = stored(score_all_models(models, test, row_id), "scored")
    return metrics_with_auc(scored, ["model"])


def evaluate_best_model(
    models: dict[str, PipelineModel], test: DataFrame, row_id: str = "id", examples: int = 10
) -> dict[str, DataFrame]:
    """The best fitted model by test F1, judged on its own scores.

    ``measures``, confusion ``cells``, ROC and precision-recall curves, an error summary and its first errors.
    """
    scored = stored(score_all_models(models, test, row_id), "scored")
    measures = m.binary_metrics(scored, ["model"])
    best = measures.orderBy(F.desc("f1_score"), "model").limit(1)
    own = scored.join(best.select("model"), "model")
    return {
        "measures": best,
        "cells": own.groupBy("model").agg(*[c.alias(k) for k, c in m.outcome_counts(1).items()]),
        "roc": m.roc_curve(own, ["model"]),
        "precision_recall": m.pr_curve(own, ["model"]),
        "errors": m.error_summary(own, ["model"]),
        "examples": m.error_examples(
            m.misclassified_rows(own.select(row_id, "label"), own.drop("label"), row_id), ["model"], row_id, examples
        ),
    }


def run_model_suite(
    specs: tuple[ModelSpec, ...], train: DataFrame, test: DataFrame, row_id: str = "id",
    pos_label: int = 0, folds: int = 5,
) -> DataFrame:
    """One record per model, all on the same split."""
    return fit_eval_record(specs, train, test, row_id, pos_label, folds)


def _logistic(c: float):
    return lambda n: LogisticRegression(
        regParam=1.0 / (c * n), standardization=False, maxIter=100, tol=LOGISTIC_TOLERANCE
    )


@dataclass(frozen=True)
class MachineCandidate:
    """A large-margin classifier; the width of an RBF kernel is ``scale`` (by the variance of all cells) or ``auto`` (by their number)."""

    c: float
    gamma: str | None = None


@dataclass(frozen=True)
class ForestCandidate:
    """A forest whose nodes end at a depth (None: nowhere) and where fewer than ``split`` rows were drawn."""

    trees: int
    depth: int | None
    split: int = 2


def _forest(trees: int, depth: int | None, split: int = 2) -> ForestCandidate:
    return ForestCandidate(trees, depth, split)


def _depth(depth: int | None) -> str:
    return "none" if depth is None else str(depth)


# candidate -> estimator for a training set of n rows, or a machine or a forest
LOGISTIC_GRID = {f"C={c}": _logistic(c) for c in (0.01, 0.1, 1.0, 10.0)}
MACHINE_GRID = {f"svm linear C={c}": MachineCandidate(c) for c in (0.1, 1.0, 10.0)} | {
    f"svm rbf C={c} gamma={g}": MachineCandidate(c, g) for c in (0.1, 1.0, 10.0) for g in ("scale", "auto")
}
FOREST_GRID = {
    f"trees={t} depth={_depth(d)}": _forest(t, d) for t in (100, 200, 500) for d in (10, 20, None)
}
SPLIT_GRID = {
    f"trees={t} depth={_depth(d)} split={m}": _forest(t, d, m)
    for t in (100, 200, 500) for d in (10, 20, None) for m in (5, 10)
}
GRID = {**LOGISTIC_GRID, **MACHINE_GRID, **FOREST_GRID, **SPLIT_GRID}


def grid_search(
    train: DataFrame,
    row_id: str = "id",
    grid: dict = GRID,
    folds: int = 5,
    max_features: int = 3000,
    parallelism: int = 4,
) -> DataFrame:
    """Mean F1 per candidate over stratified folds.

    Each fold learns its own vocabulary, caches its vectors once and fits all
    candidates on them, a few at a time; one pass over the held-out rows judges all linear candidates.
    """
    folded, without = tokenised_folds(train, row_id, folds, {(True, max_features, 1, 1.0)})
    forests = {name: c for name, c in grid.items() if isinstance(c, ForestCandidate)}
    others = {name: c for name, c in grid.items() if name not in forests}

    def judged_fold(k: int) -> DataFrame:
        inside, outside = folded.filter(F.col("fold") != k), folded.filter(F.col("fold") == k)
        features = fit_features(inside, "clean_text", max_features, frequencies=without(k, True))
        size = len(feature_names(features))

        def vectors(df: DataFrame) -> DataFrame:
            return transformed(features, df.withColumn("label", binary_label(F.col("label")))).select(
                row_id, "label", "features"
            )

        known = dealt_for_sums(vectors(inside), row_id, inside.count()).persist(StorageLevel.MEMORY_AND_DISK)
        # rows are known by a number: ids may be null or shared
        held = stored(vectors(outside).withColumn("number", F.monotonically_increasing_id()), "held_out")
        parts = [_judged_linear(known, held, size, row_id, others, parallelism)] if others else []
        parts += [_judged_forests(known, held, size, row_id, forests)] if forests else []
        found = stored(m.binary_metrics(union(parts), ["candidate"]), "grid")  # a row a candidate
        known.unpersist()
        drop_stored(held)
        return found

    n = folded.count()
    with ThreadPool(folds_at_once(folds, n - n // folds)) as pool:
        per_fold = union(pool.map(judged_fold, range(folds), 1))
    return per_fold.groupBy("candidate").agg(F.round(F.avg("f1_score"), 6).alias("mean_f1"))


def _judged_linear(known: DataFrame, held: DataFrame, size: int, row_id: str, grid: dict, parallelism: int) -> DataFrame:
    """``(label, candidate, predicted)`` of the logistic models and of the machines, which share kernel features of a width."""
    n, judged, fitted = known.count(), held, {}
    machines = {name: c for name, c in grid.items() if isinstance(c, MachineCandidate)}
    plain = {name: build(n) for name, build in grid.items() if name not in machines}
    shared = [(known, plain | {name: _machine(c, n, "features") for name, c in machines.items() if c.gamma is None})]
    for gamma in sorted({c.gamma for c in machines.values() if c.gamma}):
        width, column = scale_gamma(known, size) if gamma == "scale" else 1.0 / size, f"mapped_{gamma}"
        mapper = fit_landmarks(known, row_id, size, width, seed=SEED, output_col=column)
        judged = mapper.transform(judged)
        mapped = mapper.transform(known).select("label", column).persist(StorageLevel.MEMORY_AND_DISK)
        shared.append((mapped, {name: _machine(c, n, column) for name, c in machines.items() if c.gamma == gamma}))
    for rows, estimators in shared:
        with ThreadPool(parallelism) as pool:
            fitted |= zip(estimators, pool.map(lambda e, rows=rows: e.fit(rows), estimators.values()))
        if rows is not known:
            rows.unpersist()
    calls = []
    for at, name in enumerate(grid):
        model, call = fitted[name], f"_call_{at}"
        model = model.copy({p: f"_{p.name}_{at}" for p in _judging(model)} | {model.predictionCol: call})
        judged = model.transform(judged).drop(*[f"_{p.name}_{at}" for p in _judging(model)])
        calls.append(F.struct(F.lit(name).alias("candidate"), F.col(call).cast("int").alias("predicted")))
    return judged.select(F.col("label").cast("int").alias("label"), F.inline(F.array(*calls)))


def _machine(candidate: MachineCandidate, n: int, features: str) -> LinearSVC:
    return LinearSVC(
        featuresCol=features, regParam=1.0 / (candidate.c * max(n, 1)), maxIter=100, tol=MARGIN_TOLERANCE, standardization=False
    )


def _judging(model) -> list:
    """Columns that a model adds beside its prediction."""
    return [model.getParam(name) for name in ("rawPredictionCol", "probabilityCol") if model.hasParam(name)]


def _judged_forests(known: DataFrame, held: DataFrame, size: int, row_id: str, grid: dict[str, ForestCandidate]) -> DataFrame:
    """``(label, candidate, predicted)`` of forests, which are all parts of the largest one.

    Draws go by tree and node, so fewer trees are the first ones, and less deep trees the tops of the deepest.  Some trees at a time are
    grown and leave their sums on the held-out rows: the driver never holds the whole forest.
    """
    blocks, edges, n = in_blocks(known, row_id, size)
    limits = sorted({(c.depth, c.split) for c in grid.values()}, key=repr)
    depth = None if any(d is None for d, _ in limits) else max(d for d, _ in limits)
    counts, path, spark = sorted({c.trees for c in grid.values()}), scratch_path(known.sparkSession, "sums"), known.sparkSession
    for start, stop in zip([0, *counts], counts):
        for low in range(start, stop, trees_at_once(n)):
            some = range(low, min(low + trees_at_once(n), stop))
            nodes = grow_trees(blocks, size, n, some, depth, SEED)
            sums = limited(held, size, edges, nodes, limits).select(
                "number", "label", F.lit(stop).alias("upto"), F.lit(len(nodes["roots"])).alias("grown"), "sums"
            )
            sums.write.mode("append").parquet(path)
    drop_stored(blocks)
    calls = []
    for name, c in grid.items():
        mine = F.col("upto") <= c.trees
        share = F.sum(F.when(mine, F.col("sums")[limits.index((c.depth, c.split))])) / F.sum(F.when(mine, F.col("grown")))
        calls.append(F.struct(F.lit(name).alias("candidate"), F.coalesce((share > 0.5).cast("int"), F.lit(0)).alias("predicted")))
    sums = spark.read.schema("number long, label double, upto int, grown int, sums array<double>").parquet(path)
    judged = sums.groupBy("number", "label").agg(F.array(*calls).alias("calls"))
    return judged.select(F.col("label").cast("int").alias("label"), F.inline("calls"))


def cross_domain_eval(
    spec: ModelSpec, corpus: DataFrame, domain: str, home: str, row_id: str = "id"
) -> DataFrame:
    """Fit on one domain, test on each; how far accuracy falls says how robust it is."""
    split = stratified_holdout(corpus, row_id, ["label", domain])
    model = fit_model(spec, split.filter((F.col(domain) == home) & (F.col("split") == "train")), row_id)
    scored = score(model, split.filter(F.col("split") == "test"), spec.name, row_id, keep=(domain,))
    rates = stored(m.binary_metrics(scored, [domain]), "domains")
    at_home = rates.filter(F.col(domain) == home).select("accuracy")
    drop = F.round(at_home.scalar() - F.col("accuracy"), 6)
    verdict = (
        F.when(drop < fv.ROBUST_DROP, "robust").when(drop > fv.OVERFIT_DROP, "overfit").otherwise("between")
    )
    return rates.withColumns({"drop": drop, "verdict": verdict})


def unseen_source_eval(
    spec: ModelSpec, corpus: DataFrame, source: str, held_out: str, row_id: str = "id"
) -> DataFrame:
    """Metrics on a source the model never saw."""
    model = fit_model(spec, corpus.filter(F.col(source) != held_out), row_id)
    scored = score(model, corpus.filter(F.col(source) == held_out), spec.name, row_id, keep=(source,))
    return m.binary_metrics(scored, ["model", source])


FEATURE_GROUPS = {
    "length": ("char_length", "word_total", "sentence_total", "mean_sentence_words"),
    "punctuation": ("comma_density", "exclaim_question", "punctuation_density"),
    "wording": ("common_words", "vocabulary_diversity", "type_token_ratio", "mean_word_chars"),
    "case": ("uppercase_share",),
}


def ablation(train: DataFrame, test: DataFrame, row_id: str = "id") -> DataFrame:
    """Logistic regression on style features with each feature group left out in turn."""
    text = F.col("clean_text")
    columns = {**linguistic_features(text), **style_features(text)}

    def numbers(df: DataFrame) -> DataFrame:
        return df.select(row_id, binary_label(F.col("label")).alias("label"), *[
            c.cast("double").alias(k) for k, c in columns.items()
        ])

    known, unknown = packed(numbers(train)).persist(), numbers(test)
    parts = []
    for gone in ("none", *FEATURE_GROUPS):
        kept = [c for c in columns if c not in FEATURE_GROUPS.get(gone, ())]
        model = Pipeline(
            stages=[
                VectorAssembler(inputCols=kept, outputCol="features"),
                LogisticRegression(maxIter=100),
            ]
        ).fit(known)
        parts.append(
            model.transform(unknown).select(
                F.lit(gone).alias("left_out"),
                row_id,
                F.col("label").cast("int").alias("label"),
                F.col("prediction").cast("int").alias("predicted"),
                vector_to_array("probability")[1].alias("score"),
            )
        )
    known.unpersist()
    return m.binary_metrics(union(parts), ["left_out"])


def ensemble_stacking(val: DataFrame, test: DataFrame, members: list[str], row_id: str, **meta) -> DataFrame:
    """A logistic model (with the parameters ``meta``) over the members' probabilities, fitted on validation rows."""

    def wide(scored: DataFrame) -> DataFrame:
        return scored.groupBy(row_id, "label").pivot("model", members).agg(F.first("score"))

    model = Pipeline(
        stages=[
            VectorAssembler(inputCols=members, outputCol="features"),
            LogisticRegression(**{"maxIter": 100} | meta),
        ]
    ).fit(wide(val).withColumn("label", F.col("label").cast("double")))
    return model.transform(wide(test)).select(
        row_id,
        "label",
        F.col("prediction").cast("int").alias("predicted"),
        vector_to_array("probability")[1].alias("score"),
    )


def stack_models(
    specs: tuple[ModelSpec, ...], train: DataFrame, test: DataFrame, row_id: str = "id", folds: int = 5, **meta
) -> DataFrame:
    """Fitted models stacked: the upper model learns from out-of-fold scores, so from no score of a model that saw the row.

    On test rows the members are models of all training rows.
    """
    names = [s.name for s in specs]
    train = tokenised(train.select(row_id, "label", "clean_text"))
    inside = stored(out_of_fold(specs, train, row_id, folds), "out_of_fold")
    members = fit_models(specs, train, row_id)
    outside = score_all_models(members, test, row_id)
    return ensemble_stacking(inside, outside, names, row_id, **meta)


def embedding_features(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Stored sentence vectors as an ML feature column."""
    return df.withColumn("features", array_to_vector(F.col(vector).cast("array<double>")))


def train_embedding_classifier(df: DataFrame, row_id: str, label: str) -> DataFrame:
    """Logistic regression over stored vectors, scored on a stratified holdout."""
    split = stratified_holdout(df, row_id, [label])
    rows = embedding_features(split).withColumn("label", F.col(label).cast("double"))
    model = LogisticRegression(maxIter=100).fit(rows.filter(F.col("split") == "train"))
    return model.transform(rows.filter(F.col("split") == "test")).select(
        row_id,
        F.col("label").cast("int").alias("label"),
        F.col("prediction").cast("int").alias("predicted"),
        F.array_max(vector_to_array("probability")).alias("confidence"),
    )


def word_vector_mean(
    docs: DataFrame, row_id: str, text: str, size: int = 32, min_count: int = 5, tasks: int | None = None
) -> DataFrame:
    """The mean of a text's word vectors, learnt from the corpus itself, in ``tasks`` parts or by the number of tokens."""
    return mean_vectors(docs.select(row_id, tokenize(F.col(text)).alias("tokens")), row_id, size, min_count, tasks, SEED)

