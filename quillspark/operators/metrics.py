"""Evaluation from one long table ``(model, row, label, predicted, score)``.

``label`` and ``predicted`` are 0/1, ``score`` is the probability of class 1.
``pos_label`` says which class counts as positive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark import fixed_values as fv
from quillspark.operators.running import running_totals


def share(part: Column, whole: Column) -> Column:
    """``part / whole``, zero when there is nothing to divide by."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def outcome_counts(pos_label: int = 1) -> dict[str, Column]:
    actual, called = F.col("label") == pos_label, F.col("predicted") == pos_label
    return {
        "tp": F.count(F.when(actual & called, 1)),
        "fp": F.count(F.when(~actual & called, 1)),
        "fn": F.count(F.when(actual & ~called, 1)),
        "tn": F.count(F.when(~actual & ~called, 1)),
    }


def with_rates(counts: DataFrame, digits: int = 6) -> DataFrame:
    """Replace ``tp fp fn tn`` by accuracy, precision, recall and F1."""
    tp, fp, fn, tn = map(F.col, ("tp", "fp", "fn", "tn"))
    rates = {
        "accuracy": share(tp + tn, tp + fp + fn + tn),
        "precision": share(tp, tp + fp),
        "recall": share(tp, tp + fn),
        "f1_score": share(2 * tp, 2 * tp + fp + fn),
    }
    return counts.withColumns({k: F.round(v, digits) for k, v in rates.items()}).drop(
        "tp", "fp", "fn", "tn"
    )


def binary_metrics(scored: DataFrame, by: list[str], pos_label: int = 1) -> DataFrame:
    counts = scored.groupBy(*by).agg(*[c.alias(k) for k, c in outcome_counts(pos_label).items()])
    return with_rates(counts)


def confusion_matrix(scored: DataFrame, by: list[str]) -> DataFrame:
    """All four cells per model, empty ones as zero."""
    counts = scored.groupBy(*by).agg(*[c.alias(k) for k, c in outcome_counts(1).items()])
    cells = F.array(
        *[
            F.struct(F.lit(a).alias("label"), F.lit(p).alias("predicted"), F.col(k).alias("texts"))
            for a, p, k in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
        ]
    )
    return counts.select(*by, F.inline(cells))


def classification_report(scored: DataFrame, by: list[str]) -> DataFrame:
    """Per class precision, recall, F1 and support, with accuracy and both averages."""
    counts = scored.groupBy(*by).agg(*[c.alias(k) for k, c in outcome_counts(1).items()])
    tp, fp, fn, tn = map(F.col, ("tp", "fp", "fn", "tn"))

    def line(name: str, hit: Column, false: Column, miss: Column) -> Column:
        return F.struct(
            F.lit(name).alias("row"),
            share(hit, hit + false).alias("precision"),
            share(hit, hit + miss).alias("recall"),
            share(2 * hit, 2 * hit + false + miss).alias("f1_score"),
            (hit + miss).alias("support"),
        )

    both = counts.select(
        *by,
        line("human", tn, fn, fp).alias("h"),
        line("ai", tp, fp, fn).alias("a"),
        share(tp + tn, tp + fp + fn + tn).alias("acc"),
    )
    total = F.col("h.support") + F.col("a.support")

    def average(name: str, human: Column, ai: Column) -> Column:
        def mix(f: str) -> Column:
            return share(F.col(f"h.{f}") * human + F.col(f"a.{f}") * ai, human + ai).alias(f)

        return F.struct(
            F.lit(name).alias("row"), mix("precision"), mix("recall"), mix("f1_score"),
            total.alias("support"),
        )

    accuracy = F.struct(
        F.lit("accuracy").alias("row"), F.col("acc").alias("precision"), F.col("acc").alias("recall"),
        F.col("acc").alias("f1_score"), total.alias("support"),
    )
    rows = F.array(
        F.col("h"),
        F.col("a"),
        accuracy,
        average("macro avg", F.lit(1.0), F.lit(1.0)),
        average("weighted avg", F.col("h.support"), F.col("a.support")),
    )
    out = both.select(*by, F.inline(rows))
    return out.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1_score")})


def score_points(scored: DataFrame, by: list[str], pos_label: int = 1) -> DataFrame:
    """One row per distinct score, highest first, with running positives and negatives.

    Tied scores collapse map-side into a single point before anything is sorted.
    """
    positive = F.col("label") == pos_label
    points = scored.groupBy(*by, F.col("score").cast("double").alias("score")).agg(
        F.count(F.when(positive, 1)).alias("pos"), F.count(F.when(~positive, 1)).alias("neg")
    )
    order = [*map(F.col, by), F.col("score").desc()]
    return running_totals(points, order, ["pos", "neg"], by)


def roc_curve(scored: DataFrame, by: list[str], pos_label: int = 1) -> DataFrame:
    """Every distinct threshold, and the (0, 0) start under a null threshold."""
    points = score_points(scored, by, pos_label)
    curve = points.select(
        *by,
        F.col("score").alias("threshold"),
        F.round(share(F.col("neg_running"), F.col("neg_total")), 6).alias("fpr"),
        F.round(share(F.col("pos_running"), F.col("pos_total")), 6).alias("tpr"),
    )
    start = scored.select(*by).distinct().select(
        *by,
        F.lit(None).cast("double").alias("threshold"),
        F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"),
    )
    return curve.unionByName(start)


def pr_curve(scored: DataFrame, by: list[str], pos_label: int = 1) -> DataFrame:
    """Every distinct threshold, and the (1, 0) end under a null threshold."""
    points = score_points(scored, by, pos_label)
    hit, called = F.col("pos_running"), F.col("pos_running") + F.col("neg_running")
    curve = points.select(
        *by,
        F.col("score").alias("threshold"),
        F.round(share(hit, called), 6).alias("precision"),
        F.round(share(hit, F.col("pos_total")), 6).alias("recall"),
    )
    end = scored.select(*by).distinct().select(
        *by,
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return curve.unionByName(end)


def roc_auc(scored: DataFrame, by: list[str], pos_label: int = 1) -> DataFrame:
    """Area under the ROC curve; ties count half; null when one class is missing."""
    points = score_points(scored, by, pos_label)
    # pairs won by the positives at or above each point's negatives, ties at a half
    area = F.sum(F.col("neg") * (F.col("pos_running") - F.col("pos") / 2))
    pairs = F.max("pos_total").cast("double") * F.max("neg_total")
    auc = F.round(F.try_divide(area, pairs), 6)
    return points.groupBy(*by).agg(auc.alias("auc"))


def average_precision(scored: DataFrame, by: list[str], pos_label: int = 1) -> DataFrame:
    points = score_points(scored, by, pos_label)
    precision = F.col("pos_running") / (F.col("pos_running") + F.col("neg_running"))
    gained = F.sum(F.col("pos") * precision)
    total = F.max("pos_total")
    return points.groupBy(*by).agg(
        F.round(F.try_divide(gained, total), 6).alias("average_precision")
    )


def error_type() -> Column:
    """false_positive: a human text called ai."""
    return F.when((F.col("label") == 0) & (F.col("predicted") == 1), F.lit("false_positive")).when(
        (F.col("label") == 1) & (F.col("predicted") == 0), F.lit("false_negative")
    )


def confidence() -> Column:
    return F.greatest(F.col("score"), 1 - F.col("score"))


def misclassified_rows(truth: DataFrame, predictions: DataFrame, row_id: str) -> DataFrame:
    """Test rows whose prediction is wrong, with how sure the model was."""
    joined = predictions.join(truth, row_id)
    return joined.filter(F.col("label") != F.col("predicted")).withColumns(
        {"error_type": error_type(), "confidence": confidence()}
    )


def error_summary(scored: DataFrame, by: list[str]) -> DataFrame:
    wrong = F.count(F.when(F.col("label") != F.col("predicted"), 1))
    total = F.count(F.lit(1))
    kinds = outcome_counts(1)
    return scored.groupBy(*by).agg(
        total.alias("total_test_samples"),
        wrong.alias("total_misclassified"),
        kinds["fp"].alias("false_positives"),
        kinds["fn"].alias("false_negatives"),
        F.round(share(wrong, total), 6).alias("error_rate"),
    )


def error_examples(wrong: DataFrame, by: list[str], row_id: str, most: int = 10) -> DataFrame:
    """The first few errors of each kind, by id.

    Spark keeps only ``most`` rows per group in every map task before the sort.
    """
    w = W.partitionBy(*by, "error_type").orderBy(row_id)
    return wrong.withColumn("example", F.row_number().over(w)).filter(F.col("example") <= most)


def prediction_confidence(scored: DataFrame, row_id: str, most: int = 5) -> DataFrame:
    """Label, both probabilities and confidence of the first texts by id."""
    return scored.orderBy(row_id).limit(most).select(
        row_id,
        "predicted",
        (1 - F.col("score")).alias("human_probability"),
        F.col("score").alias("ai_probability"),
        confidence().alias("confidence"),
    )


def fairness_rates(scored: DataFrame, group: str, by: tuple[str, ...] = ()) -> DataFrame:
    """False positive and negative rates per group and over ``all``, for each ``by`` (a model, say)."""
    counts = scored.rollup(*by, group).agg(
        F.grouping_id().alias("_level"), *[c.alias(k) for k, c in outcome_counts(1).items()]
    )
    tp, fp, fn, tn = map(F.col, ("tp", "fp", "fn", "tn"))
    return counts.filter(F.col("_level") <= 1).select(
        *by,
        F.when(F.col("_level") == 1, F.lit("all")).otherwise(F.col(group)).alias("group"),
        (tp + fp + fn + tn).alias("texts"),
        F.round(share(fp, fp + tn), 6).alias("false_positive_rate"),
        F.round(share(fn, fn + tp), 6).alias("false_negative_rate"),
    )


def threshold_policy(scored: DataFrame, by: list[str], threshold: float = fv.FLAG_THRESHOLD):
    """Metrics when a text is flagged only above a high threshold."""
    flagged = scored.withColumn("predicted", (F.col("score") > threshold).cast("int"))
    counts = flagged.groupBy(*by).agg(
        F.sum("predicted").alias("flagged"),
        *[c.alias(k) for k, c in outcome_counts(1).items()],
    )
    return with_rates(
        counts.withColumn(
            "false_positive_rate", F.round(share(F.col("fp"), F.col("fp") + F.col("tn")), 6)
        )
    )


def drift_monitor(scored: DataFrame, ts: str, length: str = "1 day") -> DataFrame:
    """Accuracy and false positive rate over time, with an alert on low accuracy."""
    counts = scored.groupBy(F.window(ts, length).alias("w")).agg(
        *[c.alias(k) for k, c in outcome_counts(1).items()]
    )
    return drift_report(counts)


def drift_report(counts: DataFrame) -> DataFrame:
    tp, fp, fn, tn = map(F.col, ("tp", "fp", "fn", "tn"))
    accuracy = share(tp + tn, tp + fp + fn + tn)
    return counts.select(
        F.col("w.start").alias("window_start"),
        (tp + fp + fn + tn).alias("texts"),
        F.round(accuracy, 6).alias("accuracy"),
        F.round(share(fp, fp + tn), 6).alias("false_positive_rate"),
        (accuracy < fv.ALERT_ACCURACY).alias("alert"),
    )
