"""Evaluation of scored texts, and comparison of models."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.catalog import base as b
from quillspark.catalog.base import query, table
from quillspark.catalog.corpus_queries import keys
from quillspark.functions.labels import performance_grade
from quillspark.operators import comparison, ensemble, metrics, profile, splits

COUNTS = """counts AS (SELECT model, count(*) FILTER (label = 1 AND predicted = 1) AS tp,
  count(*) FILTER (label = 0 AND predicted = 1) AS fp, count(*) FILTER (label = 1 AND predicted = 0) AS fn,
  count(*) FILTER (label = 0 AND predicted = 0) AS tn FROM scored GROUP BY model)"""


def ratio(part: str, whole: str) -> str:
    return f"coalesce(({part})::DOUBLE / nullif({whole}, 0), 0)"


def rates(prefix: str = "") -> str:
    return f"""round({ratio('tp + tn', 'tp + fp + fn + tn')}, 6) AS {prefix}accuracy,
      round({ratio('tp', 'tp + fp')}, 6) AS {prefix}precision, round({ratio('tp', 'tp + fn')}, 6) AS {prefix}recall,
      round({ratio('2 * tp', '2 * tp + fp + fn')}, 6) AS {prefix}f1_score"""


@query("binary_metrics", f"WITH {b.SCORED}, {COUNTS} SELECT model, {rates()} FROM counts")
def _binary(spark, sf):
    return metrics.binary_metrics(b.scored(spark, sf), ["model"])


@query(
    "confusion_matrix",
    f"""WITH {b.SCORED}, {COUNTS}
    SELECT model, 0::BIGINT AS label, 0::BIGINT AS predicted, tn AS texts FROM counts
    UNION ALL SELECT model, 0, 1, fp FROM counts UNION ALL SELECT model, 1, 0, fn FROM counts
    UNION ALL SELECT model, 1, 1, tp FROM counts""",
)
def _confusion(spark, sf):
    return metrics.confusion_matrix(b.scored(spark, sf), ["model"])


@query(
    "classification_report",
    f"""WITH {b.SCORED}, {COUNTS},
    r AS (SELECT model, tn + fp AS nh, fn + tp AS na,
      {ratio('tn', 'tn + fn')} AS ph, {ratio('tn', 'tn + fp')} AS rh, {ratio('2 * tn', '2 * tn + fn + fp')} AS fh,
      {ratio('tp', 'tp + fp')} AS pa, {ratio('tp', 'tp + fn')} AS ra, {ratio('2 * tp', '2 * tp + fp + fn')} AS fa,
      {ratio('tp + tn', 'tp + fp + fn + tn')} AS acc FROM counts)
    SELECT model, 'human' AS row, round(ph, 6) AS precision, round(rh, 6) AS recall, round(fh, 6) AS f1_score,
           nh AS support FROM r
    UNION ALL SELECT model, 'ai', round(pa, 6), round(ra, 6), round(fa, 6), na FROM r
    UNION ALL SELECT model, 'accuracy', round(acc, 6), round(acc, 6), round(acc, 6), nh + na FROM r
    UNION ALL SELECT model, 'macro avg', round((ph + pa) / 2, 6), round((rh + ra) / 2, 6),
           round((fh + fa) / 2, 6), nh + na FROM r
    UNION ALL SELECT model, 'weighted avg', round((ph * nh + pa * na) / (nh + na), 6),
           round((rh * nh + ra * na) / (nh + na), 6), round((fh * nh + fa * na) / (nh + na), 6), nh + na FROM r""",
)
def _report(spark, sf):
    return metrics.classification_report(b.scored(spark, sf), ["model"])


POINTS = """points AS (SELECT model, score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg
  FROM scored GROUP BY model, score),
curve AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY model) AS p,
  sum(neg) OVER (PARTITION BY model) AS n, sum(neg) OVER w - neg AS fp0, sum(pos) OVER w - pos AS tp0
  FROM points WINDOW w AS (PARTITION BY model ORDER BY score DESC))"""


@query(
    "roc_curve",
    f"""WITH {b.SCORED}, {POINTS}
    SELECT model, score AS threshold, round(fp / n::DOUBLE, 6) AS fpr, round(tp / p::DOUBLE, 6) AS tpr FROM curve
    UNION ALL SELECT DISTINCT model, NULL::DOUBLE, 0::DOUBLE, 0::DOUBLE FROM curve""",
)
def _roc(spark, sf):
    return metrics.roc_curve(b.scored(spark, sf), ["model"])


@query(
    "pr_curve",
    f"""WITH {b.SCORED}, {POINTS}
    SELECT model, score AS threshold, round(tp / (tp + fp)::DOUBLE, 6) AS precision,
           round(tp / p::DOUBLE, 6) AS recall FROM curve
    UNION ALL SELECT DISTINCT model, NULL::DOUBLE, 1::DOUBLE, 0::DOUBLE FROM curve""",
)
def _pr(spark, sf):
    return metrics.pr_curve(b.scored(spark, sf), ["model"])


@query(
    "roc_auc",
    f"""WITH {b.SCORED}, {POINTS}
    SELECT model, round(sum((fp - fp0)::DOUBLE * (tp + tp0) / 2) / (max(p)::DOUBLE * max(n)), 6) AS auc
    FROM curve GROUP BY model""",
)
def _auc(spark, sf):
    return metrics.roc_auc(b.scored(spark, sf), ["model"])


@query(
    "average_precision",
    f"""WITH {b.SCORED}, {POINTS}
    SELECT model, round(sum((tp - tp0)::DOUBLE / p * (tp / (tp + fp)::DOUBLE)), 6) AS average_precision
    FROM curve GROUP BY model""",
)
def _ap(spark, sf):
    return metrics.average_precision(b.scored(spark, sf), ["model"])


WRONG = """wrong AS (SELECT model, doc_id, label, predicted, score,
  CASE WHEN label = 0 THEN 'false_positive' ELSE 'false_negative' END AS error_type,
  greatest(score, 1 - score) AS confidence FROM scored WHERE label <> predicted)"""


def wrong_rows(spark, sf):
    scored = b.scored(spark, sf)
    truth = b.labelled(spark, sf).select(
        "doc_id", F.when(F.col("label") == "ai", 1).otherwise(0).alias("label")
    )
    return metrics.misclassified_rows(
        truth, scored.select("model", "doc_id", "predicted", "score"), "doc_id"
    ).withColumn("confidence", F.round("confidence", 6))


@query(
    "misclassified_rows",
    f"""WITH {b.SCORED}, {WRONG} SELECT model, doc_id, label::BIGINT AS label, predicted::BIGINT AS predicted,
        score, error_type, round(confidence, 6) AS confidence FROM wrong""",
)
def _misclassified(spark, sf):
    return wrong_rows(spark, sf)


@query(
    "error_examples",
    f"""WITH {b.SCORED}, {WRONG} SELECT model, error_type, doc_id, example, round(confidence, 6) AS confidence
    FROM (SELECT *, row_number() OVER (PARTITION BY model, error_type ORDER BY doc_id) AS example FROM wrong)
    WHERE example <= 10""",
)
def _error_examples(spark, sf):
    return metrics.error_examples(wrong_rows(spark, sf), ["model"], "doc_id").select(
        "model", "error_type", "doc_id", "example", "confidence"
    )


@query(
    "error_summary",
    f"""WITH {b.SCORED}, {COUNTS} SELECT model, tp + fp + fn + tn AS total_test_samples,
      fp + fn AS total_misclassified, fp AS false_positives, fn AS false_negatives,
      round((fp + fn) / (tp + fp + fn + tn)::DOUBLE, 6) AS error_rate FROM counts""",
)
def _error_summary(spark, sf):
    return metrics.error_summary(b.scored(spark, sf), ["model"])


@query(
    "batch_summary",
    f"""WITH {b.SCORED} SELECT model, count(*) FILTER (predicted = 0) AS human_texts,
      count(*) FILTER (predicted = 1) AS ai_texts, round(avg(greatest(score, 1 - score)), 6) AS mean_confidence
    FROM scored GROUP BY model""",
)
def _batch_summary(spark, sf):
    predictions = b.scored(spark, sf).select(
        "model",
        F.when(F.col("predicted") == 0, "Human").otherwise("AI").alias("predicted_label"),
        metrics.confidence().alias("confidence"),
    )
    summary = profile.batch_summary(predictions, ["model"])
    return summary.withColumn("mean_confidence", F.round("mean_confidence", 6))


@query(
    "fairness_rates",
    f"""WITH {b.SCORED}, g AS (SELECT model, lang, grouping(lang) AS top, count(*) AS texts,
      count(*) FILTER (label = 1 AND predicted = 1) AS tp, count(*) FILTER (label = 0 AND predicted = 1) AS fp,
      count(*) FILTER (label = 1 AND predicted = 0) AS fn, count(*) FILTER (label = 0 AND predicted = 0) AS tn
      FROM scored GROUP BY model, ROLLUP (lang))
    SELECT model, CASE WHEN top = 1 THEN 'all' ELSE lang END AS "group", texts,
      round({ratio('fp', 'fp + tn')}, 6) AS false_positive_rate,
      round({ratio('fn', 'fn + tp')}, 6) AS false_negative_rate FROM g""",
)
def _fairness(spark, sf):
    return metrics.fairness_rates(b.scored(spark, sf), "lang", ("model",))


@query(
    "threshold_policy",
    f"""WITH {b.SCORED}, s AS (SELECT model, label, CASE WHEN score > 0.9 THEN 1 ELSE 0 END AS predicted FROM scored),
    c AS (SELECT model, sum(predicted)::BIGINT AS flagged, count(*) FILTER (label = 1 AND predicted = 1) AS tp,
      count(*) FILTER (label = 0 AND predicted = 1) AS fp, count(*) FILTER (label = 1 AND predicted = 0) AS fn,
      count(*) FILTER (label = 0 AND predicted = 0) AS tn FROM s GROUP BY model)
    SELECT model, flagged, round({ratio('fp', 'fp + tn')}, 6) AS false_positive_rate, {rates()} FROM c""",
)
def _threshold(spark, sf):
    return metrics.threshold_policy(b.scored(spark, sf), ["model"])


JUDGED = """judged AS (SELECT event_id, ts, CASE WHEN event_type IN ('error', 'purchase') THEN 1 ELSE 0 END AS label,
  CASE WHEN value > 10 THEN 1 ELSE 0 END AS predicted FROM events)"""
DRIFT_SQL = f"""WITH {JUDGED}, c AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS w,
    count(*) FILTER (label = 1 AND predicted = 1) AS tp, count(*) FILTER (label = 0 AND predicted = 1) AS fp,
    count(*) FILTER (label = 1 AND predicted = 0) AS fn, count(*) FILTER (label = 0 AND predicted = 0) AS tn
  FROM judged GROUP BY 1)
SELECT strftime(w, '%Y-%m-%d') AS window_start, tp + fp + fn + tn AS texts,
  round({ratio('tp + tn', 'tp + fp + fn + tn')}, 6) AS accuracy,
  round({ratio('fp', 'fp + tn')}, 6) AS false_positive_rate,
  {ratio('tp + tn', 'tp + fp + fn + tn')} < 0.85 AS alert FROM c"""


@query("drift_monitor", DRIFT_SQL)
def _drift(spark, sf):
    out = metrics.drift_monitor(b.judged_events(spark, sf), "ts")
    return out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd"))


# --- model comparison --------------------------------------------------------------

PARTS = f"""{b.SCORED}, {b.split_sql('clean_labelled', 'doc_id', 'label', 0.2, 0.2)},
parts AS (SELECT s.*, r.split FROM scored s JOIN split_rows r ON s.doc_id = r.doc_id),
per AS (SELECT split, model, count(*) FILTER (label = 1 AND predicted = 1) AS tp,
  count(*) FILTER (label = 0 AND predicted = 1) AS fp, count(*) FILTER (label = 1 AND predicted = 0) AS fn,
  count(*) FILTER (label = 0 AND predicted = 0) AS tn FROM parts GROUP BY split, model)"""


def split_metrics(spark, sf):
    """Metrics per split and model; scores come from rules, so no fitting is involved."""
    parts = splits.stratified_split(keys(spark, sf), "doc_id", ["label"]).select("doc_id", "split")
    return metrics.binary_metrics(b.scored(spark, sf).join(parts, "doc_id"), ["split", "model"])


def of_split(spark, sf, name):
    return split_metrics(spark, sf).filter(F.col("split") == name).drop("split")


@query(
    "merge_val_test_metrics",
    f"""WITH {PARTS}, v AS (SELECT model, {rates('val_')} FROM per WHERE split = 'val'),
    t AS (SELECT model, {rates('test_')} FROM per WHERE split = 'test')
    SELECT * FROM v JOIN t USING (model)""",
)
def _merge(spark, sf):
    table_ = split_metrics(spark, sf)
    val, test = (table_.filter(F.col("split") == s).drop("split") for s in ("val", "test"))
    return comparison.merge_val_test_metrics(val, test)


@query(
    "metric_comparison",
    f"""WITH {PARTS}, t AS (SELECT model, {rates()} FROM per WHERE split = 'test')
    SELECT model, 'accuracy' AS metric, accuracy AS value FROM t UNION ALL SELECT model, 'precision', precision FROM t
    UNION ALL SELECT model, 'recall', recall FROM t UNION ALL SELECT model, 'f1_score', f1_score FROM t
    UNION ALL SELECT model, 'auc', 0::DOUBLE FROM t UNION ALL SELECT model, 'train_time', 0::DOUBLE FROM t""",
)
def _comparison(spark, sf):
    return comparison.metric_comparison(of_split(spark, sf, "test"))


GRADE = "CASE WHEN f1_score > 0.85 THEN 'PROCEED' WHEN f1_score > 0.75 THEN 'IMPROVE' ELSE 'REDESIGN' END"


@query(
    "rank_models",
    f"""WITH {b.SCORED}, {COUNTS}, t AS (SELECT model, {rates()} FROM counts)
    SELECT *, {GRADE} AS grade FROM t ORDER BY f1_score DESC, model""",
)
def _rank(spark, sf):
    return comparison.rank_models(metrics.binary_metrics(b.scored(spark, sf), ["model"]))


@query(
    "best_model",
    f"""WITH {PARTS}, t AS (SELECT model, {rates()} FROM per WHERE split = 'test')
    SELECT model, f1_score AS best_score FROM t ORDER BY f1_score DESC, model LIMIT 1""",
)
def _best(spark, sf):
    return comparison.best_model(of_split(spark, sf, "test"))


@query(
    "performance_grade",
    f"""WITH {b.SCORED}, g AS (SELECT model, lang, count(*) FILTER (label = 0 AND predicted = 0) AS tp,
      count(*) FILTER (label = 1 AND predicted = 0) AS fp, count(*) FILTER (label = 0 AND predicted = 1) AS fn,
      count(*) FILTER (label = 1 AND predicted = 1) AS tn FROM scored GROUP BY model, lang),
    t AS (SELECT model, lang, {rates()} FROM g) SELECT model, lang, f1_score, {GRADE} AS grade FROM t""",
)
def _grade(spark, sf):
    """Human as the positive class."""
    table_ = metrics.binary_metrics(b.scored(spark, sf), ["model", "lang"], pos_label=0)
    return table_.select("model", "lang", "f1_score", performance_grade(F.col("f1_score")).alias("grade"))


FOLDS = f"""{b.SCORED}, {b.split_sql('clean_labelled', 'doc_id', 'label', 0.2, 0.2)},
folded AS (SELECT s.model, s.label, s.predicted, (rk > round(n * 1 / 5.0::DOUBLE))::INT
  + (rk > round(n * 2 / 5.0::DOUBLE))::INT + (rk > round(n * 3 / 5.0::DOUBLE))::INT
  + (rk > round(n * 4 / 5.0::DOUBLE))::INT AS fold FROM scored s JOIN split_rows r ON s.doc_id = r.doc_id),
folds AS (SELECT model, fold, round(avg((label = predicted)::INT), 6) AS accuracy FROM folded GROUP BY ALL)"""


def fold_accuracy(spark, sf):
    folds = splits.stratified_kfold(keys(spark, sf), "doc_id", ["label"]).select("doc_id", "fold")
    joined = b.scored(spark, sf).join(folds, "doc_id")
    return metrics.binary_metrics(joined, ["model", "fold"]).select("model", "fold", "accuracy")


@query(
    "cv_summary",
    f"""WITH {FOLDS} SELECT model, round(avg(accuracy), 6) AS cv_mean, round(stddev_pop(accuracy), 6) AS cv_std
    FROM folds GROUP BY model""",
)
def _cv(spark, sf):
    return comparison.cv_summary(fold_accuracy(spark, sf))


SPEEDS = """speeds AS (SELECT event_type AS model, sum(value) AS train_time, stddev_pop(value) AS cv_std
  FROM events GROUP BY event_type)"""


@query(
    "speed_summary",
    f"""WITH {SPEEDS} SELECT (SELECT model FROM speeds ORDER BY train_time, model LIMIT 1) AS fastest_model,
      (SELECT model FROM speeds ORDER BY train_time DESC, model LIMIT 1) AS slowest_model,
      (SELECT round(max(train_time) / min(train_time), 6) FROM speeds) AS speed_ratio,
      (SELECT model FROM speeds ORDER BY cv_std, model LIMIT 1) AS most_stable_model""",
)
def _speed(spark, sf):
    """Event values read as run times."""
    runs = table(spark, sf, "events").groupBy(F.col("event_type").alias("model")).agg(
        F.sum("value").alias("train_time"), F.stddev_pop("value").alias("cv_std")
    )
    return comparison.speed_summary(runs)


# --- ensembles -----------------------------------------------------------------------


def _ensemble_sql(mean: str, extra: str = "") -> str:
    return f"""WITH {b.SCORED}{extra}, e AS (SELECT doc_id, label, round({mean}, 6) AS score FROM scored s
      {'JOIN acc USING (model)' if extra else ''} GROUP BY doc_id, label)
    SELECT doc_id, label::BIGINT AS label, score, (score >= 0.5)::BIGINT AS predicted FROM e"""


@query("ensemble_vote", _ensemble_sql("avg(CASE WHEN score >= 0.5 THEN 1.0::DOUBLE ELSE 0 END)"))
def _vote(spark, sf):
    return ensemble.ensemble_vote(b.scored(spark, sf), "doc_id")


@query("ensemble_average", _ensemble_sql("avg(score)"))
def _average(spark, sf):
    return ensemble.ensemble_average(b.scored(spark, sf), "doc_id")


ACC = f""", {b.split_sql('clean_labelled', 'doc_id', 'label', 0.2, 0.2)},
acc AS (SELECT model, round(avg((s.label = predicted)::INT), 6) AS accuracy FROM scored s
        JOIN split_rows r ON s.doc_id = r.doc_id WHERE r.split = 'val' GROUP BY model)"""


@query("ensemble_weighted", _ensemble_sql("sum(score * accuracy) / sum(accuracy)", ACC))
def _weighted(spark, sf):
    return ensemble.ensemble_weighted(b.scored(spark, sf), of_split(spark, sf, "val"), "doc_id")
