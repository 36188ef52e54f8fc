"""Fitted models over the labelled documents, beside SQL.

Multinomial naive Bayes has a closed form, so its queries are compared score by score.  An iterative fit has
none; its queries return what SQL can state of any sound fit (which rows, whose labels, probabilities that agree with
the predictions, measures within their limits), and ``tests/test_models.py`` looks at what the models learn.
"""

from __future__ import annotations

from dataclasses import replace

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from quillspark import fixed_values as fv
from quillspark.catalog import base as b
from quillspark.catalog.base import query, table
from quillspark.catalog.feature_queries import FREQ, KEPT, terms_sql, tfidf_sql, vocab_sql
from quillspark.catalog.metric_queries import rates
from quillspark.operators import metrics
from quillspark.operators.splits import stratified_split
from quillspark.plans import evaluate, landmarks, models, perceptron, prepare
from quillspark.plans.predict import predict_batch
from quillspark.session import scratch_path, stored
from quillspark.sources.models import load_best_model, load_model, save_model

ID = "doc_id"
SUITE_NAMES = [s.name for s in models.TRAINING_SUITE]


def corpus(spark, sf):
    """The prepared corpus, written once with its split."""
    return stored(prepare.prepare_corpus(b.labelled(spark, sf), ID), "prepared")


def parts(spark, sf):
    split = corpus(spark, sf)
    return split.filter(F.col("split") != "test"), split.filter(F.col("split") == "test")


def fitted(spark, sf, specs=(models.NAIVE_BAYES, models.LOGISTIC)):
    train, test = parts(spark, sf)
    return models.fit_models(specs, train, ID), test


# --- SQL: rows, and naive Bayes in closed form ---------------------------------------

PREPARED = f"{b.PREPARED}, {b.split_sql('prepared', 'doc_id', 'label', 0.2, 0.2)}"
TEST = f"{PREPARED}, test AS (SELECT *, (label = 'ai')::BIGINT AS y FROM split_rows WHERE split = 'test')"


def bayes_sql(train: str, test: str, terms: int = 10000) -> str:
    """``scored (test rows, y, p)``: p is the probability of ``ai``, as Spark smooths priors and terms."""
    return f"""train AS ({train}), test AS ({test}),
{terms_sql('train', False)}, {FREQ}, {vocab_sql(terms, 'train')}, {tfidf_sql('train')},
per AS (SELECT term, sum(CASE WHEN label = 'human' THEN weight ELSE 0 END) AS wh,
               sum(CASE WHEN label = 'ai' THEN weight ELSE 0 END) AS wa FROM weights GROUP BY term),
model AS (SELECT term, ln((wh + 1) / ((SELECT sum(wh) FROM per) + (SELECT count(*) FROM per))) AS lh,
                 ln((wa + 1) / ((SELECT sum(wa) FROM per) + (SELECT count(*) FROM per))) AS la FROM per),
prior AS (SELECT ln((count(*) FILTER (label = 'human') + 1) / (count(*) + 2.0::DOUBLE)) AS ph,
                 ln((count(*) FILTER (label = 'ai') + 1) / (count(*) + 2.0::DOUBLE)) AS pa FROM train),
tk AS (SELECT doc_id, unnest({KEPT}) AS term FROM test), tt AS (SELECT doc_id, term, count(*) AS n FROM tk GROUP BY ALL),
tr AS (SELECT t.doc_id, t.term, t.n * (ln((1 + (SELECT count(*) FROM train))::DOUBLE / (1 + v.doc_freq)) + 1) AS r
       FROM tt t JOIN vocab v ON t.term = v.term),
tw AS (SELECT doc_id, term, r / sqrt(sum(r * r) OVER (PARTITION BY doc_id)) AS w FROM tr),
e AS (SELECT doc_id, sum(w * lh) AS eh, sum(w * la) AS ea FROM tw JOIN model USING (term) GROUP BY doc_id),
scored AS (SELECT t.*, 1 / (1 + exp(-(coalesce(ea, 0) + pa - coalesce(eh, 0) - ph))) AS p
           FROM test t LEFT JOIN e ON t.doc_id = e.doc_id, prior)"""


IN_TRAIN = "SELECT * FROM split_rows WHERE split <> 'test'"
IN_TEST = "SELECT *, (label = 'ai')::BIGINT AS y FROM split_rows WHERE split = 'test'"
BAYES = f"{PREPARED}, {bayes_sql(IN_TRAIN, IN_TEST)}"
BAYES_ROWS = f"""WITH {BAYES} SELECT 'Naive_Bayes' AS model, doc_id, y AS label, (p > 0.5)::BIGINT AS predicted,
    round(p, 6) AS score FROM scored"""
OUTCOMES = """count(*) FILTER (y = 1 AND p > 0.5) AS tp, count(*) FILTER (y = 0 AND p > 0.5) AS fp,
    count(*) FILTER (y = 1 AND p <= 0.5) AS fn, count(*) FILTER (y = 0 AND p <= 0.5) AS tn"""


def rounded(scored):
    return scored.withColumn("score", F.round("score", 6))


def sound(scored, row_id=ID):
    """Each row with its label, and whether score and prediction agree."""
    agrees = (F.col("predicted") == (F.col("score") > 0.5).cast("int")) & F.col("score").between(0, 1)
    return scored.select("model", row_id, "label", agrees.alias("sound"))


def in_limits(table_, *keys):
    """Whether all measures of a row lie between 0 and 1."""
    measures = [c for c, t in table_.dtypes if t == "double" and c not in ("train_time", "predict_time")]
    inside = [F.coalesce(F.col(c).between(0, 1), F.lit(False)) for c in measures]
    return table_.select(*keys, F.forall(F.array(*inside), lambda x: x).alias("sound"))


def rows_sql(names):
    return " UNION ALL ".join(f"SELECT '{n}' AS model, doc_id, y AS label, true AS sound FROM test" for n in names)


# --- training ------------------------------------------------------------------------


def _trained(name, spec, **options):
    @query(name, f"WITH {TEST} {rows_sql([spec.name])}")
    def run(spark, sf):
        train, test = parts(spark, sf)
        model = models.fit_model(spec, train, ID, **options)
        return sound(models.score(model, test, spec.name, ID))


_trained("train_logistic", models.LOGISTIC)
_trained("train_random_forest", models.RANDOM_FOREST)
_trained("train_svm", models.SVM)
_trained("train_svm_linear", models.SVM, kernel="linear")
_trained("train_mlp", models.MLP)


@query("train_naive_bayes_ml", BAYES_ROWS)
def _bayes(spark, sf):
    members, test = fitted(spark, sf, (models.NAIVE_BAYES,))
    return rounded(models.score_all_models(members, test, ID))


@query(
    "train_embedding_classifier",
    f"""WITH {b.split_sql('embeddings', 'vec_id', 'label', 0.2, 0.0)}
    SELECT vec_id, label::BIGINT AS label, true AS sound FROM split_rows WHERE split = 'test'""",
)
def _embedding(spark, sf):
    vectors = table(spark, sf, "embeddings")
    classes = vectors.agg(F.max("label") + 1).scalar()
    scored = evaluate.train_embedding_classifier(vectors, "vec_id", "label")
    fine = F.col("predicted").between(0, classes - 1) & (F.col("confidence") * classes >= 1 - 1e-9) & (F.col("confidence") <= 1)
    return scored.select("vec_id", "label", fine.alias("sound"))


@query(
    "embedding_features",
    """SELECT vec_id, len(embedding) AS size, round(list_sum(list_transform(embedding,
       lambda x: x::DOUBLE * x::DOUBLE)), 6) AS squared_length FROM embeddings""",
)
def _embedding_features(spark, sf):
    back = vector_to_array("features")
    return evaluate.embedding_features(table(spark, sf, "embeddings")).select(
        "vec_id",
        F.size(back).alias("size"),
        F.round(F.aggregate(back, F.lit(0.0), lambda s, x: s + x * x), 6).alias("squared_length"),
    )


@query(
    "word_vector_mean",
    f"WITH {b.CLEAN_DOCS} SELECT doc_id, unnest(range(32)) AS dimension, true AS finite FROM clean_docs",
)
def _word_vectors(spark, sf):
    means = evaluate.word_vector_mean(b.clean_documents(spark, sf), ID, "clean_text")
    value = means.select(ID, F.posexplode("mean").alias("dimension", "value"))
    return value.select(ID, "dimension", (~F.isnan("value") & (F.abs("value") < 1e6)).alias("finite"))


# --- one step of the perceptron ----------------------------------------------------------

STEP_LAYERS = [2, 2, 1]
STEP_WEIGHTS = [((7 * i) % 11 - 5) / 10 for i in range(9)]
STEP_ALPHA, STEP_RATE = 0.01, 0.001


def step_sql():
    w = [f"({x}::DOUBLE)" for x in STEP_WEIGHTS]
    decay = [f"+ {STEP_ALPHA} / count(*) * {x}" for x in w]
    gradients = [
        f"avg(d * {w[6 + j]} * (z{j} > 0)::INT * {x}) {decay[2 * i + j] if x != '1' else ''}"
        for i, x in enumerate(("x0", "x1", "1")) for j in (0, 1)
    ] + [f"avg(d * h{j}) {decay[6 + j]}" for j in (0, 1)] + ["avg(d)"]
    return f"""WITH x AS (SELECT n_chars / 10000.0::DOUBLE AS x0, (lang = 'en')::INT::DOUBLE AS x1, quality AS y
      FROM documents JOIN labels USING (doc_id)),
    z AS (SELECT *, x0 * {w[0]} + x1 * {w[2]} + {w[4]} AS z0, x0 * {w[1]} + x1 * {w[3]} + {w[5]} AS z1 FROM x),
    h AS (SELECT *, greatest(z0, 0) AS h0, greatest(z1, 0) AS h1 FROM z),
    d AS (SELECT *, 1 / (1 + exp(-(h0 * {w[6]} + h1 * {w[7]} + {w[8]}))) - y AS d FROM h),
    g AS (SELECT [{', '.join(gradients)}] AS g FROM d),
    each AS (SELECT place, g[place + 1] AS g, [{', '.join(w)}][place + 1] AS w FROM g, range(9) t(place))
    SELECT place, round(g, 6) AS gradient, round(w - {STEP_RATE} * g / (abs(g) + 1e-8), 6) AS weight FROM each"""


@query("mlp_first_step", step_sql())
def _first_step(spark, sf):
    """Gradient and Adam step of a small perceptron over all labelled documents, from fixed weights."""
    cells = F.array((F.col("n_chars") / 10000.0).cast("double"), (F.col("lang") == "en").cast("double"))
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), ID).select(
        ID, F.col("quality").cast("double").alias("label"), array_to_vector(cells).alias("features")
    )
    start, n = np.array(STEP_WEIGHTS), rows.count()
    shards = perceptron.packed_shards(rows, ID, F.lit(False), n, STEP_LAYERS[0])
    mean, _, _ = perceptron.step_sums(shards, start, STEP_LAYERS, n)
    gradient = perceptron.penalised(mean, start, STEP_LAYERS, STEP_ALPHA, n)
    weights = perceptron.Adam(len(start), STEP_RATE).step(start, gradient)
    made = [(i, float(g), float(w)) for i, (g, w) in enumerate(zip(gradient, weights))]
    return spark.createDataFrame(made, "place long, gradient double, weight double").select(
        "place", F.round("gradient", 6).alias("gradient"), F.round("weight", 6).alias("weight")
    )


# --- the kernel under two landmarks -----------------------------------------------------

KERNEL_WIDTH = 0.5
# two landmarks: the inverse of their kernel matrix is written out
LANDMARK_SQL = f"""WITH x AS (SELECT doc_id, n_chars / 1000.0::DOUBLE AS a, (lang = 'en')::INT::DOUBLE AS b,
      row_number() OVER (ORDER BY {b.order_key('doc_id')}, doc_id) AS place FROM documents),
    k AS (SELECT x.doc_id, max(CASE WHEN l.place = 1 THEN v END) AS k1, max(CASE WHEN l.place = 2 THEN v END) AS k2
      FROM x, x l, LATERAL (SELECT exp(-{KERNEL_WIDTH} * ((x.a - l.a) ** 2 + (x.b - l.b) ** 2)) AS v)
      WHERE l.place <= 2 GROUP BY x.doc_id),
    w AS (SELECT k2 AS w FROM k JOIN x USING (doc_id) WHERE place = 1)
    SELECT doc_id, round(k1, 4) AS kernel_1, round(k2, 4) AS kernel_2,
           round(greatest(0, 1 - (k1 * k1 + k2 * k2 - 2 * w * k1 * k2) / (1 - w * w)), 4) AS residual FROM k, w"""


@query("landmark_kernel", LANDMARK_SQL)
def _landmark_kernel(spark, sf):
    """Products of all documents' features with those of two landmarks, and what the features miss of a row."""
    cells = F.array((F.col("n_chars") / 1000.0).cast("double"), (F.col("lang") == "en").cast("double"))
    rows = table(spark, sf, "documents").select(ID, array_to_vector(cells).alias("features"))
    mapper = landmarks.fit_landmarks(rows, ID, 2, KERNEL_WIDTH, count=2, rounds=1)
    dense, whiten, gamma = landmarks.decoded(mapper.getOrDefault(mapper.machine))
    own = landmarks.kernel_rows([None, None], list(dense.T), dense, gamma) @ whiten  # features of the landmarks
    products = [
        F.round(F.aggregate(F.zip_with("phi", F.array(*map(F.lit, map(float, z))), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x), 4)
        for z in own
    ]
    mapped = mapper.residuals(mapper.transform(rows)).withColumn("phi", vector_to_array("mapped"))
    return mapped.select(ID, products[0].alias("kernel_1"), products[1].alias("kernel_2"), F.round("residual", 4).alias("residual"))


# --- evaluation ----------------------------------------------------------------------


@query("score_all_models", f"WITH {TEST} {rows_sql(SUITE_NAMES)}")
def _score_all(spark, sf):
    members, test = fitted(spark, sf, models.TRAINING_SUITE)
    return sound(models.score_all_models(members, test, ID))


@query("evaluate_on_test", " UNION ALL ".join(f"SELECT '{n}' AS model, true AS sound" for n in SUITE_NAMES))
def _evaluate(spark, sf):
    members, test = fitted(spark, sf, models.TRAINING_SUITE)
    return in_limits(evaluate.evaluate_on_test(members, test, ID), "model")


def recorded(records):
    """Test rows per class from a record's confusion matrix, and whether its measures are in their limits."""
    cells = F.col("confusion_matrix")
    by_class = records.select(
        "model", (cells[0][0] + cells[0][1]).alias("human_texts"), (cells[1][0] + cells[1][1]).alias("ai_texts")
    )
    return by_class.join(in_limits(records, "model"), "model")


def records_sql(names):
    return f"WITH {TEST} " + " UNION ALL ".join(
        f"""SELECT '{n}' AS model, count(*) FILTER (y = 0) AS human_texts, count(*) FILTER (y = 1) AS ai_texts,
            true AS sound FROM test"""
        for n in names
    )


@query("fit_eval_record", records_sql([models.PROTOTYPE_SUITE[0].name]))
def _record(spark, sf):
    train, test = parts(spark, sf)
    return recorded(evaluate.fit_eval_record(models.PROTOTYPE_SUITE[0], train, test, ID, pos_label=0))


@query("run_model_suite", records_sql([s.name for s in models.PROTOTYPE_SUITE]))
def _suite(spark, sf):
    train, test = parts(spark, sf)
    return recorded(evaluate.run_model_suite(models.PROTOTYPE_SUITE, train, test, ID))


FOLD = " + ".join(f"(rk > round(n * {j} / 5.0::DOUBLE))::BIGINT" for j in range(1, 5))
FOLDED = f"""{PREPARED}, known AS (SELECT * EXCLUDE (rk, n, split) FROM split_rows WHERE split <> 'test'),
folded AS (SELECT * EXCLUDE (rk, n), {FOLD} AS fold FROM (SELECT *,
  row_number() OVER (PARTITION BY label ORDER BY {b.order_key('doc_id')}, doc_id) AS rk,
  count(*) OVER (PARTITION BY label) AS n FROM known))"""


def _fold_sql(k: int) -> str:
    test = f"SELECT *, (label = 'ai')::BIGINT AS y FROM folded WHERE fold = {k}"
    return f"""SELECT * FROM (WITH {bayes_sql(f'SELECT * FROM folded WHERE fold <> {k}', test)}
    SELECT 'Naive_Bayes' AS model, {k}::BIGINT AS fold, round(avg((y = (p > 0.5)::BIGINT)::BIGINT), 6) AS accuracy FROM scored)"""


@query("cross_validate", f"WITH {FOLDED} " + " UNION ALL ".join(map(_fold_sql, range(5))))
def _cross_validate(spark, sf):
    return evaluate.cross_validate(models.NAIVE_BAYES, parts(spark, sf)[0], ID)


@query(
    "cross_domain_eval",
    f"""WITH {b.PREPARED}, {b.split_sql('prepared', 'doc_id', 'label, lang', 0.2, 0.0)},
    {bayes_sql("SELECT * FROM split_rows WHERE lang = 'en' AND split = 'train'",
               "SELECT *, (label = 'ai')::BIGINT AS y FROM split_rows WHERE split = 'test'")},
    c AS (SELECT lang, {OUTCOMES} FROM scored GROUP BY lang), r AS (SELECT lang, {rates()} FROM c),
    d AS (SELECT *, round((SELECT accuracy FROM r WHERE lang = 'en') - accuracy, 6) AS drop FROM r)
    SELECT *, CASE WHEN drop < {fv.ROBUST_DROP} THEN 'robust' WHEN drop > {fv.OVERFIT_DROP} THEN 'overfit'
      ELSE 'between' END AS verdict FROM d""",
)
def _cross_domain(spark, sf):
    return evaluate.cross_domain_eval(models.NAIVE_BAYES, corpus(spark, sf), "lang", "en", ID)


@query(
    "unseen_source_eval",
    f"""WITH {b.PREPARED}, {bayes_sql("SELECT * FROM prepared WHERE source <> 'src0'",
      "SELECT *, (label = 'ai')::BIGINT AS y FROM prepared WHERE source = 'src0'")},
    c AS (SELECT source, {OUTCOMES} FROM scored GROUP BY source)
    SELECT 'Naive_Bayes' AS model, source, {rates()} FROM c""",
)
def _unseen(spark, sf):
    return evaluate.unseen_source_eval(models.NAIVE_BAYES, corpus(spark, sf), "source", "src0", ID)


@query("grid_search", " UNION ALL ".join(f"SELECT '{c}' AS candidate, true AS sound" for c in evaluate.GRID))
def _grid(spark, sf):
    return in_limits(evaluate.grid_search(parts(spark, sf)[0], ID), "candidate")


@query("ablation", " UNION ALL ".join(f"SELECT '{g}' AS left_out, true AS sound" for g in ("none", *evaluate.FEATURE_GROUPS)))
def _ablation(spark, sf):
    train, test = parts(spark, sf)
    return in_limits(evaluate.ablation(train, test, ID), "left_out")


@query(
    "ensemble_stacking",
    f"""WITH {b.CLEAN_LABELLED}, ids AS (SELECT doc_id, (label = 'ai')::BIGINT AS label FROM clean_labelled),
    {b.split_sql('ids', 'doc_id', 'label', 0.2, 0.2)}
    SELECT 'stacked' AS model, doc_id, label, true AS sound FROM split_rows WHERE split = 'test'""",
)
def _stacking(spark, sf):
    scored = b.scored(spark, sf)
    split = stratified_split(stored(scored.select(ID, "label").distinct(), "keys"), ID, ["label"])
    both = stored(scored.join(split.select(ID, "split"), ID), "members")
    val, test = (both.filter(F.col("split") == s) for s in ("val", "test"))
    return sound(evaluate.ensemble_stacking(val, test, list(b.SCORERS), ID).withColumn("model", F.lit("stacked")))


# --- out-of-fold scores, from which stacked models learn -------------------------------------------------

STACKED = (models.NAIVE_BAYES, replace(models.NAIVE_BAYES, name="Naive_Bayes_500", max_features=500))


def _member_sql(train: str, test: str, fold: str) -> str:
    """Scores of all members on the test rows of one fit."""
    return " UNION ALL ".join(
        f"""SELECT * FROM (WITH {bayes_sql(train, test, spec.max_features)}
        SELECT '{spec.name}' AS model, doc_id, {fold} AS fold, y, p FROM scored)"""
        for spec in STACKED
    )


OUT_OF_FOLD = f"{FOLDED}, inside AS (" + " UNION ALL ".join(
    _member_sql(f"SELECT * FROM folded WHERE fold <> {k}", f"SELECT *, (label = 'ai')::BIGINT AS y FROM folded WHERE fold = {k}", f"{k}::BIGINT")
    for k in range(5)
) + ")"


@query(
    "out_of_fold_scores",
    f"""WITH {OUT_OF_FOLD} SELECT model, doc_id, fold, y AS label, (p > 0.5)::BIGINT AS predicted,
    round(p, 6) AS score FROM inside""",
)
def _out_of_fold(spark, sf):
    return rounded(evaluate.out_of_fold(STACKED, parts(spark, sf)[0], ID))


# --- end to end: the best of the fitted models, judged and used ---------------------------------------


@query(
    "evaluate_best_model",
    f"""WITH {BAYES}, c AS (SELECT {OUTCOMES} FROM scored)
    SELECT 'Naive_Bayes' AS model, {rates()}, tn, fp, fn, tp FROM c""",
)
def _best(spark, sf):
    """The closed-form member alone, so that SQL can follow: best by F1, its measures and confusion cells."""
    members, test = fitted(spark, sf, (models.NAIVE_BAYES,))
    report = evaluate.evaluate_best_model(members, test, ID)
    return report["measures"].join(report["cells"], "model")


# --- saved models and prediction -----------------------------------------------------------


@query("save_model", BAYES_ROWS)
def _save(spark, sf):
    """Saved, read back by name, and applied."""
    members, test = fitted(spark, sf, (models.NAIVE_BAYES,))
    folder = scratch_path(spark, "models")
    for name, model in members.items():
        save_model(model, folder, name)
    return rounded(models.score(load_model(folder, "Naive_Bayes"), test, "Naive_Bayes", ID))


@query("load_model", f"WITH {TEST} SELECT doc_id, y AS label, true AS sound FROM test")
def _load(spark, sf):
    """The best of the saved models by test F1, applied."""
    members, test = fitted(spark, sf)
    folder = scratch_path(spark, "models")
    for name, model in members.items():
        save_model(model, folder, name)
    scored = models.score_all_models(members, test, ID)
    table_ = metrics.binary_metrics(scored, ["model"]).withColumnRenamed("f1_score", "test_f1_score")
    name, best = load_best_model(spark, folder, table_)
    return sound(models.score(best, test, name, ID)).drop("model")


FLAT = b.squash(rf"regexp_replace({b.squash('text')}, '[^\p{{L}}\p{{N}}_ .,;:!?()\-]', ' ', 'g')")
ASKED = f"SELECT doc_id, {FLAT} AS clean_text FROM documents WHERE length({FLAT}) >= {fv.MIN_SCORABLE_CHARS}"


@query(
    "predict_batch",
    f"""WITH asked AS ({ASKED}) SELECT doc_id AS text_id, 'Logistic_Regression' AS model_used,
    length(clean_text) AS text_length, true AS sound FROM asked""",
)
def _predict(spark, sf):
    """Every document through the model that the labelled ones trained."""
    model = models.fit_model(models.LOGISTIC, parts(spark, sf)[0], ID)
    texts = table(spark, sf, "documents").select(F.col("doc_id").alias("text_id"), "text")
    out = predict_batch(model, "Logistic_Regression", texts)
    human, ai = F.col("human_probability"), F.col("ai_probability")
    fine = (
        (F.abs(human + ai - 1) < 1e-9)
        & (F.col("confidence") == F.greatest(human, ai))
        & (F.col("predicted_label") == F.when(ai > human, "AI").otherwise("Human"))
        & F.col("prediction_time").isNotNull()
    )
    return out.select("text_id", "model_used", "text_length", fine.alias("sound"))


PREDICTIONS = """CASE WHEN p > 0.5 THEN 'AI' ELSE 'Human' END AS predicted_label, round(greatest(p, 1 - p), 6) AS confidence,
    round(1 - p, 6) AS human_probability, round(p, 6) AS ai_probability, 'Naive_Bayes' AS model_used,
    length(clean_text) AS text_length"""
PREDICTED_SQL = f"WITH {PREPARED}, {bayes_sql(IN_TRAIN, ASKED)} SELECT doc_id AS text_id, {PREDICTIONS} FROM scored"


def rounded_predictions(out):
    digits = ("confidence", "human_probability", "ai_probability")
    return out.drop("prediction_time").withColumns({c: F.round(c, 6) for c in digits})


@query("predict_best", PREDICTED_SQL)
def _predict_best(spark, sf):
    """The best saved model (of the one that has a closed form) over every document."""
    members, test = fitted(spark, sf, (models.NAIVE_BAYES,))
    folder = scratch_path(spark, "models")
    for name, model in members.items():
        save_model(model, folder, name)
    measured = evaluate.evaluate_best_model(members, test, ID)["measures"].withColumnRenamed("f1_score", "test_f1_score")
    name, best = load_best_model(spark, folder, measured)
    texts = table(spark, sf, "documents").select(F.col("doc_id").alias("text_id"), "text")
    return rounded_predictions(predict_batch(best, name, texts))


@query(
    "prediction_confidence",
    f"""WITH {BAYES} SELECT doc_id, (p > 0.5)::BIGINT AS predicted, round(1 - p, 6) AS human_probability,
    round(p, 6) AS ai_probability, round(greatest(p, 1 - p), 6) AS confidence FROM scored ORDER BY doc_id LIMIT 5""",
)
def _confidence(spark, sf):
    members, test = fitted(spark, sf, (models.NAIVE_BAYES,))
    out = metrics.prediction_confidence(models.score_all_models(members, test, ID), ID, 5)
    return out.withColumns({c: F.round(c, 6) for c in ("human_probability", "ai_probability", "confidence")})


def _placed(rows, value, *keys):
    """Places in descending order of a value, and whether it is a number."""
    from pyspark.sql import Window as W

    over = W.partitionBy(*keys).orderBy(F.desc(value), "term")  # as many rows as the top has
    return rows.select(*keys, F.row_number().over(over).alias("place"), (F.col(value) >= 0).alias("sound"))


@query("top_features_abs", "SELECT unnest(range(1, 21)) AS place, true AS sound")
def _top_abs(spark, sf):
    model = models.fit_model(models.LOGISTIC, parts(spark, sf)[0], ID)
    return _placed(models.top_features_abs(models.linear_weights(model)), "importance")


@query(
    "top_features_signed",
    "SELECT side, place, true AS sound FROM (VALUES ('ai'), ('human')) s(side), (SELECT unnest(range(1, 16)) AS place)",
)
def _top_signed(spark, sf):
    """The strongest terms of either class; with any signal the signs tell the sides apart."""
    model = models.fit_model(models.LOGISTIC, parts(spark, sf)[0], ID)
    top = models.top_features_signed(models.linear_weights(model), 15)
    towards = F.when(F.col("side") == "ai", F.col("weight")).otherwise(-F.col("weight"))
    return _placed(top.withColumn("towards", towards), "towards", "side")
