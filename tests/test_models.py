"""Fitted pipelines: equality with the table form, invariants, persistence, streaming."""

import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quillspark.operators import vocabulary
from quillspark.plans import evaluate, features, models
from quillspark.plans.predict import predict_batch
from quillspark.sources.models import load_best_model, load_model, save_model
from quillspark.streaming import jobs

HUMAN = ["careful", "measured", "lattice", "quantum", "evidence"]
AI = ["delve", "tapestry", "crucial", "landscape", "vibrant"]


@pytest.fixture(scope="module")
def texts(spark):
    """Two kinds of text with mostly separate words."""
    rows = []
    for i in range(120):
        ai = i % 2
        own, other = (AI, HUMAN) if ai else (HUMAN, AI)
        words = [own[(i + k) % 5] for k in range(6)] + [other[i % 5]] * (i % 3 == 0) + ["common", f"w{i % 9}"]
        rows.append((i, " ".join(words), "ai" if ai else "human"))
    return spark.createDataFrame(rows, "id int, clean_text string, label string").cache()


@pytest.mark.parametrize("scale", [False, True])
def test_ml_features_equal_the_long_table(texts, scale):
    model = features.fit_features(texts, max_features=40, min_df=2, max_df=0.95, scale=scale)
    names = features.feature_names(model)
    values = F.posexplode(vector_to_array("features")).alias("i", "w")
    ml = {
        (r["id"], names[r["i"]]): r["w"]
        for r in model.transform(texts).select("id", values).collect() if r["w"]
    }
    n = texts.count()
    terms = vocabulary.document_terms(texts, "id", "clean_text")
    vocab = vocabulary.vocabulary(vocabulary.term_doc_freq(terms), n, 40, 2, 0.95)
    long = features.tfidf_table(texts, "id", "clean_text", vocab, n)
    if scale:
        long = vocabulary.scale_sparse(long, vocabulary.fit_scale(long, n)).withColumn("weight", F.col("scaled"))
    table = {(r["id"], r["term"]): r["weight"] for r in long.collect()}
    assert ml.keys() == table.keys()
    assert max(abs(ml[k] - table[k]) for k in ml) < 1e-9


@pytest.mark.parametrize(
    "spec, options",
    [
        (models.LOGISTIC, {}), (models.NAIVE_BAYES, {}), (models.RANDOM_FOREST, {"trees": 20, "depth": 5}),
        (models.SVM, {}), (models.SVM, {"kernel": "linear"}), (models.SVM, {"feature_map": "cosines"}), (models.MLP, {"max_iter": 40}),
    ],
)
def test_every_model_separates_and_gives_probabilities(texts, spec, options):
    train, test = texts.filter("id < 90"), texts.filter("id >= 90")
    model = models.fit_model(spec, train, "id", **options)
    scored = models.score(model, test, spec.name, "id").collect()
    assert len(scored) == 30 and all(0 <= r["score"] <= 1 for r in scored)
    assert sum(r["label"] == r["predicted"] for r in scored) >= 27
    again = models.score(models.fit_model(spec, train, "id", **options), test, spec.name, "id").collect()
    assert {r["id"]: round(r["score"], 9) for r in scored} == {r["id"]: round(r["score"], 9) for r in again}


def test_random_fourier_features_approximate_the_kernel(spark):
    import numpy as np
    from pyspark.ml.linalg import Vectors

    from quillspark.plans.fourier import RandomFourierFeatures

    rng = np.random.default_rng(1)
    points = rng.uniform(size=(6, 8))
    df = spark.createDataFrame(
        [(i, Vectors.sparse(8, range(8), list(p)) if i % 2 else Vectors.dense(p)) for i, p in enumerate(points)],
        ["i", "features"],
    )
    mapper = RandomFourierFeatures(
        inputCol="features", outputCol="z", gamma=0.5, inputSize=8, numFeatures=4000, seed=3
    )
    z = {r["i"]: np.array(r["a"]) for r in mapper.transform(df).select("i", vector_to_array("z").alias("a")).collect()}
    for a in range(6):
        for b in range(6):
            kernel = math.exp(-0.5 * ((points[a] - points[b]) ** 2).sum())
            assert z[a] @ z[b] == pytest.approx(kernel, abs=0.06)


def test_cross_validation_and_records(texts):
    folds = evaluate.cross_validate(models.NAIVE_BAYES, texts, "id", 3)
    assert sorted(r["fold"] for r in folds.collect()) == [0, 1, 2]
    row = evaluate.fit_eval_record(
        models.NAIVE_BAYES, texts.filter("id < 90"), texts.filter("id >= 90"), "id", 0, folds=2
    ).first()
    assert row["auc"] > 0.95 and row["accuracy"] > 0.9 and 0 <= row["cv_std"] <= 0.5
    assert sum(map(sum, row["confusion_matrix"])) == 30


def test_grid_search_ranks_every_candidate(texts):
    grid = {**evaluate.LOGISTIC_GRID, "small forest": evaluate._forest(5, 3)}
    got = {r["candidate"]: r["mean_f1"] for r in evaluate.grid_search(texts, "id", grid, 2, 50).collect()}
    assert set(got) == set(grid) and got["C=1.0"] > 0.9
    assert len(evaluate.FOREST_GRID) == 9


def test_top_features_point_the_right_way(texts):
    model = models.fit_model(models.LOGISTIC, texts, "id")
    signed = models.top_features_signed(models.linear_weights(model), 3).collect()
    for r in signed:
        own = AI if r["side"] == "ai" else HUMAN
        assert any(w in own for w in r["term"].split())
    assert models.top_features_abs(models.linear_weights(model), 4).count() == 4


def test_saved_models_load_and_fall_back(spark, texts, tmp_path):
    svm = models.fit_model(models.SVM, texts, "id")
    save_model(svm, str(tmp_path), "SVM")
    table = spark.createDataFrame([("Naive_Bayes", 0.9), ("SVM", 0.8)], "model string, test_f1_score double")
    name, loaded = load_best_model(spark, str(tmp_path), table)
    assert name == "SVM"
    before = models.score(svm, texts, "SVM", "id").collect()
    after = models.score(loaded, texts, "SVM", "id").collect()
    assert [round(r["score"], 12) for r in before] == [round(r["score"], 12) for r in after]
    with pytest.raises(FileNotFoundError):
        load_best_model(spark, str(tmp_path / "none"))
    assert load_model(str(tmp_path), "SVM").stages


@pytest.mark.parametrize("spec", [models.LOGISTIC, models.NAIVE_BAYES, models.SVM])
def test_balanced_weights_find_more_of_a_small_class(spark, spec):
    rows = [(i, "alpha beta shared" if i % 3 else "gamma shared", "human") for i in range(90)]
    rows += [(100 + i, "gamma shared" if i % 2 else "delta shared", "ai") for i in range(10)]
    data = spark.createDataFrame(rows, "id int, clean_text string, label string").cache()
    found = {
        balanced: models.score(models.fit_model(spec, data, "id", balanced=balanced), data, spec.name)
        .filter("label = 1").agg(F.avg("score")).first()[0]
        for balanced in (False, True)
    }
    assert found[True] >= found[False]


def test_stream_score_equals_batch(spark, texts, tmp_path):
    model = models.fit_model(models.NAIVE_BAYES, texts, "id")
    raw = texts.select(F.col("id").alias("text_id"), F.col("clean_text").alias("text"))
    raw = raw.unionByName(spark.createDataFrame([(999, "short"), (1000, None)], raw.schema))
    raw.repartition(3).write.parquet(str(tmp_path / "in"))
    batch = predict_batch(model, "Naive_Bayes", raw).drop("prediction_time")
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = jobs.stream_score(stream, model, "Naive_Bayes", str(tmp_path / "out"), str(tmp_path / "state"))
    key = lambda r: r["text_id"]
    assert sorted(out.drop("prediction_time").collect(), key=key) == sorted(batch.collect(), key=key)
    assert batch.count() == 120
    one = batch.first()
    assert one["human_probability"] + one["ai_probability"] == pytest.approx(1)
    assert one["confidence"] == max(one["human_probability"], one["ai_probability"])


def test_stream_ingest_resumes_where_it_stopped(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "id string, n int"

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(source)
        return sorted(map(tuple, jobs.stream_ingest_dedupe(stream, target, state, "id", ["n"]).collect()))

    spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], schema).coalesce(1).write.json(source)
    assert run() == [("a", 1), ("b", 3)]
    spark.createDataFrame([("b", 0), ("c", 5)], schema).coalesce(1).write.mode("append").json(source)
    assert run() == [("a", 1), ("b", 3), ("c", 5)]
    assert run() == [("a", 1), ("b", 3), ("c", 5)]


def test_the_whole_grid_is_searched(texts):
    """Every C of the logistic model and the machine, both kernels and widths, every size, depth and smallest split of the forest."""
    found = {r["candidate"]: r["mean_f1"] for r in evaluate.grid_search(texts, "id", folds=2, max_features=50).collect()}
    assert set(found) == set(evaluate.GRID) and len(found) == 4 + 3 + 6 + 27
    assert {f"trees=500 depth=none", "svm rbf C=0.1 gamma=auto", "svm linear C=10.0", "trees=100 depth=10 split=10"} <= set(found)
    assert all(0 <= v <= 1 for v in found.values()) and min(found["svm linear C=1.0"], found["svm rbf C=10.0 gamma=scale"], found["trees=500 depth=none"]) > 0.9


def test_a_forest_of_the_grid_is_the_forest_fitted_alone(texts):
    grid = {f"{t} {d} {m}": evaluate._forest(t, d, m) for t in (3, 8) for d in (2, None) for m in (2, 30)}
    together = {r["candidate"]: r["mean_f1"] for r in evaluate.grid_search(texts, "id", grid, 2, 50).collect()}
    for name in ("3 2 2", "8 None 30"):
        assert evaluate.grid_search(texts, "id", {name: grid[name]}, 2, 50).collect()[0]["mean_f1"] == together[name]
