"""Solvers sum over few parts, and folds are fitted side by side."""

import threading

from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from quillspark.plans import evaluate, models


def test_parts_of_a_sum(spark):
    rows = spark.range(12_000).select(F.col("id"), F.lit(0.0).alias("label")).repartition(30)
    dealt = models.dealt_for_sums(rows, "id", 12_000)
    assert dealt.rdd.getNumPartitions() == 3 and dealt.count() == 12_000
    assert models.dealt_for_sums(rows, "id", 10**9).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_a_logistic_fit_runs_on_these_parts(spark, monkeypatch):
    seen = []
    found = models.dealt_for_sums
    monkeypatch.setattr(models, "dealt_for_sums", lambda *a: seen.append(found(*a)) or seen[-1])
    rows = spark.createDataFrame([(i, float(i % 2), Vectors.dense([i % 2, 1.0])) for i in range(40)], ["id", "label", "features"])
    model = models.fit_logistic(rows.repartition(8), 2, "id")[0]
    assert seen[0].rdd.getNumPartitions() == 1
    assert model.transform(rows).filter("prediction <> label").count() == 0


def test_folds_meet(spark, monkeypatch):
    together, fit = threading.Barrier(5), evaluate.fit_models

    def waiting(*args, **options):
        together.wait(120)  # broken, unless all folds are at it
        return fit(*args, **options)

    monkeypatch.setattr(evaluate, "fit_models", waiting)
    texts = [(i, "ai" if i % 2 else "human", ("robot metal " if i % 2 else "river forest ") * 3 + f"word{i % 7}") for i in range(40)]
    train = spark.createDataFrame(texts, "id long, label string, clean_text string")
    rows = evaluate.out_of_fold((models.NAIVE_BAYES,), train).collect()
    assert sorted(r.id for r in rows) == list(range(40)) and all(r.label == r.predicted for r in rows)


def test_a_grid_judges_held_out_rows_in_one_pass(spark, monkeypatch):
    seen, found = [], evaluate.transformed
    monkeypatch.setattr(evaluate, "transformed", lambda *a: seen.append(1) or found(*a))
    texts = [(i, "ai" if i % 2 else "human", ("robot metal " if i % 3 else "river forest ") * 3 + f"word{i % 7}") for i in range(40)]
    train = spark.createDataFrame(texts, "id long, label string, clean_text string")
    grid = {name: evaluate.LOGISTIC_GRID[name] for name in ("C=0.01", "C=1.0", "C=10.0")}
    together = {r.candidate: r.mean_f1 for r in evaluate.grid_search(train, grid=grid, folds=2).collect()}
    assert len(seen) == 4  # vectors of the fitted and of the held-out rows, a fold
    alone = [evaluate.grid_search(train, grid={name: grid[name]}, folds=2).collect()[0] for name in grid]
    assert together == {r.candidate: r.mean_f1 for r in alone}


def test_folds_of_many_rows_are_fitted_one_by_one():
    assert evaluate.folds_at_once(5, 1_000) == 5 and evaluate.folds_at_once(3, 0) == 3
    assert evaluate.folds_at_once(5, 100_000) == 3 and evaluate.folds_at_once(5, 10**7) == 1


def test_a_stored_table_leaves_no_shuffle_files(spark):
    import time

    from quillspark import session

    def shuffles():
        manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return sum(name.startswith("shuffle_") for name in [f.getName() for f in _listed(manager)])

    def _listed(manager):
        found = manager.getAllFiles()
        return [found.apply(i) for i in range(found.size())]

    before = shuffles()
    found = session.stored(spark.range(10_000, numPartitions=4).groupBy((F.col("id") % 10).alias("k")).agg(F.collect_list("id").alias("x")), "x")
    for _ in range(50):
        if shuffles() <= before:
            break
        time.sleep(0.1)
    assert shuffles() <= before and found.count() == 10
    session.drop_stored(found)
    assert spark.conf.get(session.DROP_SHUFFLES) == "false"
    with session.shuffles_dropped(spark), session.shuffles_dropped(spark):
        assert spark.conf.get(session.DROP_SHUFFLES) == "true"
    assert spark.conf.get(session.DROP_SHUFFLES) == "false"


def test_a_machine_keeps_no_second_copy_of_the_vectors(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    kept, persist = [], DataFrame.persist
    monkeypatch.setattr(DataFrame, "persist", lambda self, *a: kept.append(self.columns) or persist(self, *a))
    rows = spark.createDataFrame([(i, float(i % 2), Vectors.dense([i % 2, 1.0 + i % 3])) for i in range(60)], ["id", "label", "features"])
    models.fit_svm(rows, 2, "id", num_features=4)
    assert kept == [["id", "label", "split", "mapped"]]
