"""Joins, splits, running totals and metrics against brute force."""

from collections import Counter

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.functions.hashing import order_key
from quillspark.operators import bayes, comparison, corpus, joins, metrics, profile, running, splits, usage, vocabulary
from quillspark.plans import prepare


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_first_row_wins_and_human_comes_first(spark):
    human = spark.createDataFrame([(5, "x" * 60), (2, "y" * 60)], "id int, text string")
    ai = spark.createDataFrame([(1, "x" * 60), (3, "z" * 60)], "id int, text string")
    both = corpus.union_corpora(
        human.withColumn("label", F.lit("human")), ai.withColumn("label", F.lit("ai"))
    )
    kept = corpus.dedupe_keep_first(corpus.with_clean_text(both), ["corpus_rank", "id"])
    assert rows(kept.select("id", "label")) == [(2, "human"), (3, "ai"), (5, "human")]


def test_dedupe_with_empty_null_and_shared_ids(spark):
    human = [("h1", "copied by a row without id"), ("h2", "only here"), (None, "null and null"), (None, "null and null")]
    ai = [(None, "copied by a row without id"), (None, "own text one"), (None, "own text two")]
    ai += [("h2", "first generation"), ("h2", "second generation"), ("h2", "first generation"), ("h2", "only here")]
    long = F.concat("text", F.lit(" and" * 20)).alias("text")  # inside of the length band
    human = spark.createDataFrame(human, "id string, text string").select("id", long).repartition(3)
    ai = spark.createDataFrame(ai, "original_id string, text string").select("original_id", long).repartition(3)
    both = corpus.union_corpora(corpus.normalise_rows(human, "human"), corpus.normalise_rows(ai, "ai"))
    want = [
        ("ai", "", "own text one"), ("ai", "", "own text two"), ("ai", "h2", "first generation"),
        ("ai", "h2", "second generation"), ("human", "", "null and null"),
        ("human", "h1", "copied by a row without id"), ("human", "h2", "only here"),
    ]
    short = F.regexp_replace("clean_text", "( and)+$", "")
    assert rows(prepare.clean_corpus(both).select("label", "id", short)) == want
    assert rows(prepare.prepare_corpus(both).select("label", "id", short)) == want
    null_ids = both.withColumn("id", F.when(F.col("id") != "", F.col("id")))
    assert rows(prepare.clean_corpus(null_ids).select("label", short)) == sorted((a, c) for a, _, c in want)
    odd = spark.createDataFrame([(1, None), (1, None), (2, "t")], "_row int, clean_text string")
    assert rows(corpus.dedupe_keep_first(odd, ["_row"])) == [(1, None), (2, "t")]


def test_normalise_rows_defaults(spark):
    human = spark.createDataFrame(
        [(None, None, ("p1",)), ("t", "feed", ("p2",))],
        "text string, source string, metadata struct<arxiv_id string>",
    )
    assert rows(corpus.normalise_rows(human, "human")) == [
        ("", "human", "arxiv", "p1"), ("t", "human", "feed", "p2"),
    ]
    ai = spark.createDataFrame([("t", "m-1", "p1")], "text string, source_llm string, original_id string")
    assert rows(corpus.normalise_rows(ai, "ai")) == [("t", "ai", "m-1", "p1")]


def test_hot_key_join_equals_plain_join(spark):
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("v")
    )
    lookup = spark.range(60).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    hot = joins.hot_key_join(facts, lookup, ["k"], share=0.1, floor=10)
    assert "Union" in hot._jdf.queryExecution().toString()
    assert rows(hot.select("k", "v", "w")) == rows(facts.join(lookup, "k").select("k", "v", "w"))


def test_antijoin_keeps_first_seen(spark):
    incoming = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3), ("c", 4)], "id string, n int")
    stored = spark.createDataFrame([("b",)], "id string")
    assert rows(corpus.antijoin_new_ids(incoming, stored, "id", ["n"])) == [("a", 1), ("c", 4)]


@pytest.mark.parametrize("sizes", [{"human": 97, "ai": 31}, {"human": 1, "ai": 3}, {"human": 5, "ai": 7}])
@pytest.mark.parametrize("digits", [1, 4])
def test_split_equals_full_sort(spark, sizes, digits):
    data = [(f"{label}{i}", label) for label, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(data, "id string, label string")
    w = W.partitionBy("label")
    ranked = df.withColumn(
        "rk", F.row_number().over(w.orderBy(order_key(42, F.col("id")), "id"))
    ).withColumn("n", F.count(F.lit(1)).over(w))
    t = F.round(F.col("n") * 0.2)
    brute = ranked.select(
        "id", F.when(F.col("rk") <= t, "test").when(F.col("rk") <= 2 * t, "val").otherwise("train")
    )
    mine = splits.stratified_split(df, "id", ["label"], digits=digits).select("id", "split")
    assert rows(mine) == rows(brute)


def test_folds_cover_every_row_evenly(spark):
    df = spark.range(103).withColumn("label", F.when(F.col("id") < 23, "ai").otherwise("human"))
    folded = splits.stratified_kfold(df, "id", ["label"])
    for label, total in (("ai", 23), ("human", 80)):
        sizes = Counter(r["fold"] for r in folded.filter(F.col("label") == label).collect())
        assert sum(sizes.values()) == total and max(sizes.values()) - min(sizes.values()) <= 1
        assert set(sizes) == {0, 1, 2, 3, 4}


def test_split_with_null_stratum(spark):
    df = spark.range(40).withColumn("label", F.when(F.col("id") < 20, "ai"))
    out = splits.stratified_holdout(df, "id", ["label"])
    assert out.count() == 40
    assert rows(out.filter(F.col("split") == "test").groupBy("label").count()) == [("ai", 4), (None, 4)]


def test_balanced_and_quota_samples(spark):
    df = spark.range(100).withColumn("label", F.when(F.col("id") < 13, "ai").otherwise("human"))
    assert rows(splits.balanced_sample(df, "id", "label", 50).groupBy("label").count()) == [("ai", 13), ("human", 13)]
    assert rows(splits.balanced_sample(df, "id", "label", 5).groupBy("label").count()) == [("ai", 5), ("human", 5)]
    quota = splits.domain_quota_sample(df, "id", "label", {"ai": 0.5, "human": 0.25}, 40)
    assert rows(quota.groupBy("label").count()) == [("ai", 13), ("human", 10)]


def test_provider_shares_are_met_exactly(spark):
    out = splits.assign_provider(spark.range(1000), "id")
    assert rows(out.groupBy("provider").count()) == [("firework", 200), ("groq", 700), ("openrouter", 100)]


def test_running_totals_equal_a_plain_window(spark):
    # one provider and one second hold most rows
    df = spark.range(2000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("ts"),
        F.when(F.col("id") % 5 < 3, "a").otherwise(F.concat(F.lit("p"), (F.col("id") % 4).cast("string"))).alias("p"),
    )
    mine = running.running_usage_share(df, "p", ["ts", "id"])
    w = W.orderBy("ts", "id")
    brute = df.select(
        "id", "ts", "p",
        F.count(F.lit(1)).over(W.partitionBy("p").orderBy("ts", "id")).alias("a"),
        F.count(F.lit(1)).over(w).alias("b"),
    )
    assert rows(mine.select("id", "ts", "p", "provider_requests", "all_requests")) == rows(brute)


def scored(spark, data):
    df = spark.createDataFrame(data, "label int, score double")
    return df.withColumn("model", F.lit("m")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def pair_auc(data):
    pos = [s for y, s in data if y == 1]
    neg = [s for y, s in data if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return round(wins / (len(pos) * len(neg)), 6)


@pytest.mark.parametrize(
    "data",
    [
        [(1, 0.5), (0, 0.5), (1, 0.5)],
        [(1, 0.9), (1, 0.8), (0, 0.2), (0, 0.1)],
        [(i % 2, round((i * 37 % 50) / 50, 2)) for i in range(200)],
    ],
)
def test_auc_equals_pair_counting(spark, data):
    assert metrics.roc_auc(scored(spark, data), ["model"]).first()["auc"] == pair_auc(data)


def test_auc_of_one_class_is_null(spark):
    assert metrics.roc_auc(scored(spark, [(1, 0.3), (1, 0.7)]), ["model"]).first()["auc"] is None


def test_average_precision_and_curves(spark):
    df = scored(spark, [(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1)])
    assert metrics.average_precision(df, ["model"]).first()[1] == pytest.approx((1 + 2 / 3) / 2, abs=1e-6)
    roc = rows(metrics.roc_curve(df, ["model"]).select("threshold", "fpr", "tpr"))
    assert roc == rows(spark.createDataFrame(
        [(0.9, 0.0, 0.5), (0.8, 0.5, 0.5), (0.7, 0.5, 1.0), (0.1, 1.0, 1.0), (None, 0.0, 0.0)],
        "a double, b double, c double",
    ))
    end = metrics.pr_curve(df, ["model"]).filter("threshold is null").first()
    assert (end["precision"], end["recall"]) == (1.0, 0.0)


def test_metrics_follow_the_positive_label(spark):
    df = scored(spark, [(1, 0.9), (1, 0.1), (0, 0.2), (0, 0.3), (0, 0.6)])
    ai = metrics.binary_metrics(df, ["model"], 1).first()
    human = metrics.binary_metrics(df, ["model"], 0).first()
    assert (ai["precision"], ai["recall"]) == (0.5, 0.5)
    assert (human["precision"], human["recall"]) == (0.666667, 0.666667)
    nothing = metrics.binary_metrics(scored(spark, [(1, 0.1)]), ["model"]).first()
    assert nothing["precision"] == nothing["f1_score"] == 0.0


def test_report_rows(spark):
    df = scored(spark, [(1, 0.9), (1, 0.1), (0, 0.2)])
    report = {r["row"]: r for r in metrics.classification_report(df, ["model"]).collect()}
    assert report["human"]["precision"] == 0.5 and report["human"]["support"] == 1
    assert report["accuracy"]["f1_score"] == pytest.approx(2 / 3, abs=1e-6)
    assert report["weighted avg"]["recall"] == pytest.approx(2 / 3, abs=1e-6)
    assert report["macro avg"]["recall"] == 0.75


def test_best_model_and_speed(spark):
    df = spark.createDataFrame(
        [("b", 0.8, 2.0, 0.1), ("a", 0.8, 1.0, 0.3), ("c", None, 4.0, 0.2)],
        "model string, f1_score double, train_time double, cv_std double",
    )
    assert comparison.best_model(df).first()["model"] == "a"
    assert comparison.best_model(df.limit(0)).first()["model"] == "SVM"
    assert tuple(comparison.speed_summary(df).first()) == ("a", "c", 4.0, "b")


def test_histogram_bins(spark):
    df = spark.createDataFrame([("a", 0), ("a", 100), ("a", 50), ("b", 7), ("b", 7)], "label string, text_length long")
    got = {(r["label"], r["bin"]): r["texts"] for r in profile.length_histogram(df).collect()}
    assert got == {("a", 0): 1, ("a", 25): 1, ("a", 49): 1, ("b", 25): 2}


def test_usage_counts_idle_providers(spark):
    df = spark.createDataFrame([("groq",)] * 8 + [("firework",)] * 2, "p string")
    got = {r["provider"]: (r["requests"], r["status"]) for r in usage.provider_usage(df, "p").collect()}
    assert got == {"groq": (8, "over"), "firework": (2, "within"), "openrouter": (0, "near")}


def test_priority_falls_through(spark):
    df = spark.createDataFrame(
        [("2024-01-01 00:00:01", "a")] * 2 + [("2024-01-01 00:01:01", "a")], "ts string, p string"
    ).withColumn("ts", F.to_timestamp("ts"))
    out = usage.provider_by_priority(df, "ts", "p", {"b": (2, 5), "a": (1, 2)})
    assert [r["provider"] for r in out.orderBy("window_start").collect()] == ["b", "a"]


def test_vocabulary_limits_and_ties(spark):
    docs = spark.createDataFrame(
        [(1, "apple banana"), (2, "apple cherry"), (3, "apple banana banana")], "d int, t string"
    )
    freq = vocabulary.term_doc_freq(vocabulary.document_terms(docs, "d", "t", bigrams=False))
    assert rows(freq) == [("apple", 3, 3), ("banana", 3, 2), ("cherry", 1, 1)]
    assert rows(vocabulary.vocabulary(freq, 3, 10, 2, 0.95)) == [("banana", 3, 2)]
    assert rows(vocabulary.vocabulary(freq, 3, 1)) == [("apple", 3, 3)]


def test_bigram_model(spark):
    import math

    docs = spark.createDataFrame([(1, "aa bb aa bb"), (2, "aa cc"), (3, "aa")], "d int, t string")
    got = {r["d"]: r["cross_entropy"] for r in bayes.bigram_lm_score(docs, "d", "t").collect()}
    # words: aa 4, bb 2, cc 1; pairs: aa bb 2, bb aa 1, aa cc 1
    cost = {"ab": -math.log(3 / 7), "ba": -math.log(2 / 5), "ac": -math.log(2 / 7)}
    assert got == {
        1: pytest.approx((2 * cost["ab"] + cost["ba"]) / 3, abs=1e-6), 2: pytest.approx(cost["ac"], abs=1e-6)
    }


@pytest.mark.parametrize("most", [1, 7, 100, 101])
def test_cap_equals_ordered_limit(spark, most):
    df = spark.range(100).select((F.col("id") % 9).alias("a"), F.col("id").alias("b"), F.lit("x").alias("t"))
    mine = corpus.cap_total(df, ["a", "b"], most)
    assert rows(mine) == rows(df.orderBy("a", "b").limit(most))


@pytest.mark.parametrize("size", [1, 2, 5, 50])
def test_vocabulary_equals_plain_top_k(spark, size):
    freq = spark.range(40).select(
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("term"),
        (F.col("id") % 6 + 1).alias("corpus_count"), F.lit(1).cast("bigint").alias("doc_freq"),
    )
    plain = freq.orderBy(F.desc("corpus_count"), "term").limit(size)
    assert rows(vocabulary.vocabulary(freq, 40, size)) == rows(plain)


def test_larger_tables_are_not_broadcast(spark):
    from quillspark.session import broadcast_if_small

    small = broadcast_if_small(spark.range(10), 10)
    large = spark.range(11)
    assert "ResolvedHint" in small._jdf.queryExecution().analyzed().toString()
    assert broadcast_if_small(large, 10) is large
    assert rows(small) == [(i,) for i in range(10)]
