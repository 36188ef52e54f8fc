"""Texts to score are cleaned once each."""

from quillspark import fixed_values as fv
from quillspark.plans import predict


def test_a_text_is_cleaned_once(spark):
    long = "word " * fv.MIN_SCORABLE_CHARS
    texts = spark.createDataFrame([(1, long), (2, "x"), (3, None), (4, "a" * fv.MIN_SCORABLE_CHARS)], "text_id int, text string").repartition(1)
    cleaned = predict.clean_scorable(texts)
    assert sorted(tuple(r) for r in cleaned.collect()) == [(1, long.strip()), (4, "a" * fv.MIN_SCORABLE_CHARS)]
    plan = cleaned._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == plan.split("Generate", 1)[1].split("\n", 1)[0].count("regexp_replace") > 0
