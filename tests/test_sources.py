"""Readers and writers."""

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quillspark.sources import readers, writers

FEED = """<?xml version="1.0" encoding="UTF-8"?>
<feed xmlns="http://www.w3.org/2005/Atom">
  <title>list</title>
  <entry><id>http://x.org/abs/cond-mat/9312101v1</id><title> One </title><summary>
     Text one </summary><published>2024</published>
    <author><name> A B </name></author><author><name>C</name></author>
    <category term="x"/><category term="y"/></entry>
  <entry><id>http://x.org/abs/2</id><title>Two</title><published>2024</published></entry>
</feed>
"""


def test_feed(spark, tmp_path):
    (tmp_path / "f.xml").write_text(FEED)
    got = readers.parse_feed_xml(spark, str(tmp_path)).collect()
    assert len(got) == 1
    assert got[0].asDict() == {
        "arxiv_id": "cond-mat/9312101v1", "title": "One", "abstract": "Text one",
        "authors": ["A B", "C"], "categories": ["x", "y"], "published": "2024", "source": "arxiv",
    }
    assert readers.parse_feed_xml(spark, str(tmp_path), keep_archive=False).first()["arxiv_id"] == "9312101v1"


def test_strict_and_tolerant_jsonl(spark, tmp_path):
    path = tmp_path / "c.jsonl"
    path.write_text('{"text": "a", "id": "1"}\n{broken\n\n{"text": "b", "metadata": {"arxiv_id": "2"}}\n')
    with pytest.raises((PySparkException, Py4JJavaError)):
        readers.read_corpus_jsonl(spark, str(path), "human").collect()
    with pytest.raises(PySparkException):
        readers.read_corpus_jsonl(spark, str(tmp_path / "missing"), "human").collect()
    good, rejected = readers.read_jsonl_tolerant(spark, str(path))
    assert sorted(r["text"] for r in good.collect()) == ["a", "b"]
    assert [r["line"] for r in rejected.collect()] == ["{broken"]
    (tmp_path / "ok.jsonl").write_text('{"text": "a", "id": "1"}\n{"text": "b", "metadata": {"arxiv_id": "2"}}\n')
    ids = readers.read_corpus_jsonl(spark, str(tmp_path / "ok.jsonl"), "human")
    assert sorted(r["id"] for r in ids.collect()) == ["1", "2"]


def test_lines_are_numbered_densely_across_files_and_splits(spark, tmp_path):
    expected = []
    for name in ("a.txt", "b.txt"):
        lines = [f"{name} line {i} " + "x" * 50 if i % 3 else "  " for i in range(500)]
        (tmp_path / name).write_text("\n".join(lines))
        expected += [x.strip() for x in lines if x.strip()]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = readers.read_text_lines(spark, str(tmp_path)).orderBy("text_id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r["text_id"] for r in got] == list(range(len(expected)))
    assert [r["text"] for r in got] == expected


def test_whole_text_and_ids(spark, tmp_path):
    (tmp_path / "one.txt").write_text("a\nb\n")
    assert readers.read_whole_text(spark, str(tmp_path)).first()["text"] == "a\nb\n"
    assert sorted(r["id"] for r in readers.read_processed_ids(spark, str(tmp_path)).collect()) == ["a", "b"]


def test_splits_round_trip_keeps_quotes_and_commas(spark, tmp_path):
    df = spark.createDataFrame(
        [("train", 'say, (x); -- y', "ai", "s", 14, 4), ("test", "plain", "human", "s", 5, 1)],
        "split string, clean_text string, label string, source string, text_length int, word_count int",
    )
    writers.write_splits(df, str(tmp_path / "out"))
    back = readers.read_processed_splits(spark, str(tmp_path / "out" / "json"))
    assert sorted((r["split"], r["text"]) for r in back.collect()) == [
        ("test", "plain"), ("train", "say, (x); -- y"),
    ]


def test_metrics_are_rounded(spark, tmp_path):
    writers.write_metrics(spark.createDataFrame([("m", 0.123456)], "model string, f1 double"), str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m" / "json")).first()["f1"] == 0.1235
    writers.append_records(spark.range(2).select(F.col("id")), str(tmp_path / "a"))
    writers.append_records(spark.range(3).select(F.col("id")), str(tmp_path / "a"))
    assert spark.read.json(str(tmp_path / "a")).count() == 5
