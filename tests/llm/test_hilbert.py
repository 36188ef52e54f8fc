"""Sharding: the curve's law, the rows law, and files that can be skipped."""

import zlib

import pytest

from quillspark.llm import hilbert
from quillspark.llm.queries import op7_hilbert_sharding


def test_curve_visits_every_cell_step_by_step():
    side = range(1 << hilbert.BITS)
    points = {hilbert.hilbert_index((a, b, c)): (a, b, c) for a in side for b in side for c in side}
    assert sorted(points) == list(range(4096))
    assert all(sum(abs(x - y) for x, y in zip(points[i], points[i + 1])) == 1 for i in range(4095))


def check(rows, docs):
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in rows) == sorted(
        (d[0] or -1, len((d[1] or "").encode()) + 1, zlib.crc32((d[1] or "").encode())) for d in docs
    )
    by_shard = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(8)}
    assert sum(map(len, by_shard.values())) == len(rows)
    sizes = [len(v) for v in by_shard.values()]
    assert max(sizes) - min(sizes) <= 1
    assert all(v == list(range(len(v))) for v in by_shard.values())


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = op7_hilbert_sharding(spark, sf_dir).collect()
    check(rows, docs)
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}


@pytest.mark.parametrize("n", [0, 1, 7, 8, 61])
def test_odd_rows(spark, n):
    texts = [None, "", "é", "a" * 5000, "same", "same"]
    rows = [(i // 2 if i % 5 else None, texts[i % 6], ["en", None, ""][i % 3], f"s{i % 4}" if i % 7 else None, i) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, cell int")
    got = hilbert.shard_rows(docs).collect()
    check(got, rows)
    order = [(r.shard, r.slot, r.cell) for r in got]
    assert [c for *_, c in sorted(order)] == sorted(r.cell for r in got)


def test_written_shards_hold_whole_rows(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    hilbert.write_shards(docs, f"{tmp_path}/shards")
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert sorted(map(tuple, back.select(*docs.columns).collect())) == sorted(map(tuple, docs.collect()))
    langs = back.select("shard", "lang").distinct().groupBy("shard").count().collect()
    assert sum(r["count"] for r in langs) < 8 * 4  # a filter on the language leaves out whole shards


def test_written_shards_keep_rows_without_and_with_shared_ids(spark, tmp_path):
    rows = [(i // 3 if i % 4 else None, f"text {i}", "en", "s", i, 7, "x") for i in range(40)] + [(5, None, None, None, 40, 7, "y")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, at int, shard int, size string")
    hilbert.write_shards(docs, f"{tmp_path}/odd")
    back = spark.read.parquet(f"{tmp_path}/odd")
    names = [c for c in docs.columns if c != "shard"]
    assert sorted(map(repr, back.select(*names).collect())) == sorted(map(repr, docs.select(*names).collect()))
    counts = [r["count"] for r in back.groupBy("shard").count().collect()]
    assert len(counts) == 8 and max(counts) - min(counts) <= 1
