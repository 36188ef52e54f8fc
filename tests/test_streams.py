"""Streams equal batch over replays, new checkpoints on old targets, and rows that come late."""

import json
import os

import pytest
from quillspark.streaming import jobs


def feed(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).parquet(folder)


def test_new_checkpoint_keeps_what_is_stored(spark, tmp_path):
    target = str(tmp_path / "target")

    def ingest(rows, state):
        stream = feed(spark, str(tmp_path / f"in-{state}"), rows, "id long, text string")
        return sorted(map(tuple, jobs.stream_ingest_dedupe(stream, target, str(tmp_path / state), "id", ["text"]).collect()))

    assert ingest([(1, "a"), (2, "b"), (2, "c")], "first") == [(1, "a"), (2, "b")]
    assert ingest([(2, "new"), (3, "d")], "second") == [(1, "a"), (2, "b"), (3, "d")]
    assert ingest([(4, "e"), (1, "x")], "first") == [(1, "a"), (2, "b"), (3, "d"), (4, "e")]


def test_replayed_batch_replaces_itself(spark, tmp_path):
    target, state, folder = (str(tmp_path / n) for n in ("target", "state", "in"))
    run = lambda rows: sorted(
        map(tuple, jobs.stream_ingest_dedupe(feed(spark, folder, rows, "id long, n long"), target, state, "id", ["n"]).collect())
    )
    run([(1, 1), (2, 1)])
    want = run([(2, 2), (3, 2)])
    os.remove(f"{state}/commits/1")  # as if the last batch had been written, but not committed
    if os.path.exists(f"{state}/commits/.1.crc"):
        os.remove(f"{state}/commits/.1.crc")
    assert run([(4, 3)]) == sorted([*want, (4, 3)])


def test_late_rows_are_counted(spark, tmp_path):
    target, state, folder = (str(tmp_path / n) for n in ("target", "state", "in"))

    def count(times):
        stream = feed(spark, folder, [(t, "p") for t in times], "ts string, provider string")
        out = jobs.stream_rate_window(stream, target, state, "ts", "provider", {"p": 1})
        return {str(r.window_start): (r.requests, r.over_limit) for r in out.collect()}

    day = "2024-01-01"
    count([f"{day} 00:00:05", f"{day} 02:00:05", f"{day} 03:00:05"])
    late = count([f"{day} 00:00:20", None])
    assert late[f"{day} 00:00:00"] == (2, True) and late[f"{day} 02:00:00"] == (1, False) and len(late) == 3


def test_late_judgements_change_the_drift_report(spark, tmp_path):
    target, state, folder = (str(tmp_path / n) for n in ("target", "state", "in"))

    def report(rows):
        stream = feed(spark, folder, rows, "ts string, label int, predicted int")
        return {str(r.window_start): r.accuracy for r in jobs.stream_drift_monitor(stream, target, state, "ts").collect()}

    report([("2024-01-01 01:00:00", 1, 1), ("2024-02-01 01:00:00", 0, 0)])
    got = report([("2024-01-01 02:00:00", 1, 0)])
    assert got["2024-01-01 00:00:00"] == 0.5 and got["2024-02-01 00:00:00"] == 1.0


def test_a_damaged_target_is_not_an_empty_one(spark, tmp_path):
    target, state, folder = (str(tmp_path / n) for n in ("target", "state", "in"))
    jobs.stream_ingest_dedupe(feed(spark, folder, [(1, 1)], "id long, n long"), target, state, "id", ["n"])
    (tmp_path / "target" / "manifests" / f"{1:012d}.json").write_text("not json")
    (tmp_path / "target" / "manifests" / f".{1:012d}.json.crc").unlink(missing_ok=True)
    with pytest.raises(Exception):  # noqa: B017 - the kind depends on the damage
        jobs.stream_ingest_dedupe(feed(spark, folder, [(2, 1)], "id long, n long"), target, state, "id", ["n"])


def test_reading_does_not_grow_with_batches(spark, tmp_path):
    target, state, folder = (str(tmp_path / n) for n in ("target", "state", "in"))
    for i in range(10):
        out = jobs.stream_ingest_dedupe(feed(spark, folder, [(i, 1), (i + 1, 1)], "id long, n long"), target, state, "id", ["n"], 2)
    assert sorted(r.id for r in out.collect()) == list(range(11))
    assert len(json.loads((tmp_path / "target" / "manifests" / f"{max_version(tmp_path):012d}.json").read_text())["entries"]) <= 8


def max_version(tmp_path):
    return max(int(p.name.removesuffix(".json")) for p in (tmp_path / "target" / "manifests").glob("*.json"))
