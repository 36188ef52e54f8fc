"""State stores: equal to the batch over restarts, late rows on the side, ids known for good or for a while."""

from datetime import datetime, timedelta

from quillspark.streaming import stateful

DAY = datetime(2024, 1, 1)


def feed(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).parquet(folder)


def test_windows_and_late_rows_over_restarts(spark, tmp_path):
    target, state, folder = (str(tmp_path / n) for n in ("target", "state", "in"))

    def run(*seconds):
        rows = [(None if s is None else DAY + timedelta(seconds=s), p) for s, p in seconds]
        stream = feed(spark, folder, rows, "ts timestamp, provider string")
        report, late = stateful.stream_rate_window(stream, target, state, "ts", "provider", {"p": 1}, "2 minutes")
        plain = lambda frame: {(int((r.window_start - DAY).total_seconds()), r.provider): r.requests for r in frame.collect()}
        return plain(report), plain(late)

    assert run((5, "p"), (10, "q"), (None, "p")) == ({(0, "p"): 1, (0, "q"): 1}, {})
    assert run((20, "p"), (400, "p"), (30, None)) == ({(0, "p"): 2, (0, "q"): 1, (0, None): 1, (360, "p"): 1}, {})
    # the watermark is at 280 seconds: the first minutes are closed, the fifth (240 to 300) is not
    report, late = run((40, "p"), (50, "p"), (250, "q"), (410, "p"))
    assert late == {(0, "p"): 2}
    assert report == {(0, "p"): 4, (0, "q"): 1, (0, None): 1, (240, "q"): 1, (360, "p"): 2}
    report, late = run((55, "p"))
    assert late == {(0, "p"): 3} and report[0, "p"] == 5


def test_closed_windows_leave_the_state(spark, tmp_path):
    target, state, folder = (str(tmp_path / n) for n in ("target", "state", "in"))
    for minutes in ([0, 1, 2, 3], [60], [61]):
        stream = feed(spark, folder, [(DAY + timedelta(minutes=m), "p") for m in minutes], "ts timestamp, provider string")
        stateful.stream_rate_window(stream, target, state, "ts", "provider", {"p": 1}, "1 minute")
    kept = spark.read.format("statestore").option("stateVarName", "count").load(state)
    assert kept.count() == 2


def test_unique_ids_over_restarts_and_replays(spark, tmp_path):
    target, state, folder = (str(tmp_path / n) for n in ("target", "state", "in"))

    def run(*rows):
        stream = feed(spark, folder, rows, "id long, part long")
        return sorted(map(tuple, stateful.stream_ingest_unique(stream, target, state, "id").collect()))

    assert run((1, 0), (2, 0), (2, 0)) == [(1, 0), (2, 0)]
    assert run((2, 1), (3, 1)) == [(1, 0), (2, 0), (3, 1)]
    for name in ("1", ".1.crc"):  # as if the last batch had been written, but not committed
        (tmp_path / "state" / "commits" / name).unlink(missing_ok=True)
    assert run((3, 2), (4, 2)) == [(1, 0), (2, 0), (3, 1), (4, 2)]


def test_recent_ids(spark, tmp_path):
    target, state, folder = (str(tmp_path / n) for n in ("target", "state", "in"))

    def run(*rows):
        stream = feed(spark, folder, [(i, DAY + timedelta(hours=h)) for i, h in rows], "id long, ts timestamp")
        out = stateful.stream_ingest_recent(stream, target, state, "id", "ts", "1 hour")
        return sorted((r.id, (r.ts - DAY).total_seconds() / 3600) for r in out.collect())

    assert run((1, 0), (1, 0), (2, 0.5)) == [(1, 0), (2, 0.5)]
    assert run((1, 0.9), (3, 5)) == [(1, 0), (2, 0.5), (3, 5)]
    assert run((1, 6)) == [(1, 0), (1, 6), (2, 0.5), (3, 5)]  # the first one has left the state


def test_a_state_list_holds_the_windows_of_a_day(spark, tmp_path):
    """One key a provider and day, so calls do not grow with windows; more than a hundred in one call, over two appends."""
    target, state, folder = (str(tmp_path / n) for n in ("target", "state", "in"))
    for _ in range(2):
        rows = [(DAY + timedelta(minutes=m), p) for m in range(300) for p in ("p", None)]
        stream = feed(spark, folder, rows, "ts timestamp, provider string")
        report, late = stateful.stream_rate_window(stream, target, state, "ts", "provider", {"p": 1}, "2 days")
    assert {r.requests for r in report.collect()} == {2} and report.count() == 600 and late.count() == 0
    kept = spark.read.format("statestore").option("stateVarName", "count").load(state)
    assert kept.count() == 600 and kept.select("key").distinct().count() == 2
