"""Keyed permutations: bijections of any size, the same by row and in a table, files of equal size."""

from math import isqrt

import pytest
from pyspark.sql import functions as F

from quillspark.operators import permute


@pytest.mark.parametrize("n", [1, 2, 3, 7, 16, 97, 1000, 4099])
@pytest.mark.parametrize("seed", [1, 42])
def test_every_place_is_taken_once(n, seed):
    a, b = permute.sides(n)
    assert a * b >= n
    assert sorted(permute.place_of(v, n, seed) for v in range(n)) == list(range(n))


def test_sides_of_large_tables_leave_little_over():
    for n in (10**9 + 7, 10**12 + 39, 10**14 + 31):
        a, b = permute.sides(n)
        assert 0 <= a * b - n <= 8 * isqrt(a) and a < 2**31 and b < 2**31
        places = {permute.place_of(v, n) for v in range(50)}
        assert len(places) == 50 and max(places) < n


def test_neighbours_part():
    n = 5000
    places = [permute.place_of(v, n) for v in range(n)]
    near = sum(abs(p - q) < n // 10 for p, q in zip(places, places[1:])) / n
    assert 0.15 < near < 0.23  # 0.19 by chance
    assert abs(sum(p < n // 2 for p in places[: n // 2]) - n // 4) < n // 20


@pytest.mark.parametrize("n", [0, 1, 97, 1009])
def test_table_equals_rule(spark, n):
    ids = spark.range(n).withColumn("id", F.col("id") * 3 - 5).repartition(7)
    got = {r.id: r.place for r in permute.shuffle_places(ids, ["id"]).collect()}
    assert got == {v * 3 - 5: permute.place_of(v, n) for v in range(n)}


def test_numbers_of_stored_rows_are_dense(spark):
    rows = spark.createDataFrame([(None, "x")] * 40 + [(1, "x"), (1, None)], "id long, text string").repartition(5)
    numbered, n = permute.numbered(rows)
    assert n == 42 and sorted(r.number for r in numbered.collect()) == list(range(42))
    assert permute.numbered(rows.limit(0))[1] == 0


def test_files_hold_equal_runs_of_places(spark, tmp_path):
    path = f"{tmp_path}/shuffled"
    permute.write_shuffled(spark.range(103), path, files=4)
    back = spark.read.parquet(path).withColumn("file", F.input_file_name())
    runs = back.groupBy("file").agg(F.min("place").alias("a"), F.max("place").alias("b"), F.count("*").alias("n")).collect()
    assert sorted(r.n for r in runs) == [25, 26, 26, 26] and all(r.b - r.a + 1 == r.n for r in runs)
    assert sorted(r.id for r in back.collect()) == list(range(103))
