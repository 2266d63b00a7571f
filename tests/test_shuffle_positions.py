"""The shuffle by row positions against a brute-force permutation."""

import pytest
from pyspark.sql import functions as F

from hearth.operators import sampling


@pytest.mark.parametrize("n", [1, 2, 7, 64, 101])
def test_permutation_equals_brute_force(spark, n):
    seed = F.lit(5).cast("long")
    steps = spark.range(15).select(F.col("id").cast("int").alias("k"))
    turn = {r.k: r.h for r in steps.select("k", F.xxhash64(seed, "k").alias("h")).collect()}
    rows = steps.select("k", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n).cast("long"))).alias("v"))
    draw = {(r.k, r.v): r.h for r in rows.select("k", "v", F.xxhash64(seed, "k", "v").alias("h")).collect()}
    a = int(n ** 0.5)
    b = n // a
    want = []
    for x in range(n):
        for k in range(15):
            left, right = divmod(x, b)
            if k % 5 == 4:
                x = (x + turn[k] % n) % n
            elif left < a and k % 5 % 2 == 0:
                x = (left + draw[k, right] % a) % a * b + right
            elif left < a:
                x = left * b + (right + draw[k, left] % b) % b
        want.append(x)
    got = [r.p for r in spark.range(n).orderBy("id").select(sampling.permuted(F.col("id"), n, 5).alias("p")).collect()]
    assert got == want and sorted(got) == list(range(n))


def test_every_row_of_many_files_gets_its_place(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 10_000, 1, 7).select((F.col("id") % 50).alias("v"), F.lit("x").alias("_first")).write.parquet(path)
    df = spark.read.parquet(path)
    out = sampling.shuffle_positions(df, 3)
    places = [r.shuffle_pos for r in out.collect()]
    assert sorted(places) == list(range(1, 10_001)) and out.columns == ["v", "_first", "shuffle_pos"]
    # the same places whatever the partitions of the scan
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        again = sampling.shuffle_positions(spark.read.parquet(path), 3)
        assert again.exceptAll(out).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    # close to a uniform permutation: neighbours are no closer than chance has it
    steps = [abs(a - b) for a, b in zip(places, places[1:])]
    assert abs(sum(steps) / len(steps) - 10_000 / 3) < 150
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "SortMergeJoin" not in plan


def test_filtered_and_empty_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 10, 1, 1).write.parquet(path)
    with pytest.raises(ValueError):
        sampling.shuffle_positions(spark.read.parquet(path).filter("id > 5"), 1)
    none = str(tmp_path / "none")
    spark.range(0).write.parquet(none)
    assert sampling.shuffle_positions(spark.read.parquet(none), 1).count() == 0
