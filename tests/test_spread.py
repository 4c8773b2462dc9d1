"""Hot keys are sliced, and slicing never changes a result."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortweave.operators import spread as sp


def skewed(spark, n=300):
    """A third of all rows on one key, a tenth without a key, and copies of one row."""
    rng = random.Random(5)
    data = []
    for i in range(n):
        key = 1 if i % 3 == 0 else None if i % 10 == 1 else rng.randint(2, 40)
        data.append((key, 0 if i % 6 == 0 else i))
    return spark.createDataFrame(data, "k int, v int").repartition(6), data


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_spread_join_equals_plain_join(small_tasks, rows, how, null_safe):
    many, _ = skewed(small_tasks)
    few = small_tasks.createDataFrame([(k, k * 10) for k in range(0, 30)] + [(1, 99), (None, 7)], "k int, w int")
    renamed = few.withColumnRenamed("k", "rk")
    same = F.col("k").eqNullSafe(F.col("rk")) if null_safe else F.col("k") == F.col("rk")
    plain = many.join(renamed, same, how).drop("rk")
    assert rows(sp.spread_join(many, few, "k", how, null_safe=null_safe)) == rows(plain)


def test_spread_join_with_condition(small_tasks, rows):
    many, _ = skewed(small_tasks)
    few = small_tasks.createDataFrame([(1, 50), (1, 100), (2, 20)], "k int, w int")
    expected = many.join(few.withColumnRenamed("k", "rk"), (F.col("k") == F.col("rk")) & (F.col("v") < F.col("w")), "left_anti")
    assert rows(sp.spread_join(many, few, "k", "left_anti", where=F.col("v") < F.col("w"))) == rows(expected)


def test_hot_key_is_cut_into_slices(small_tasks):
    many, data = skewed(small_tasks)
    slices = {r["k"]: r["__slices"] for r in sp.hot_keys(many, "k").collect()}
    counts = Counter(k for k, _ in data)
    assert slices == {k: -(-n // 3) for k, n in counts.items() if n > 3}


def test_copies_of_one_row_spread_over_slices(small_tasks):
    copies = small_tasks.range(0, 4000, 1, 8).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    hot = sp.hot_keys(copies, "k")
    marked = sp._mark(copies, hot, ["k"])
    slice_no = F.pmod(F.xxhash64(F.spark_partition_id(), "k", "v"), F.col("__slices"))
    assert marked.select(slice_no.alias("s")).distinct().count() == 8


def test_with_group_values_equals_window(small_tasks, rows):
    many, data = skewed(small_tasks)
    top = {}
    for k, v in data:
        top[k] = max(top.get(k, v), v)
    got = rows(sp.with_group_values(many, "k", top=F.max("v")), "k", "v", "top")
    assert got == sorted(((k, v, top[k]) for k, v in data), key=repr)


def test_window_join_equals_brute_force(small_tasks, rows):
    rng = random.Random(11)
    points = [(1 if i % 3 else rng.randint(2, 5), rng.randint(0, 400)) for i in range(200)] + [(1, None)]
    windows = [(rng.randint(1, 5), s, s + rng.randint(-2, 60), i) for i, s in enumerate(rng.randint(-30, 400) for _ in range(80))]
    base = F.lit("2020-01-01").cast("date")
    pts = small_tasks.createDataFrame(points, "k int, p int").withColumn("pd", F.date_add(base, F.col("p")))
    win = small_tasks.createDataFrame(windows, "k int, s int, e int, id int").select(
        "k", "id", F.date_add(base, F.col("s")).alias("sd"), F.date_add(base, F.col("e")).alias("ed")
    )
    got = rows(sp.window_join(pts, win, "k", "pd", "sd", "ed", width_days=30), "k", "p", "id")
    want = [(k, p, i) for k, p in points for wk, s, e, i in windows if p is not None and k == wk and s <= p <= e]
    assert got == sorted(want, key=repr)


def test_no_cross_join_in_window_join(spark):
    base = F.lit("2020-01-01").cast("date")
    pts = spark.range(50).select(F.lit(1).alias("k"), F.date_add(base, F.col("id").cast("int")).alias("pd"))
    win = spark.range(50).select(F.lit(1).alias("k"), F.date_add(base, F.col("id").cast("int")).alias("sd"))
    win = win.withColumn("ed", F.date_add("sd", 3))
    plan = sp.window_join(pts, win, "k", "pd", "sd", "ed", width_days=7)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
