import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from orderlens.operators import cutpoints, ranking

SCHEMA = "g int, k long, u string"


def compare(spark, rows, groups=(), tiles=5):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = cutpoints.ntile(df, tiles, F.col("k"), "u", list(groups), "t")
    want = df.withColumn("t", F.ntile(tiles).over(Window.partitionBy(*groups).orderBy("k", "u")))
    return sorted(map(tuple, got.collect()), key=repr), sorted(map(tuple, want.collect()), key=repr)


@pytest.fixture
def narrow(monkeypatch):
    """Brackets smaller than the groups of these tests, so every step of the narrowing runs."""
    monkeypatch.setattr(cutpoints, "SMALL", 1000)
    monkeypatch.setattr(cutpoints, "SLACK", 0.003)


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 7, 12, 23])
def test_ntile_small_sizes(spark, n):
    got, want = compare(spark, [(0, i % 3, f"u{i:03d}") for i in range(n)])
    assert got == want


def test_ntile_heavy_ties_and_groups(spark, narrow):
    """Ties that hold a group's boundaries, null keys, ids with a long common beginning."""
    rnd = random.Random(7)
    rows = []
    for g, size in enumerate([3, 5, 12, 997, 6000, 2500]):
        key = lambda: rnd.choice((0, 1, 1, None, rnd.randint(-9, 10**12)))
        rows += [(g, key(), f"customer-{'é' if i % 9 == 0 else ''}{rnd.randint(0, 10**8)}-{g}-{i}") for i in range(size)]
    for groups in (("g",), ()):
        got, want = compare(spark, rows, groups=groups)
        assert got == want


def test_ntile_near_unique_keys(spark, narrow):
    rnd = random.Random(11)
    got, want = compare(spark, [(0, rnd.randint(0, 10**6), f"u{i:05d}") for i in range(4363)])
    assert got == want


def test_brackets_hold_a_small_part_of_a_large_group(spark):
    """Default settings, a group far beyond SMALL: few keys are counted one by one."""
    df = spark.range(200_000).select(F.lit(0).alias("g"), (F.col("id") * 7919 % 200_003).alias("k"),
                                     F.format_string("u%07d", F.col("id")).alias("u"))
    rows = df.select("g", F.col("k").alias("_v"), F.col("u").alias("_tie"))
    marks = cutpoints._marks(rows, 5, ["g"])
    keys = sorted(r.k for r in df.collect())
    assert {m.t: (m.key, m.ties, m.nth) for m in marks} == {t: (k, 1, 1) for t, k in enumerate(keys[39_999:160_000:40_000], 1)}
    got = cutpoints.ntile(df, 5, F.col("k"), "u", ["g"], "t").groupBy("t").count().collect()
    assert sorted(map(tuple, got)) == [(t, 40_000) for t in range(1, 6)]


def test_a_missed_boundary_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(cutpoints, "SMALL", 0)
    monkeypatch.setattr(cutpoints, "SLACK", -0.2)  # brackets on the wrong sides
    df = spark.range(5000).select(F.lit(0).alias("g"), F.col("id").alias("k"), F.col("id").cast("string").alias("u"))
    with pytest.raises(ArithmeticError, match="outside its bracket"):
        cutpoints.ntile(df, 5, F.col("k"), "u", ["g"], "t")


def test_median_is_the_lower_middle_value(spark, narrow):
    rnd = random.Random(2)
    data = {g: [rnd.randint(-50, 10**rnd.randint(1, 9)) for _ in range(n)] for g, n in enumerate((1, 2, 7, 3000))}
    df = spark.createDataFrame([(g, v) for g, vs in data.items() for v in vs], "g int, v long")
    got = cutpoints.key_cuts(df, 2, "v", ["g"])
    assert got == {(g,): [sorted(vs)[(len(vs) - 1) // 2]] for g, vs in data.items()}


def test_rows_keep_their_partitions(spark):
    """The tiled rows are neither sorted nor shuffled nor checkpointed."""
    df = spark.range(2000).select((F.col("id") % 17).alias("k"), F.col("id").cast("string").alias("u"), (F.col("id") % 3).alias("g"))
    for group in ([], ["g"]):
        out = cutpoints.ntile(df, 5, F.col("k"), "u", group, out_col="t")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Sort" not in plan and "hashpartitioning" not in plan and "rangepartitioning" not in plan and "Scan ExistingRDD" not in plan


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-2, 2) | st.none()), min_size=1, max_size=60), st.integers(1, 7))
def test_ntile_property(spark, rows, tiles):
    got, want = compare(spark, [(g, k, f"u{i:03d}") for i, (g, k) in enumerate(rows)], groups=("g",), tiles=tiles)
    assert got == want


def test_row_number_matches_window(spark):
    rnd = random.Random(3)
    df = spark.createDataFrame([(rnd.randint(0, 5), f"u{i:04d}") for i in range(500)], "k int, u string")
    order = [F.col("k").desc(), F.col("u").asc()]
    got = {(r.u, r.rn) for r in ranking.row_number(df, order, out_col="rn", num_ranges=4, method="distributed").collect()}
    want = {(r.u, r.rn) for r in df.withColumn("rn", F.row_number().over(Window.orderBy(*order))).collect()}
    assert got == want


def test_hot_tied_key_stays_balanced_and_exact(spark):
    # 90 % of the rows share one key value (one customer value holding most rows)
    df = spark.range(20000).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 97).otherwise(F.lit(5)).alias("k"),
        F.format_string("u%06d", F.col("id")).alias("u"))
    keys = [F.col("k").asc(), F.col("u").asc()]
    sizes = [r["n"] for r in df.repartitionByRange(8, *keys)
             .groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) <= 2 * (20000 / 8)
    got = ranking.row_number(df, keys, out_col="rn", num_ranges=8, method="distributed")
    want = df.withColumn("rn", F.row_number().over(Window.orderBy(*keys)))
    assert {(r.u, r.rn) for r in got.collect()} == {(r.u, r.rn) for r in want.collect()}
    got, want = compare(spark, [(0, r.k, r.u) for r in df.collect()])
    assert got == want
