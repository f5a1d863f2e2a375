"""Split points from the merged sketch: prefixes keep order, ranks are close, hot keys fall back."""

import datetime
import decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import splits as S
from strata.operators.ordering import partition_summary, range_sort


@pytest.mark.parametrize("kind, values", [
    ("int", [None, -2 ** 31, -5, -1, 0, 1, 2 ** 31 - 1]),
    ("bigint", [None, -2 ** 63, -2 ** 40, 0, 3, 2 ** 63 - 1]),
    ("boolean", [None, False, True]),
    ("date", [None, datetime.date(1900, 1, 1), datetime.date(1970, 1, 1), datetime.date(2024, 5, 6)]),
    ("timestamp", [None, datetime.datetime(1960, 1, 1), datetime.datetime(2024, 1, 1, 0, 0, 0, 1)]),
    ("decimal(12,3)", [None, decimal.Decimal("-9.125"), decimal.Decimal("0"), decimal.Decimal("7.001")]),
    ("string", [None, "", "\x00", "a", "a\x00", "abcdefgh", "abcdefghi", "b", "é", "漢", "\U0001f926"]),
    ("binary", [None, b"", b"\x00\x01", b"\x7f", b"\x80", b"\xff" * 9]),
])
def test_prefixes_keep_order(spark, kind, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    prefix, _ = S.order_prefix(F.col("v"), df.schema["v"].dataType)
    got = [r.p for r in df.select("i", prefix.alias("p")).orderBy("v", "i").collect()]
    by_value = [r.p for r in df.orderBy("v").select(prefix.alias("p")).collect()]
    assert got == sorted(got) and by_value == sorted(by_value)


def test_no_prefix_for_other_types():
    from pyspark.sql import types as T

    assert S.order_prefix(F.lit(1.0), T.DoubleType()) is None
    assert S.order_prefix(F.lit(1), T.StructType([])) is None


@pytest.mark.parametrize("n", [2, 7, 64])
def test_rank_error_of_the_split_points(spark, n):
    rng = np.random.default_rng(n)
    v = np.concatenate((rng.normal(0, 1e6, 30_000).astype(int), rng.integers(-50, 50, 3_000)))
    df = spark.createDataFrame([(int(x),) for x in v], "v long").repartition(9)
    got, points = S.plan(df, ["v"], n)
    assert got == n and len(points) <= n - 1
    ranks = np.searchsorted(np.sort(v), points) / len(v)
    assert np.abs(ranks - np.arange(1, n) / n).max() < 0.01 if len(points) == n - 1 else True
    sizes = [r["count"] for r in S.exchange(df, ["v"], n, points).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == len(v) and max(sizes) < 1.2 * len(v) / n + 3_000


@pytest.mark.parametrize("keys", [["k"], ["s", "id"], ["x", "id"]])
def test_range_sort_is_a_sort(spark, keys):
    df = spark.range(0, 5000, numPartitions=5).selectExpr(
        "id", "if(id % 4 = 0, null, (id * 7919) % 5003) as k", "concat('common prefix ', (id * 31) % 977) as s",
        "cast(id % 17 as double) as x")
    out = range_sort(df, keys, 6)
    got = [tuple(r[k] for k in keys) for r in out.collect()]
    assert got == sorted(got, key=lambda t: tuple((v is not None, v if v is not None else 0) for v in t))
    summary = partition_summary(out, keys[0]).collect()
    assert sum(r.n for r in summary) == 5000 and sum(r.n_inversions for r in summary) == 0


def test_hot_keys_are_cut_by_further_keys(spark):
    df = spark.range(0, 6000).selectExpr("id", "if(id % 3 = 0, 7L, id) as k")
    assert S.plan(df, ["k", "id"], 12)[1] is None             # Spark's exchange on both keys
    sizes = [r["count"] for r in range_sort(df, ["k", "id"], 12).groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 1000
    assert S.plan(df, ["k"], 12)[1] is not None               # equal keys share a partition in any case


def test_no_job_beside_the_aggregate(spark):
    """Points, count and bytes come from one action over the key and the columns' lengths."""
    df = spark.range(0, 100_000, numPartitions=3).selectExpr("id as k", "'x' as s")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-jobs", "split points")
    try:
        S.plan(df, ["k"], 5)
        jobs = tracker.getJobIdsForGroup("plan-jobs")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # an adaptive aggregate runs its map stage and its result as a job each; nothing else runs
    assert len(jobs) <= 2


def test_empty_and_single_partition(spark):
    empty = spark.createDataFrame([], "k long, s string")
    assert S.plan(empty, ["k"], 4) == (4, None)
    assert range_sort(empty, ["k"], 4).count() == 0
    assert S.plan(empty, ["k"]) == (1, None)
