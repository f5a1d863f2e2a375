"""Sort, range partitions, chunks and merges (O1-O9) with the fixtures' small cases."""

import pytest
from pyspark.sql import functions as F

from strata.functions.columns import chunk_id
from strata.operators import ordering as O


def test_unsigned_byte_order(spark):
    keys = [bytes([0x80]), bytes([0xFF]), bytes([0x00]), bytes([0x7F]), bytes([0x7F, 0x00]), bytes([0x01])]
    df = spark.createDataFrame([(k,) for k in keys], "key binary")
    out = O.global_position(df, ["key"], n_partitions=3).orderBy("pos").collect()
    assert [bytes(r.key) for r in out] == [b"\x00", b"\x01", b"\x7f", b"\x7f\x00", b"\x80", b"\xff"]


def test_range_sort_partitions_disjoint_and_sorted(spark):
    df = spark.range(0, 20000).selectExpr("(id * 104729) % 20011 as k")
    s = O.range_sort(df, ["k"], 5)
    parts = s.rdd.glom().map(lambda rows: [r.k for r in rows]).collect()
    flat = [k for p in parts for k in p]
    assert flat == sorted(flat) and len(flat) == 20000
    assert O.partition_sort_check(df, "k", 5).first().inversions == 0
    assert O.range_partition_check(df, "k", 5).first().overlapping_ranges == 0


@pytest.mark.parametrize("n,k,sizes", [(10, 3, [3, 3, 4]), (2, 5, [0, 0, 0, 0, 2]), (9, 3, [3, 3, 3])])
def test_chunk_sizes_remainder_last(spark, n, k, sizes):
    df = spark.range(n).select(chunk_id(F.col("id"), n, k).alias("c"))
    got = {r.c: r.n for r in df.groupBy("c").agg(F.count("*").alias("n")).collect()}
    assert [got.get(i, 0) for i in range(k)] == sizes


def test_merge_runs_lower_run_wins_ties(spark):
    runs = [[1, 3, 3], [2, 3], []]
    dfs = [spark.createDataFrame([(v, i + 1) for i, v in enumerate(r)], "v long, pos long") for r in runs]
    out = O.merge_runs(dfs, ["v"], pos="pos", n=2).orderBy("merged_pos").collect()
    assert [r.v for r in out] == [1, 2, 3, 3, 3]
    assert [r.run_id for r in out] == [0, 1, 0, 0, 1]


def test_order_check(spark):
    up = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 2, 2, 3, 5])], "p long, v double")
    down = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 3, 2, 4, 0])], "p long, v double")
    assert O.order_check(up, "v", ["p"], 2).first().unsorted == 0
    r = O.order_check(down, "v", ["p"], 3).first()
    assert (r.unsorted, r.n_inversions, r.n_rows) == (1, 2, 5)


def test_chunked_merge_sort_sorted_and_k_check(spark):
    df = spark.range(0, 1000).selectExpr("id as idx", "cast((id * 7919) % 997 as double) as v")
    out = O.chunked_merge_sort(df, "idx", "v", 4, n=3).orderBy("merged_pos").collect()
    vals = [r.v for r in out]
    assert vals == sorted(vals) and len(vals) == 1000
    with pytest.raises(ValueError):
        O.chunked_merge_sort(df, "idx", "v", 1)


def test_order_check_on_strings(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(["a", "b", "b", "a", "c", "B"])], "p long, v string")
    r = O.order_check(df, "v", ["p"], 3).first()
    assert (r.n_inversions, r.unsorted) == (2, 1)


from hypothesis import given, settings
from hypothesis import strategies as st


@settings(max_examples=10, deadline=None)
@given(st.lists(st.binary(min_size=0, max_size=4), min_size=0, max_size=80), st.integers(1, 6))
def test_range_sort_concatenation_is_sorted(spark, keys, n):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key binary, id long")
    parts = O.range_sort(df, ["key", "id"], n).rdd.glom().map(lambda rows: [bytes(r.key) for r in rows]).collect()
    flat = [k for p in parts for k in p]
    assert flat == sorted(keys)


@settings(max_examples=15, deadline=None)
@given(st.integers(0, 60), st.integers(1, 9))
def test_chunk_sizes_property(spark, n, k):
    df = spark.range(n).select(chunk_id(F.col("id"), n, k).alias("c"))
    got = {r.c: r.n for r in df.groupBy("c").agg(F.count("*").alias("n")).collect()}
    sizes = [got.get(i, 0) for i in range(k)]
    assert sum(sizes) == n
    if n // k:
        assert sizes[:-1] == [n // k] * (k - 1) and sizes[-1] == n // k + n % k
    else:
        assert sizes[-1] == n


def test_partition_checks_with_nulls(spark):
    """NULLs sort first; partitions of NULLs alone hide no overlap."""
    rows = [(None,)] * 40 + [(i,) for i in range(40)]
    df = spark.createDataFrame(rows, "k int")
    assert O.partition_sort_check(df, "k", 5).first().inversions == 0
    assert O.range_partition_check(df, "k", 5).first().overlapping_ranges == 0
    by_hand = spark.createDataFrame([(0, 5), (0, 9), (1, None), (1, None), (2, 7), (2, 8)], "p int, k int")
    parts = by_hand.repartitionByRange(3, "p").sortWithinPartitions("p")
    s = O._stitched(O.partition_summary(parts, "k"))
    assert s.where("prev_hi > lo").count() == 1               # 9 before 7, past the NULLs
    assert s.where("first_is_lower").count() == 1             # NULL after 9


def test_ties_cut_a_frequent_key(spark):
    df = spark.range(4000).selectExpr("id", "if(id % 3 > 0, 7, id % 50) as k")
    one, cut = (O.partition_summary(O.range_sort(df, keys, 8), "k").collect() for keys in (["k"], ["k", "id"]))
    assert max(r.n for r in cut) < 1000 < max(r.n for r in one)
    assert O.partition_sort_check(df, "k", 8, ["id"]).first().inversions == 0
