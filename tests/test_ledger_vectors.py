"""Counters, ledger, vector add and copy verification."""

import pytest
from pyspark.sql import functions as F

from strata.operators import elementwise as V
from strata.operators import ledger as L


def test_counter_rollup(spark):
    df = spark.createDataFrame([(w,) for w in "AAABB"], "worker string")
    got = {r.worker: r.n for r in L.counter_rollup(df, "worker").collect()}
    assert got == {"A": 3, "B": 2, None: 5}
    assert L.exact_count(df).first().n == 5


def _book(spark, transfers):
    acc = spark.createDataFrame([(1, 1000), (2, 1000), (3, 500)], "acct long, opening long")
    t = spark.createDataFrame(transfers, "seq long, src long, dst long, amount long")
    return acc, L.transfer_legs(t)


def test_balances_rules(spark):
    acc, legs = _book(spark, [(1, 1, 2, 100), (2, 2, 1, 100), (3, 1, 1, 70), (4, 2, 1, 5000)])
    bal = {r.acct: r.closing for r in L.closing_balances(acc, legs).collect()}
    assert bal == {1: 6000, 2: -4000, 3: 500}          # overdraft allowed, idle keeps opening
    cons = L.conservation(acc, L.closing_balances(acc, legs)).first()
    assert cons.conserved and cons.opening_total == 2500
    run = L.running_balance(acc, legs, n_partitions=3).orderBy("acct", "seq", "leg").collect()
    a1 = [(r.seq, r.leg, r.balance) for r in run if r.acct == 1]
    assert a1 == [(1, 0, 900), (2, 1, 1000), (3, 0, 930), (3, 1, 1000), (4, 1, 6000)]


def test_vector_add_forms(spark):
    a = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 2, 3])], "idx long, x float")
    b = spark.createDataFrame([(i, float(v)) for i, v in enumerate([10, 20, 30])], "idx long, y float")
    assert [r.z for r in V.vector_add(a, b).orderBy("idx").collect()] == [11, 22, 33]
    short = b.where("idx < 2")
    with pytest.raises(Exception, match="differ in length"):
        V.vector_add(a, short).collect()
    ok = spark.createDataFrame([([1.0, 2.0, 3.0], [10.0, 20.0, 30.0])], "a array<float>, b array<float>")
    assert ok.select(V.array_add("a", "b").alias("s")).first().s == [11, 22, 33]
    bad = spark.createDataFrame([([1.0], [1.0, 2.0])], "a array<float>, b array<float>")
    with pytest.raises(Exception, match="differ in length"):
        bad.select(V.array_add("a", "b")).collect()


def test_chunked_add_counts(spark):
    a = spark.range(10).selectExpr("id as idx", "cast(id as float) as x")
    b = spark.range(10).selectExpr("id as idx", "cast(1 as float) as y")
    got = sorted((r.chunk, r.n) for r in V.vector_add_chunked(a, b, 3).collect())
    assert got == [(0, 3), (1, 3), (2, 4)]


def test_copy_verify_detects_changes(spark, tmp_path):
    src = spark.range(100).selectExpr("id", "cast(id as double) * -0.0 as z")
    copy = V.copy_table(src, str(tmp_path / "c"))
    r = V.verify_copy(src, copy).first()
    assert r.equal and (r.missing, r.extra) == (0, 0)
    changed = src.withColumn("id", F.when(F.col("id") == 5, 500).otherwise(F.col("id")))
    r = V.verify_copy(src, changed).first()
    assert (r.missing, r.extra, r.equal) == (1, 1, False)
    dup = src.unionByName(src.where("id = 7"))
    r = V.verify_copy(src, dup).first()
    assert (r.missing, r.extra, r.n_copy) == (0, 1, 101)
    # value equality: -0.0 equals 0.0
    zeros = spark.range(100).selectExpr("id", "cast(0.0 as double) as z")
    assert V.verify_copy(src, zeros).first().equal


@pytest.mark.parametrize("fanout", [1, 3, 1024])
def test_hash_tree_finds_single_rows(spark, fanout):
    src = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 7, id) as id", "if(id % 5 = 0, null, cast(id as string)) as s", "array(-0.0D, id * 0.5D) as a",
        "named_struct('x', cast('NaN' as double), 'y', if(id % 2 = 0, null, 1)) as st").withColumn("n", F.lit(1))
    assert tuple(V.verify_copy(src, src.selectExpr("id", "s", "transform(a, x -> x + 0.0D) as a", "st", "n"), fanout)
                 .first()) == (3000, 3000, 0, 0, True, True)
    changed = src.withColumn("s", F.when(F.col("s") == "1234", "other").otherwise(F.col("s")))
    assert tuple(V.verify_copy(src, changed, fanout).first())[:5] == (3000, 3000, 1, 1, False)
    fewer = src.where("s is null or s <> '1234'")
    assert tuple(V.verify_copy(src, fewer, fanout).first())[:5] == (3000, 2999, 1, 0, False)
    none = src.limit(0)
    assert tuple(V.verify_copy(none, none, fanout).first())[:5] == (0, 0, 0, 0, True)
    assert tuple(V.verify_copy(none, fewer, fanout).first())[:5] == (0, 2999, 0, 2999, False)


def test_equal_tables_shuffle_no_rows(spark, monkeypatch):
    """Only digests are grouped: the grouping by whole rows is never built."""
    src = spark.range(100).selectExpr("id", "'x' as s")
    plan = V.verify_copy(src, src)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


from hypothesis import given, settings
from hypothesis import strategies as st


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 5), st.integers(1, 5), st.integers(0, 10_000)), min_size=0, max_size=40))
def test_random_transfers_conserve_money(spark, transfers):
    acc = spark.createDataFrame([(a, 1000 * a) for a in range(1, 6)], "acct long, opening long")
    t = spark.createDataFrame([(i, s, d, amt) for i, (s, d, amt) in enumerate(transfers)],
                              "seq long, src long, dst long, amount long")
    legs = L.transfer_legs(t)
    bal = {r.acct: r.closing for r in L.closing_balances(acc, legs).collect()}
    expect = {a: 1000 * a for a in range(1, 6)}
    for s, d, amt in transfers:
        expect[s] -= amt
        expect[d] += amt
    assert bal == expect
    assert L.conservation(acc, L.closing_balances(acc, legs)).first().conserved
    last = {}
    for r in L.running_balance(acc, legs, n_partitions=3).collect():
        if r.acct not in last or (r.seq, r.leg) > last[r.acct][0]:
            last[r.acct] = ((r.seq, r.leg), r.balance)
    assert all(bal[a] == b for a, (_, b) in last.items())
