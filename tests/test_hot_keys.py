"""A key holding a third of the rows is split across tasks, and stays correct."""

from pyspark.sql import functions as F

from strata.operators import ledger as L
from strata.plans import vectors as VP

SF = "/root/testdata/sf0.01"


def test_hot_account_spans_many_range_partitions(spark):
    legs = VP._legs(spark, SF, hot=True)
    n = legs.count()
    hot = legs.where(F.col("acct") == 0).count()
    assert hot > n / 6                       # about a third of the debits, a sixth of all legs
    # the exchange the ordered scan uses: (group, order) range bounds cut the hot account
    parts = (legs.repartitionByRange(8, "acct", "seq", "leg")
                 .where(F.col("acct") == 0).select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts >= 2


def test_hot_account_running_balance_matches_brute_force(spark):
    acc, legs = VP._accounts(spark, SF), VP._legs(spark, SF, hot=True)
    res = L.running_balance(acc, legs, n_partitions=8).where(F.col("acct") == 0).orderBy("seq", "leg")
    got = [r.balance for r in res.collect()]
    opening = acc.where(F.col("acct") == 0).first().opening
    deltas = [r.delta for r in legs.where(F.col("acct") == 0).orderBy("seq", "leg").collect()]
    expect, run = [], opening
    for d in deltas:
        run += d
        expect.append(run)
    assert got == expect


def test_single_cluster_log_is_split_by_the_segment_scan(spark):
    from strata.functions.columns import micros
    from strata.operators import lease as LS
    from strata.plans import lease as LP

    c = LS.resolve_cluster(LS.parse_requests(LP.request_log(spark, SF)), LP.directory(spark, SF, True))
    req = c.where(F.col("kind") == "request").withColumn("t_us", micros("ts"))
    assert req.select("cluster").distinct().count() == 1
    parts = (req.repartitionByRange(8, "cluster", "t_us", "request_id")
                .select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts >= 4                       # one key, many tasks
