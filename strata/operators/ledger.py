"""Counters and a ledger of transfers between accounts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import Scan, global_position, ordered_scan


def exact_count(df: DataFrame, out: str = "n") -> DataFrame:
    """A1: exact row count (partial counts per task, one final sum)."""
    return df.agg(F.count(F.lit(1)).alias(out))


def counter_values(df: DataFrame, order, out: str = "counter") -> DataFrame:
    """A3 per row: the counter's value right after each increment, in arrival
    order (a global position, spread over all tasks)."""
    return global_position(df, order, out=out)


def counter_rollup(df: DataFrame, worker: str, out: str = "n") -> DataFrame:
    """A2: count per worker plus the grand total (worker NULL)."""
    return df.rollup(worker).agg(F.count(F.lit(1)).alias(out))


def account_numbers(df: DataFrame, order: Sequence, out: str = "aid") -> DataFrame:
    """A4: dense 1-based account ids in creation order (a global position)."""
    return global_position(df, order, out=out)


def transfer_legs(transfers: DataFrame, seq: str = "seq", src: str = "src", dst: str = "dst",
                  amount: str = "amount") -> DataFrame:
    """A5: each transfer becomes a debit leg (0) on ``src`` and a credit leg (1) on ``dst``.

    One row in, two rows out from one generator: both legs or neither.
    """
    legs = F.explode(F.array(
        F.struct(F.lit(0).alias("leg"), F.col(src).alias("acct"), (-F.col(amount)).alias("delta")),
        F.struct(F.lit(1).alias("leg"), F.col(dst).alias("acct"), F.col(amount).alias("delta")),
    ))
    return transfers.select(F.col(seq).alias("seq"), legs.alias("_l")).select("seq", "_l.*")


def closing_balances(accounts: DataFrame, legs: DataFrame, acct: str = "acct",
                     opening: str = "opening") -> DataFrame:
    """Opening + sum of legs; accounts without legs keep the opening.

    No overdraft check, as in the reference. Legs are summed map-side first,
    so a busy account sends one partial sum per task to the join.
    """
    sums = legs.groupBy("acct").agg(F.sum("delta").alias("_moved"))
    a = accounts.select(F.col(acct).alias("acct"), F.col(opening).alias("opening"))
    return (a.join(sums, "acct", "left")
             .select("acct", "opening",
                     (F.col("opening") + F.coalesce(F.col("_moved"), F.lit(0))).alias("closing")))


def running_balance(accounts: DataFrame, legs: DataFrame, acct: str = "acct",
                    opening: str = "opening", n_partitions: int | None = None) -> DataFrame:
    """Balance of the account after each leg, in (seq, leg) order.

    The opening balance enters as a pseudo-leg that sorts first in its
    account, so the running sum needs no join with the accounts. The sum
    is a grouped ordered scan: a busy account is split over many tasks.
    """
    opening_rows = accounts.select(F.lit(None).cast("long").alias("seq"), F.lit(-1).alias("leg"),
                                   F.col(acct).alias("acct"), F.col(opening).alias("delta"))
    all_rows = legs.select("seq", "leg", "acct", "delta").unionByName(opening_rows)
    scanned = ordered_scan(all_rows, ["seq", "leg"], ["acct"], [Scan("balance", "sum", "delta")],
                           n_partitions)
    return scanned.where(F.col("leg") >= 0).select("seq", "leg", "acct", "delta", "balance")


def conservation(accounts: DataFrame, balances: DataFrame, opening: str = "opening",
                 closing: str = "closing") -> DataFrame:
    """Total money is unchanged by transfers."""
    u = (accounts.select(F.col(opening).cast("long").alias("_o"), F.lit(0).cast("long").alias("_c"))
                 .unionByName(balances.select(F.lit(0).cast("long").alias("_o"),
                                              F.col(closing).cast("long").alias("_c"))))
    t = u.agg(F.coalesce(F.sum("_o"), F.lit(0)).cast("long").alias("opening_total"),
              F.coalesce(F.sum("_c"), F.lit(0)).cast("long").alias("closing_total"))
    return t.select("opening_total", "closing_total",
                    (F.col("opening_total") == F.col("closing_total")).alias("conserved"))
