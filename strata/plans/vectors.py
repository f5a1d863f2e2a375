"""Driver-table queries for vectors, copies and the ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import cents
from ..operators import elementwise as V
from ..operators import ledger as L
from ..session import fresh_dir
from ..sources.tables import table

K_CHUNKS = 7


def _shifted(spark, sf_dir):
    """dst[i] = value of event i, src[i] = value of event i+1, both float32."""
    ev = table(spark, sf_dir, "events").select("event_id", F.col("value").cast("float").alias("v"))
    last = ev.select(F.max("event_id")).scalar()
    dst = ev.where(F.col("event_id") < last).select(F.col("event_id").alias("idx"), F.col("v").alias("x"))
    src = ev.where(F.col("event_id") > 0).select((F.col("event_id") - 1).alias("idx"), F.col("v").alias("y"))
    return dst, src


def vector_add(spark, sf_dir):
    dst, src = _shifted(spark, sf_dir)
    return V.vector_add(dst, src)


def vector_add_chunked(spark, sf_dir):
    dst, src = _shifted(spark, sf_dir)
    return V.vector_add_chunked(dst, src, K_CHUNKS)


def vector_add_array(spark, sf_dir):
    """V2: embedding i plus embedding i+1, element by element."""
    e = table(spark, sf_dir, "embeddings")
    ends = e.agg(F.min("vec_id").alias("lo"), F.max("vec_id").alias("hi"))
    a = e.where(F.col("vec_id") < ends.select("hi").scalar()).select("vec_id", F.col("embedding").alias("a"),
                                                                     F.lit(True).alias("_in_a"))
    b = e.where(F.col("vec_id") > ends.select("lo").scalar()).select(
        (F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b"), F.lit(True).alias("_in_b"))
    both = a.join(b, "vec_id", "full_outer")
    gap = F.col("_in_a").isNull() | F.col("_in_b").isNull()
    total = F.when(gap, F.raise_error(F.lit("vector_add_array: the vector ids have a gap"))) \
        .otherwise(V.array_add("a", "b"))
    return both.select("vec_id", total.alias("sum_vec"))


def copy_verify(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    copy = V.copy_table(li, fresh_dir(spark, "copy-lineitem"))
    return V.verify_copy(li, copy)


def copy_digest_verify(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    copy = V.copy_table(li, fresh_dir(spark, "copy-lineitem"))
    return V.verify_digest(li, copy)


def counter_values(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "ts")
    return L.counter_values(ev, ["ts", "event_id"]).select("event_id", "counter")


def counter(spark, sf_dir):
    return L.exact_count(table(spark, sf_dir, "events"))


def counter_rollup(spark, sf_dir):
    return L.counter_rollup(table(spark, sf_dir, "events"), "event_type")


def account_numbers(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey")
    return L.account_numbers(c, ["c_custkey"])


def _accounts(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("acct"), cents("c_acctbal").alias("opening"))


def _legs(spark, sf_dir, hot: bool = False):
    """Transfers from orders: o_custkey pays (o_custkey*7+1) % customers.

    ``hot=True``: every third order is paid by account 0 instead, so one
    account holds about a third of all legs (the skew case)."""
    n_cust = table(spark, sf_dir, "customer").select(F.count(F.lit(1))).scalar()
    o = table(spark, sf_dir, "orders")
    src = F.when(F.col("o_orderkey") % 3 == 0, F.lit(0).cast("long")).otherwise(F.col("o_custkey")) \
        if hot else F.col("o_custkey")
    transfers = o.select(F.col("o_orderkey").alias("seq"), src.alias("src"),
                         ((F.col("o_custkey") * 7 + 1) % n_cust).alias("dst"),
                         cents("o_totalprice").alias("amount"))
    return L.transfer_legs(transfers)


def transfer_legs(spark, sf_dir):
    return _legs(spark, sf_dir)


def balances(spark, sf_dir):
    return L.closing_balances(_accounts(spark, sf_dir), _legs(spark, sf_dir))


def running_balance(spark, sf_dir):
    return L.running_balance(_accounts(spark, sf_dir), _legs(spark, sf_dir))


def running_balance_hot(spark, sf_dir):
    """A7 with one account holding about a third of all legs."""
    return L.running_balance(_accounts(spark, sf_dir), _legs(spark, sf_dir, hot=True))


def conservation(spark, sf_dir):
    acc = _accounts(spark, sf_dir)
    return L.conservation(acc, L.closing_balances(acc, _legs(spark, sf_dir)))


QUERIES = {
    "vector_add": vector_add,
    "vector_add_chunked": vector_add_chunked,
    "vector_add_array": vector_add_array,
    "copy_verify": copy_verify,
    "copy_digest_verify": copy_digest_verify,
    "counter": counter,
    "counter_values": counter_values,
    "counter_rollup": counter_rollup,
    "account_numbers": account_numbers,
    "transfer_legs": transfer_legs,
    "balances": balances,
    "running_balance": running_balance,
    "running_balance_hot": running_balance_hot,
    "conservation": conservation,
}

_SHIFT = """with e as (select event_id, value::float as v from events),
    z as (select a.event_id as idx, a.v + b.v as z from e a join e b on b.event_id = a.event_id + 1)"""
_LEGS = """with t as (select o_orderkey as seq, o_custkey as src,
                   (o_custkey * 7 + 1) % (select count(*) from customer) as dst,
                   round(o_totalprice * 100)::bigint as amount from orders),
    legs as (select seq, 0 as leg, src as acct, -amount as delta from t
             union all select seq, 1 as leg, dst as acct, amount as delta from t),
    acc as (select c_custkey as acct, round(c_acctbal * 100)::bigint as opening from customer),
    bal as (select acct, opening, opening + coalesce((select sum(delta) from legs l where l.acct = acc.acct), 0)::bigint
                   as closing from acc)"""

SQL = {
    "vector_add": _SHIFT + " select idx, z from z",
    "vector_add_chunked": _SHIFT + f""",
        c as (select idx, (case when (select count(*) from z) // {K_CHUNKS} = 0 then {K_CHUNKS} - 1
                  else least(idx // ((select count(*) from z) // {K_CHUNKS}), {K_CHUNKS} - 1) end)::bigint
                  as chunk from z)
        select chunk, count(*) as n, min(idx) as lo, max(idx) as hi from c group by chunk""",
    "vector_add_array": """
        select a.vec_id, [p[1] + p[2] for p in list_zip(a.embedding, b.embedding)] as sum_vec
        from embeddings a join embeddings b on b.vec_id = a.vec_id + 1""",
    "copy_verify": """
        select count(*) as n_source, count(*) as n_copy, 0::bigint as missing, 0::bigint as extra,
               true as equal, true as schema_equal from lineitem""",
    "copy_digest_verify": """
        select count(*) as n_source, count(*) as n_copy, true as digest_equal from lineitem""",
    "counter": "select count(*) as n from events",
    "counter_values": "select event_id, row_number() over (order by ts, event_id) as counter from events",
    "counter_rollup": "select event_type, count(*) as n from events group by rollup (event_type)",
    "account_numbers": "select c_custkey, row_number() over (order by c_custkey) as aid from customer",
    "transfer_legs": _LEGS + " select seq, leg, acct, delta from legs",
    "balances": _LEGS + " select acct, opening, closing from bal",
    "running_balance": _LEGS + """
        select seq, leg, acct, delta,
               ((select opening from acc where acc.acct = legs.acct)
                + sum(delta) over (partition by acct order by seq, leg))::bigint as balance
        from legs""",
    "running_balance_hot": _LEGS.replace(
        "o_custkey as src,", "case when o_orderkey % 3 = 0 then 0 else o_custkey end as src,") + """
        select seq, leg, acct, delta,
               ((select opening from acc where acc.acct = legs.acct)
                + sum(delta) over (partition by acct order by seq, leg))::bigint as balance
        from legs""",
    "conservation": _LEGS + """
        select (select sum(opening) from acc)::bigint as opening_total,
               (select sum(closing) from bal)::bigint as closing_total,
               (select sum(opening) from acc) = (select sum(closing) from bal) as conserved""",
}
