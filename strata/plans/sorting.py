"""Driver-table queries for the sort family."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ordering as O
from ..sources.records import text_records
from ..sources.tables import table

K_CHUNKS = 7          # chunks for the chunked sort on events
N_RANGES = 8          # range partitions for the partition checks
N_RUNS = 4            # runs for the merge on orders


def range_sort_rank(spark, sf_dir):
    """O1+O6 (flagship): whole documents cut into 100-byte records, range
    sorted on the unsigned 10-byte key (doc_id, chunk break ties), with
    the global 1-based position of every record."""
    recs = text_records(table(spark, sf_dir, "documents"), "doc_id", "text").select("doc_id", "chunk", "key")
    ranked = O.global_position(recs, ["key", "doc_id", "chunk"], out="pos")
    return ranked.select("doc_id", "chunk", F.hex("key").alias("key_hex"), "pos")


def range_partition_check(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return O.range_partition_check(li, "l_extendedprice", N_RANGES, ["l_orderkey", "l_linenumber"])


def partition_sort_check(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return O.partition_sort_check(li, "l_extendedprice", N_RANGES, ["l_orderkey", "l_linenumber"])


LINEITEM_POSITION = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def order_check(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return O.order_check(li, "l_extendedprice", LINEITEM_POSITION)


def merge_runs(spark, sf_dir):
    """Orders in 4 runs by o_orderkey % 4, each sorted on (o_totalprice,
    o_orderkey); merged with the lower run winning ties."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", (F.col("o_orderkey") % N_RUNS).cast("int").alias("run_id"))
    runs = O.sorted_runs(orders, "run_id", ["o_totalprice", "o_orderkey"], pos="pos")
    merged = O.merge_tagged(runs, ["o_totalprice"], pos="pos", out="merged_pos")
    return merged.select("o_orderkey", "run_id", F.col("pos").alias("run_pos"), "merged_pos")


def chunk_sizes(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return O.chunk_sizes(ev, "event_id", K_CHUNKS)


def chunk_sort(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "value")
    return O.chunk_sort(ev, "event_id", ["value"], K_CHUNKS).select("event_id", "chunk", "chunk_pos")


def chunked_merge_sort(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "value")
    return O.chunked_merge_sort(ev, "event_id", "value", K_CHUNKS).select("event_id", "chunk",
                                                                          "merged_pos")


QUERIES = {
    "range_sort_rank": range_sort_rank,
    "range_partition_check": range_partition_check,
    "partition_sort_check": partition_sort_check,
    "order_check": order_check,
    "merge_runs": merge_runs,
    "chunk_sizes": chunk_sizes,
    "chunk_sort": chunk_sort,
    "chunked_merge_sort": chunked_merge_sort,
}

_CHUNK = f"""(case when (select count(*) from events) // {K_CHUNKS} = 0 then {K_CHUNKS} - 1
              else least(event_id // ((select count(*) from events) // {K_CHUNKS}), {K_CHUNKS} - 1)
              end)::bigint"""

SQL = {
    "range_sort_rank": """
        with h as (select doc_id, hex(encode(text)) as hx from documents where text is not null),
        r as (select doc_id, c.chunk::bigint as chunk,
                     substr(rpad(substr(hx, c.chunk * 200 + 1, 200), 200, '0'), 1, 20) as key_hex
              from h, (select unnest(range(0, ceil(length(hx) / 200)::bigint)) as chunk) c)
        select doc_id, chunk, key_hex,
               row_number() over (order by key_hex, doc_id, chunk) as pos
        from r""",
    "range_partition_check": "select count(*) as n_rows, 0::bigint as overlapping_ranges from lineitem",
    "partition_sort_check": "select count(*) as n_rows, 0::bigint as inversions from lineitem",
    "order_check": f"""
        with s as (select l_extendedprice as v,
                          lag(l_extendedprice) over (order by {', '.join(LINEITEM_POSITION)}) as p
                   from lineitem)
        select count(*) as n_rows, count(*) filter (where p > v) as n_inversions,
               case when count(*) filter (where p > v) > 0 then 1 else 0 end as unsorted
        from s""",
    "merge_runs": f"""
        with r as (select o_orderkey, o_totalprice, (o_orderkey % {N_RUNS})::int as run_id,
                          row_number() over (partition by o_orderkey % {N_RUNS}
                                             order by o_totalprice, o_orderkey) as run_pos
                   from orders)
        select o_orderkey, run_id, run_pos,
               row_number() over (order by o_totalprice, run_id, run_pos) as merged_pos
        from r""",
    "chunk_sizes": f"""
        select {_CHUNK} as chunk, count(*) as n, min(event_id) as lo, max(event_id) as hi
        from events group by all""",
    "chunk_sort": f"""
        select event_id, {_CHUNK} as chunk,
               row_number() over (partition by {_CHUNK} order by value, event_id) as chunk_pos
        from events""",
    "chunked_merge_sort": f"""
        select event_id, {_CHUNK} as chunk,
               row_number() over (order by value, {_CHUNK}, event_id) as merged_pos
        from events""",
}
