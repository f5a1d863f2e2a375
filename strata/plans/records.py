"""Driver-table queries for record files and synthetic inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.ordering import global_position, range_sort
from ..session import fresh_dir
from ..sources import fixedrec
from ..sources.records import text_records
from ..sources.synthetic import INT_RANGE, uniform_floats, uniform_ints
from ..sources.tables import table

SEED = 42


def record_roundtrip(spark, sf_dir):
    """Whole documents as 100-byte records, range sorted, written as
    record files (one per partition) into a fresh folder of the shared
    checkpoint directory, and read back with small splits so records
    straddle split edges."""
    recs = text_records(table(spark, sf_dir, "documents"), "doc_id", "text").select("key", "value")
    out = fresh_dir(spark, "records")
    fixedrec.write_records(range_sort(recs, ["key", "value"]), out, mode="append")
    back = fixedrec.read_records(spark, out, split_size=1_000_003)
    return back.select(F.hex("key").alias("key_hex"), F.hex("value").alias("value_hex"))


def sort_records(spark, sf_dir):
    """O1 as a job over files: the documents' records are written unsorted, sorted from files into files, and
    read back with their place; ``pos`` follows file order and offset."""
    recs = text_records(table(spark, sf_dir, "documents"), "doc_id", "text").select("key", "value")
    raw, out = fresh_dir(spark, "records-unsorted"), fresh_dir(spark, "records-sorted")
    fixedrec.write_records(recs, raw)
    fixedrec.sort_records(spark, raw, out)
    back = fixedrec.read_records(spark, out, include_origin=True)
    placed = global_position(back, ["_file", "_offset"])
    return placed.select("pos", F.hex("key").alias("key_hex"), F.hex("value").alias("value_hex"))


def synthetic_ints(spark, sf_dir):
    """One uniform int in 0..99999 and one float in [0, 1] per lineitem row,
    from a seeded generator, so runs repeat."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey")
    g = uniform_floats(uniform_ints(li, SEED), SEED + 1)
    return g.agg(F.count(F.lit(1)).alias("n"),
                 F.coalesce(F.bool_and(F.col("v").between(0, INT_RANGE - 1)), F.lit(True)).alias("ints_in_range"),
                 F.coalesce(F.bool_and(F.col("x").between(0.0, 1.0)), F.lit(True)).alias("floats_in_range"))


QUERIES = {
    "record_roundtrip": record_roundtrip,
    "sort_records": sort_records,
    "synthetic_ints": synthetic_ints,
}

SQL = {
    "record_roundtrip": """
        with h as (select hex(encode(text)) as hx from documents where text is not null),
        r as (select rpad(substr(hx, c.chunk * 200 + 1, 200), 200, '0') as rec
              from h, (select unnest(range(0, ceil(length(hx) / 200)::bigint)) as chunk) c)
        select substr(rec, 1, 20) as key_hex, substr(rec, 21, 180) as value_hex from r""",
    "sort_records": """
        with h as (select hex(encode(text)) as hx from documents where text is not null),
        r as (select rpad(substr(hx, c.chunk * 200 + 1, 200), 200, '0') as rec
              from h, (select unnest(range(0, ceil(length(hx) / 200)::bigint)) as chunk) c)
        select row_number() over (order by rec) as pos, substr(rec, 1, 20) as key_hex,
               substr(rec, 21, 180) as value_hex from r""",
    "synthetic_ints": "select count(*) as n, true as ints_in_range, true as floats_in_range from lineitem",
}
