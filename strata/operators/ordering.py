"""Global sort, partition checks, positions, chunking and merging of sorted runs."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import chunk_id
from ..session import ship_package
from .scan import Scan, global_position, ordered_scan
from .splits import _names, exchange, plan

__all__ = [
    "range_sort", "partition_summary", "range_partition_check", "partition_sort_check",
    "order_check", "global_position", "merge_runs", "merge_tagged", "sorted_runs", "chunk_sizes", "chunk_sort",
    "chunked_merge_sort", "chunk_id",
]


def range_sort(df: DataFrame, keys: Sequence, n: int | None = None, least: int = 1,
               bucket_bytes: int | None = None) -> DataFrame:
    """O1-O3: partitions hold ascending, disjoint key ranges, each sorted.

    Split points are quantiles of a merged KLL sketch of the first key (``splits``), the sort
    runs inside each partition, so writing the partitions in order gives a
    sorted whole. ``n`` follows from the measured bytes unless it is given (``least`` partitions at
    least, of about ``bucket_bytes``), and is kept as asked (REPARTITION_BY_NUM: AQE does not coalesce it).
    """
    named = _names(keys)
    n, points = plan(df, named, n, least, bucket_bytes)
    return exchange(df, named if points else keys, n, points).sortWithinPartitions(*keys)


def _summary_schema(dt: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("pid", T.IntegerType()), T.StructField("n", T.LongType()),
        T.StructField("first", dt), T.StructField("last", dt),
        T.StructField("lo", dt), T.StructField("hi", dt),
        T.StructField("n_inversions", T.LongType()),
    ])


def _descends(before, after) -> bool:
    """Is ``after`` below ``before``, NULL being the lowest value (as Spark sorts)?"""
    import pyarrow.compute as pc

    if not before.is_valid or not after.is_valid:
        return before.is_valid
    return pc.less(after, before).as_py()


def _edge_fn(col: str, arrow_schema: pa.Schema):
    """Per partition: rows, first/last value, min/max and descending neighbours."""
    import pyarrow.compute as pc

    def fn(batches):
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        n = inv = 0
        first = last = lo = hi = None
        for batch in batches:
            m = batch.num_rows
            if m == 0:
                continue
            v = batch.column(col)
            if last is not None and _descends(last, v[0]):
                inv += 1
            if m > 1:
                inv += pc.sum(pc.less(v.slice(1), v.slice(0, m - 1))).as_py() or 0
                inv += pc.sum(pc.and_(v.slice(1).is_null(), v.slice(0, m - 1).is_valid())).as_py() or 0
            if first is None:
                first = v[0]
            last = v[m - 1]
            mm = pc.min_max(v)
            if mm["min"].is_valid:          # a batch of NULLs alone has no range
                lo = mm["min"] if lo is None or pc.less(mm["min"], lo).as_py() else lo
                hi = mm["max"] if hi is None or pc.greater(mm["max"], hi).as_py() else hi
            n += m
        if n:
            yield pa.RecordBatch.from_pylist(
                [dict(pid=pid, n=n, first=first.as_py(), last=last.as_py(), lo=None if lo is None else lo.as_py(),
                      hi=None if hi is None else hi.as_py(), n_inversions=inv)], schema=arrow_schema)
    return fn


def partition_summary(df: DataFrame, col: str) -> DataFrame:
    """O5 edge summary: one row per non-empty partition, in the frame's own order.

    One vectorised pass per partition over any orderable column; the result
    has one row per partition, so anything done on it afterwards is bounded
    by the partition count.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    ship_package(df.sparkSession)
    schema = _summary_schema(df.schema[col].dataType)
    return df.select(col).mapInArrow(_edge_fn(col, to_arrow_schema(schema)), schema)


def _stitched(summary: DataFrame) -> DataFrame:
    w = Window.orderBy("pid")   # over <= n partition rows, never over data
    return (summary
            .withColumn("prev_last", F.lag("last").over(w))
            # the greatest value of any earlier partition: partitions of NULLs alone hide nothing
            .withColumn("prev_hi", F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1)))
            .withColumn("first_is_lower", F.col("prev_last").isNotNull()
                        & (F.col("first").isNull() | (F.col("prev_last") > F.col("first")))))


def range_partition_check(df: DataFrame, key: str, n: int | None = None, ties: Sequence = ()) -> DataFrame:
    """O2: after range partitioning, later partitions hold no lower values.

    ``ties``: columns that order equal keys, so that a frequent key is cut into several partitions.
    """
    s = _stitched(partition_summary(range_sort(df, [key, *ties], n), key))
    return s.agg(F.sum("n").cast("long").alias("n_rows"),
                 F.count_if(F.col("prev_hi") > F.col("lo")).cast("long").alias("overlapping_ranges"))


def partition_sort_check(df: DataFrame, key: str, n: int | None = None, ties: Sequence = ()) -> DataFrame:
    """O3: every partition is sorted and partitions follow each other in order (``ties`` as in O2)."""
    s = _stitched(partition_summary(range_sort(df, [key, *ties], n), key))
    return s.agg(F.sum("n").cast("long").alias("n_rows"),
                 (F.sum("n_inversions") + F.count_if("first_is_lower"))
                 .cast("long").alias("inversions"))


def order_check(df: DataFrame, value: str, position: Sequence, n: int | None = None) -> DataFrame:
    """Is ``value`` non-decreasing along ``position``?

    ``unsorted`` is 1 if any neighbouring pair descends, else 0 (equal
    neighbours are fine). The table is range partitioned on the position,
    each partition counts its inversions in one pass, and the partition
    edges are checked on the small per-partition summary.
    """
    ordered = range_sort(df.select(*position, value), position, n)
    s = _stitched(partition_summary(ordered, value))
    inv = F.sum("n_inversions") + F.count_if("first_is_lower")
    return s.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_rows"),
                 F.coalesce(inv, F.lit(0)).cast("long").alias("n_inversions"),
                 F.when(F.coalesce(inv, F.lit(0)) > 0, 1).otherwise(0).alias("unsorted"))


def merge_runs(runs: Sequence[DataFrame], key: Sequence, pos: str = "pos", out: str = "merged_pos",
               run_col: str = "run_id", n: int | None = None) -> DataFrame:
    """K-way merge of sorted runs; on equal keys the lower run index wins.

    Each run carries its own position column ``pos`` (its sorted order).
    The merge is a union with the run index as a literal and one range
    sort on ``(key, run_id, pos)``; the merged position is global.
    """
    tagged = [r.withColumn(run_col, F.lit(i)) for i, r in enumerate(runs)]
    u = tagged[0]
    for t in tagged[1:]:
        u = u.unionByName(t)
    return merge_tagged(u, key, pos, out, run_col, n)


def merge_tagged(runs: DataFrame, key: Sequence, pos: str = "pos", out: str = "merged_pos",
                 run_col: str = "run_id", n: int | None = None) -> DataFrame:
    """O4 on runs already stacked in one frame and told apart by ``run_col``."""
    return global_position(runs, [*_names(key), run_col, pos], out=out, n_partitions=n)


def sorted_runs(df: DataFrame, run_col: str, key: Sequence, pos: str = "pos", n: int | None = None) -> DataFrame:
    """Sort every run on ``key``: ``pos`` is the 1-based place inside its run.

    A grouped ordered scan, so one long run is still spread over many tasks.
    """
    return ordered_scan(df, _names(key), [run_col], [Scan(pos, "row_number")], n)


def chunk_sizes(df: DataFrame, idx: str, k: int, n_rows=None) -> DataFrame:
    """Rows per contiguous chunk, remainder in the last chunk."""
    n_rows = n_rows if n_rows is not None else df.select(F.count(F.lit(1))).scalar()
    c = df.select(idx, chunk_id(F.col(idx), n_rows, k).alias("chunk"))
    return c.groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.min(idx).alias("lo"),
                                  F.max(idx).alias("hi"))


def chunk_sort(df: DataFrame, idx: str, key: Sequence, k: int, out: str = "chunk_pos",
               n: int | None = None) -> DataFrame:
    """Sort each contiguous chunk on its own; ``chunk_pos`` is 1-based per chunk.

    The position is a grouped ordered scan, so a chunk that holds most of
    the rows is still spread over many tasks.
    """
    n_rows = df.select(F.count(F.lit(1))).scalar()
    c = df.withColumn("chunk", chunk_id(F.col(idx), n_rows, k))
    return ordered_scan(c, [*_names(key), idx], ["chunk"], [Scan(out, "row_number")], n)


def chunked_merge_sort(df: DataFrame, idx: str, key: str, k: int, out: str = "merged_pos",
                       n: int | None = None) -> DataFrame:
    """Chunk (O7), sort each chunk (O8), merge the chunks.

    ``k`` must be at least 2 (the reference refuses less). The thread depth
    argument of the reference has no meaning here. Lower chunk wins ties.
    """
    if k < 2:
        raise ValueError(f"a merge sort needs at least two chunks, not {k}")
    sorted_chunks = chunk_sort(df, idx, [key], k, out="chunk_pos", n=n)
    return global_position(sorted_chunks, [key, "chunk", "chunk_pos"], out=out, n_partitions=n)
