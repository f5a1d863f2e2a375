"""Ordered scans that stay parallel when one group holds most of the rows.

``ordered_scan`` computes, per group and in a total order, any mix of

* ``row_number`` - 1-based position,
* ``sum``        - running (inclusive) sum in Spark's own sum type, NULL adds nothing,
* ``ffill``      - last non-NULL value so far (as-of carry forward),
* ``lag``        - the previous row's value (NULL on the group's first row),
* ``segment``    - 1-based session number: a new one starts at the group's
  first row and wherever ``col - previous col >= gap``.

A ``Window.partitionBy(group)`` puts a whole group in one task; with few
groups (4 clusters, 7 chunks, one global order) that is one task per group
whatever the cluster size. Instead the rows go through one range exchange on
``(group, order)`` (``splits``), and the number of the partition that a row lands in, its bucket, is
written with it, once, to the shared folder. Whatever is computed from the buckets later, and any retried
task, reads the same written numbers; no row is compared with bounds again, and plans
do not grow with the bucket count.

Positions in one global order need no window: a bucket is sorted when it is written, a row's place in
it is the low part of ``monotonically_increasing_id``, and the bucket sizes give the offsets. All
other scans are windows per ``(group, bucket)``, one task per bucket, and a per-bucket aggregate
carries counts, sums and last values from the earlier buckets of a group. Only
groups that span buckets need that table: at most two rows per bucket, the bound
that makes its broadcast safe at any data size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .splits import _names, exchange, measured_partitions, plan, written_tasks

KINDS = ("row_number", "sum", "ffill", "lag", "segment")
_B = "_scan_b"
_ID = "_scan_id"
_LOCAL_BITS = 33                 # of monotonically_increasing_id: the row's place in its partition


@dataclass(frozen=True)
class Scan:
    out: str
    kind: str
    col: str | None = None
    gap: float | None = None

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown scan kind {self.kind!r}; use one of {KINDS}")
        if self.kind != "row_number" and not self.col:
            raise ValueError(f"scan {self.kind!r} needs an input column")
        if self.kind == "segment" and self.gap is None:
            raise ValueError("a segment scan needs a gap")


def _bucketed(df: DataFrame, keys: list[str], n: int, points: list[int] | None = None) -> DataFrame:
    """``df`` with its bucket, written once: the partition of a range exchange on ``keys``."""
    x = exchange(df, keys, n, points).withColumn(_B, F.spark_partition_id())
    return materialize(x.coalesce(written_tasks(df, n)), "scan-buckets")


def _placed(df: DataFrame, order: list[str], outs: list[str], n: int, points: list[int] | None) -> DataFrame:
    """``df`` with each row's 1-based place in ``order`` under every name of ``outs``: one exchange, no window."""
    x = exchange(df, order, n, points).sortWithinPartitions(*order).withColumn(_ID, F.monotonically_increasing_id())
    x = materialize(x.coalesce(written_tasks(df, n)), "scan-places")
    bucket, local = F.shiftright(_ID, _LOCAL_BITS), F.col(_ID).bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    sizes = x.groupBy(bucket.alias("_ob")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per bucket: what the window runs over, and what is broadcast
    earlier = Window.orderBy("_ob").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_ob", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_o"))
    joined = x.join(F.broadcast(offsets), bucket == F.col("_ob"))
    place = F.col("_o") + local + 1
    return joined.select(*[F.col(c) for c in df.columns if c not in outs], *[place.alias(o) for o in outs])


def ordered_scan(df: DataFrame, order: Sequence, group: Sequence = (), scans: Sequence[Scan] = (),
                 n_partitions: int | None = None, bucket_bytes: int | None = None) -> DataFrame:
    """Add the scan columns to ``df``; see the module doc. ``order`` should be total.

    Without ``n_partitions`` there are as many as the measured bytes ask for, about ``bucket_bytes`` each.
    """
    order, group = _names(order), _names(group)
    scans = [s if isinstance(s, Scan) else Scan(*s) for s in scans]
    # a group column has few values as a rule: its prefix parts nothing, so only the count is planned then
    n, points = (plan(df, order, n_partitions, bucket_bytes=bucket_bytes) if not group
                 else (n_partitions or measured_partitions(df, bucket_bytes), None))
    if n > 1 and not group and all(s.kind == "row_number" for s in scans):
        return _placed(df, order, [s.out for s in scans], n, points)
    types = {f.name: f.dataType for f in df.schema.fields}
    if n > 1:
        x0 = _bucketed(df, [*group, *order], n, points)
        x = x0.repartitionById(n, F.col(_B))
    else:
        x = df.withColumn(_B, F.lit(0))
    here = Window.partitionBy(*group, _B).orderBy(*order)
    so_far = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def local(s: Scan) -> Column:
        if s.kind == "row_number":
            return F.row_number().over(here).cast("long")
        if s.kind == "sum":
            v = F.col(s.col).cast("long") if isinstance(types[s.col], T.IntegralType) else F.col(s.col)
            return F.sum(v).over(so_far)
        if s.kind == "ffill":
            return F.last(s.col, ignorenulls=True).over(so_far)
        if s.kind == "lag":
            return F.lag(s.col).over(here)
        # 1 where a segment starts, as far as this bucket knows
        gap = F.col(s.col) - F.lag(s.col).over(here)
        return F.when(gap < F.lit(s.gap), 0).otherwise(1).cast("long")

    y = x.select("*", *[local(s).alias("_l_" + s.out) for s in scans],
                 *([F.row_number().over(here).alias("_rn")] if any(s.kind in ("lag", "segment") for s in scans) else []))
    for s in scans:
        if s.kind == "segment":
            y = y.withColumn("_l_" + s.out, F.sum("_l_" + s.out).over(so_far))
    if n == 1:
        return y.select(*_kept(df, scans), *[_whole(s).alias(s.out) for s in scans])

    at = F.struct(*order)
    aggs = [F.count(F.lit(1)).alias("_cnt")]
    for s in scans:
        if s.kind == "sum":
            v = F.col(s.col).cast("long") if isinstance(types[s.col], T.IntegralType) else F.col(s.col)
            aggs.append(F.sum(v).alias("_a_" + s.out))
        elif s.kind == "ffill":
            aggs.append(F.max_by(F.col(s.col), F.when(F.col(s.col).isNotNull(), at)).alias("_a_" + s.out))
        elif s.kind == "lag":
            aggs.append(F.max_by(F.struct(F.col(s.col).alias("v")), at).alias("_a_" + s.out))
        elif s.kind == "segment":
            aggs += [F.max("_l_" + s.out).alias("_a_" + s.out), F.min_by(F.struct(F.col(s.col).alias("v")), at)
                     .alias("_f_" + s.out), F.max_by(F.struct(F.col(s.col).alias("v")), at).alias("_e_" + s.out)]
    source = y if any(s.kind == "segment" for s in scans) else x0
    edges = source.groupBy(*group, _B).agg(*aggs)
    w = Window.partitionBy(*group).orderBy(_B)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    offs = [F.sum("_cnt").over(before).alias("_o_cnt")]
    for s in scans:
        if s.kind == "segment":
            # a bucket's first row goes on with a segment if the gap to the earlier bucket's last row is small
            joins = F.col(f"_f_{s.out}.v") - F.lag("_e_" + s.out).over(w)["v"] < F.lit(s.gap)
            edges = edges.withColumn("_j_" + s.out, F.when(joins, 1).otherwise(0).cast("long"))
    for s in scans:
        if s.kind == "sum":
            offs.append(F.sum("_a_" + s.out).over(before).alias("_o_" + s.out))
        elif s.kind == "ffill":
            offs.append(F.last("_a_" + s.out, ignorenulls=True).over(before).alias("_o_" + s.out))
        elif s.kind == "lag":
            offs.append(F.lag("_a_" + s.out).over(w)["v"].alias("_o_" + s.out))
        elif s.kind == "segment":
            offs.append((F.sum(F.col("_a_" + s.out) - F.col("_j_" + s.out)).over(before) - F.col("_j_" + s.out))
                        .alias("_o_" + s.out))
    carried = edges.select(F.col(_B).alias("_ob"), *[F.col(g).alias(f"_og{i}") for i, g in enumerate(group)], *offs) \
        .where("_o_cnt is not null")
    # rows only for a group's buckets after its first: at most two per bucket, a proven bound for the broadcast
    cond = [F.col(_B) == F.col("_ob")] + [F.col(g).eqNullSafe(F.col(f"_og{i}")) for i, g in enumerate(group)]
    joined = y.join(F.broadcast(carried), cond, "left")
    return joined.select(*_kept(df, scans), *[_stitched(s).alias(s.out) for s in scans])


def _kept(df: DataFrame, scans: Sequence[Scan]) -> list[Column]:
    outs = {s.out for s in scans}
    return [F.col(c) for c in df.columns if c not in outs]


def _whole(s: Scan) -> Column:
    loc = F.col("_l_" + s.out)
    return F.coalesce(loc, F.lit(0)) if s.kind == "sum" else loc


def _stitched(s: Scan) -> Column:
    loc, off = F.col("_l_" + s.out), F.col("_o_" + s.out) if s.kind != "row_number" else F.col("_o_cnt")
    if s.kind in ("row_number", "segment"):
        return loc + F.coalesce(off, F.lit(0))
    if s.kind == "sum":
        return F.coalesce(loc + off, loc, off, F.lit(0))
    if s.kind == "ffill":
        return F.coalesce(loc, off)
    return F.when(F.col("_rn") == 1, off).otherwise(loc)


def global_position(df: DataFrame, order: Sequence, out: str = "pos", group: Sequence = (),
                    n_partitions: int | None = None, bucket_bytes: int | None = None) -> DataFrame:
    """1-based position of every row in ``order`` (within ``group`` if given)."""
    return ordered_scan(df, order, group, [Scan(out, "row_number")], n_partitions, bucket_bytes)
