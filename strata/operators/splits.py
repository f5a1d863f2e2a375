"""Range exchanges whose split points come from one mergeable quantile sketch (O2).

One aggregate over the key column measures a table: rows, bytes, and a KLL sketch of an order-keeping
8-byte prefix of the key. Tasks sketch their own rows and the sketches are merged, so no count job and no
sampling job runs beside it, and what reaches the driver is one row of bounded size. The partition
count follows from the bytes, the split points are the sketch's quantiles, and a row's
partition is the number of split points at or below its prefix: a binary search over a constant
array of longs, handed to ``repartitionById``, so partition numbers ascend with the key.

Rows of one prefix share a partition. Where a prefix takes up several quantiles (a hot key, or texts with
a common beginning) while the remaining bytes or further keys could still part its rows, and for key types
without an order-keeping prefix, Spark's own range exchange on all keys is used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET_BYTES = 1 << 30           # a partition's share of the measured input
SMALL_BUCKET_BYTES = 1 << 20     # while there are fewer partitions than cores
TASK_BYTES = 32 << 20            # a writing task's least share, beyond two tasks a core
LEAST_K, MOST_K = 200, 65535     # sketch sizes; the rank error is about 1.6 / k
_P = "_split_p"
_LOWEST = -(1 << 63)


def _names(cols) -> list[str]:
    return [c if isinstance(c, str) else c._jc.toString() for c in cols]


def row_bytes(schema: T.StructType) -> Column:
    """The bytes of a row: fixed widths, and the lengths of what varies."""
    fixed, varying = 0, []
    for f in schema.fields:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, (T.StringType, T.BinaryType)):
            varying.append(F.octet_length(c))
        elif isinstance(t, T.ArrayType) and _width(t.elementType):
            varying.append(F.size(c) * _width(t.elementType))
        elif _width(t):
            fixed += _width(t)
        else:                                # maps, structs, nested arrays
            varying.append(F.octet_length(F.to_json(F.struct(c))))
    total = F.lit(fixed).cast("long")
    for v in varying:
        total = total + F.greatest(F.coalesce(v, F.lit(0)), F.lit(0))
    return total


def _width(t: T.DataType) -> int:
    if isinstance(t, T.DecimalType):
        return 8 if t.precision <= 18 else 16
    for kinds, n in (((T.ByteType, T.BooleanType), 1), ((T.ShortType,), 2), ((T.IntegerType, T.FloatType, T.DateType), 4),
                     ((T.LongType, T.DoubleType, T.TimestampType, T.TimestampNTZType), 8)):
        if isinstance(t, kinds):
            return n
    return 0


def order_prefix(c: Column, t: T.DataType) -> tuple[Column, bool] | None:
    """(long, exact): never falls as ``c`` rises, NULL first; ``exact`` if it tells all values apart.
    None where the type has none."""
    if isinstance(t, (T.IntegralType, T.BooleanType)):
        key, exact = c.cast("long"), not isinstance(t, T.LongType)
    elif isinstance(t, T.DateType):
        key, exact = F.unix_date(c).cast("long"), True
    elif isinstance(t, T.TimestampType):
        key, exact = F.unix_micros(c), True
    elif isinstance(t, T.DecimalType) and t.precision <= 18:
        key, exact = (c * F.lit(10 ** t.scale)).cast("long"), True
    elif isinstance(t, T.BinaryType) or (isinstance(t, T.StringType) and t.simpleString() == "string"):
        head = F.rpad(F.substring(c.cast("binary"), 1, 8), 8, F.lit(b"\x00"))
        word = [F.conv(F.hex(F.substring(head, at, 4)), 16, 10).cast("long") for at in (1, 5)]
        key, exact = (word[0] - F.lit(1 << 31)) * F.lit(1 << 32) + word[1], False
    else:
        return None
    return F.coalesce(key, F.lit(_LOWEST)), exact


def _from_bytes(size: int, cores: int, bucket: int | None = None) -> int:
    return max(1, min(cores, -(-size // SMALL_BUCKET_BYTES)), -(-size // (bucket or BUCKET_BYTES)))


def _estimate(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def measured_partitions(df: DataFrame, bucket_bytes: int | None = None) -> int:
    """A partition count from the input alone, bounded by no session setting: about ``bucket_bytes`` each.

    While Catalyst's estimate asks for one partition it is taken. Else the estimate is not trusted (joins
    multiply it, scans know compressed sizes): the rows' bytes are summed.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if _estimate(df) <= SMALL_BUCKET_BYTES:
        return 1
    return _from_bytes(df.agg(F.sum(row_bytes(df.schema))).first()[0] or 0, cores, bucket_bytes)


def plan(df: DataFrame, keys: Sequence[str], n: int | None = None, least: int = 1,
         bucket_bytes: int | None = None) -> tuple[int, list[int] | None]:
    """(partitions, split points of the first key's prefix), from one aggregate; the points are None where
    Spark's own exchange is to be used. ``n`` fixes the count; else it follows from the measured bytes:
    about ``bucket_bytes`` each, and ``least`` partitions at least."""
    if n == 1 or (n is None and least == 1 and _estimate(df) <= SMALL_BUCKET_BYTES):
        return 1, None
    kind = order_prefix(F.col(f"`{keys[0]}`"), df.schema[keys[0]].dataType) if keys[0] in df.columns else None
    if kind is None:
        return n or max(least, measured_partitions(df, bucket_bytes)), None
    prefix, exact = kind
    k = min(MOST_K, max(LEAST_K, 32 * (n or 1000)))
    sketch = F.kll_sketch_agg_bigint(prefix, F.lit(k))
    if n is not None:
        rows, points = df.agg(F.count(F.lit(1)).alias("rows"), sketch.alias("s")).select(
            "rows", F.when(F.col("rows") > 0, F.kll_sketch_get_quantile_bigint("s", _ranks(n)))).first()
    else:
        rows, total, merged = df.agg(F.count(F.lit(1)), F.sum(row_bytes(df.schema)), sketch).first()
        n = max(least, _from_bytes(total or 0, df.sparkSession.sparkContext.defaultParallelism, bucket_bytes))
        if n > 1 and rows:                   # one row, evaluated on the driver
            points = df.sparkSession.sql("select 1").select(
                F.kll_sketch_get_quantile_bigint(F.lit(bytes(merged)), _ranks(n))).first()[0]
    if n == 1 or not rows:
        return n, None
    single = len(keys) == 1 and (exact or isinstance(df.schema[keys[0]].dataType, T.LongType))
    if len(set(points)) < len(points) and not single:
        return n, None
    return n, sorted({int(x) for x in points})


def _ranks(n: int) -> Column:
    """The ``n - 1`` inner ranks, as one constant."""
    return F.split(F.lit(",".join(str(i / n) for i in range(1, n))), ",").cast("array<double>")


def partition_of(prefix: Column, points: list[int]) -> Column:
    """How many of the ascending ``points`` are at or below ``prefix``; the points are one constant of the plan."""
    bounds = F.split(F.lit(",".join(map(str, points))), ",").cast("array<bigint>")
    # the steps halve: a step is taken while the point at its end is at or below the prefix
    width = 1 << len(points).bit_length() - 1 if points else 0
    steps = F.lit([width >> i for i in range(width.bit_length())])

    def step(at, by):
        return F.when(F.get(bounds, at + by - 1) <= prefix, at + by).otherwise(at)      # NULL beyond the end

    return F.aggregate(steps, F.lit(0), step) if points else F.lit(0)


def exchange(df: DataFrame, keys: Sequence, n: int, points: list[int] | None) -> DataFrame:
    """``df`` in ``n`` partitions that hold ascending key ranges; ``points`` as ``plan`` gave them."""
    if points is None:
        return df.repartitionByRange(n, *keys)
    prefix, _ = order_prefix(F.col(f"`{keys[0]}`"), df.schema[keys[0]].dataType)
    return df.withColumn(_P, partition_of(prefix, points)).repartitionById(n, F.col(_P)).drop(_P)


def written_tasks(df: DataFrame, n: int) -> int:
    """How many tasks should write the ``n`` partitions of ``df``'s exchange: all, but for tables so small that
    files would hold next to nothing. A task that writes several partitions keeps their numbers."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return min(n, max(2 * cores, -(-_estimate(df) // TASK_BYTES)))
