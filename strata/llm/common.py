"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

#: rows are cut to about this many text bytes before a Python step holds them as objects
SLICE_BYTES = 8 << 20
#: counts of a sample's groups are broadcast up to so many groups
BROADCAST_GROUPS = 200_000


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True for rows kept out of training: crc32 of the id as text, modulo ``folds``, is 0
    (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it that no column of ``df`` has (compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_{uuid.uuid4().hex[:6]}"
    return name


def place(scanned: DataFrame) -> Column | None:
    """A long key of each row's file and number in it, for a frame that reads Parquet files and repeats
    no row (no join, no explode); None if the frame is not read from files."""
    try:
        at = scanned.metadataColumn("_metadata")
        key = F.xxhash64(at["file_path"], at["row_index"])
        scanned.select(key)
    except AnalysisException:
        return None
    return key


def placed(df: DataFrame, key: Column | None, name: str) -> tuple[DataFrame, Column]:
    """``df`` and a key of its rows: as given, or else of ``df`` written once under ``name``."""
    if key is None:
        df = materialize(df, name)
        key = place(df)
    return df, key


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES):
    """``batch`` in row ranges whose ``column`` holds about ``limit`` bytes or one row."""
    n = batch.num_rows
    if n == 0:
        return
    if batch.column(column).nbytes <= limit:
        yield batch
        return
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = size = 0
    for i, k in enumerate(sizes):
        if i > start and size + k > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += k
    yield batch.slice(start, n - start)


def map_batches(df: DataFrame, text_col: str, make: Callable[[], Callable[[list], list]],
                fields: Sequence[tuple[str, T.DataType]]) -> DataFrame:
    """All columns of ``df`` plus ``fields``, computed from ``text_col`` batch by batch.

    ``make()`` runs once in each task and returns a function from a list of
    values (str, bytes or None) to one list per field. Rows stay in their
    partition: no shuffle, and a task holds one slice of one Arrow batch.
    """
    at = df.columns.index(text_col)
    arrow_types = [_arrow(t) for _, t in fields]

    def run(batches):
        fn = make()
        for whole in batches:
            for b in slices(whole, at):
                out = fn(b.column(at).to_pylist())
                new = [pa.array(v, type=t) for v, t in zip(out, arrow_types)]
                yield pa.RecordBatch.from_arrays([*b.columns, *new], names=[*b.schema.names, *names])

    names = [n for n, _ in fields]
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, t) for n, t in fields)])
    return df.mapInArrow(run, schema)


def annotate(df: DataFrame, text_col: str, make, fields) -> tuple[DataFrame, list[str]]:
    """``map_batches`` with field names that no input column has; returns those names too."""
    named = [(unused(df, n), t) for n, t in fields]
    return map_batches(df, text_col, make, named), [n for n, _ in named]


def _arrow(t: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(t)


def bounded_sample(df: DataFrame, group: Column, key: Column, rows: int) -> DataFrame:
    """At most ``rows`` rows of each ``group`` value, those with the smallest hash of ``key``.

    The choice depends on the keys alone, not on partitions. Groups are counted
    first, and only rows whose hash lies in the share that holds about twice
    ``rows`` of them are shuffled, so a hot group sends a bounded number of rows to
    its reducer at every size. A null group is a group, and every group gives rows, however many there are.
    """
    g, h, r, k, n, u = (unused(df, x) for x in ("_g", "_h", "_r", "_k", "_n", "_u"))
    top = 1 << 40
    keyed = df.withColumns({g: group, k: key, h: F.pmod(F.xxhash64(key), F.lit(top))})
    counts = df.select(group.alias(u)).groupBy(u).agg(F.count("*").alias(n))
    counts = materialize(counts, "group-counts")
    near = keyed.join(F.broadcast(counts) if counts.count() <= BROADCAST_GROUPS else counts,
                      F.col(g).eqNullSafe(F.col(u)))
    near = near.where(F.col(h).cast("double") * F.col(n) <= F.lit(float(top)) * (2 * rows + 100))
    w = Window.partitionBy(g).orderBy(h, k)
    return near.withColumn(r, F.row_number().over(w)).where(F.col(r) <= rows).drop(g, h, r, k, n, u)


def join_small(df: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
               rows: int = 200_000) -> DataFrame:
    """``df`` joined to a table that is written first and counted: broadcast up to ``rows`` rows of it,
    so that ``df``'s texts stay where they are, and joined by a shuffle beyond."""
    small = materialize(small, "small-side")
    return df.join(F.broadcast(small) if small.count() <= rows else small, on, how)


def broadcast_bytes(spark: SparkSession, path: str, limit: int = 64 << 20):
    """A vocabulary file as a broadcast; refused beyond ``limit`` bytes."""
    import os

    if os.path.getsize(path) > limit:
        raise ValueError(f"{path} is larger than {limit} bytes")
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())
