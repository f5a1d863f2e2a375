"""Column expressions shared by the operators. All are built-in Spark functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x) -> Column:
    """Columns pass through, strings name a column, anything else is a literal."""
    if isinstance(x, Column):
        return x
    return F.col(x) if isinstance(x, str) else F.lit(x)


def chunk_id(idx, n, k) -> Column:
    """Chunk of position ``idx`` (0-based) when ``n`` rows form ``k`` chunks.

    Chunks are contiguous with size ``n div k``; the remainder goes to the
    *last* chunk (not the first ones, as ``ntile`` would do). If ``k > n``
    the size is 0 and every row lands in the last chunk.
    """
    idx, n, k = _col(idx), _col(n).cast("long"), _col(k).cast("long")
    size = F.floor(n / k).cast("long")
    return (F.when(size == 0, k - 1)
            .otherwise(F.least(F.floor(idx / size).cast("long"), k - 1))
            .cast("long"))


def cents(x) -> Column:
    """Money as integer cents: sums of integers do not depend on order."""
    return F.round(_col(x) * 100).cast("long")


_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def micros(ts) -> Column:
    """Microseconds since the epoch of a wall-clock (timestamp_ntz) column,
    read as UTC whatever the session time zone is."""
    c = _col(ts).cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), c)


def ntz_from_micros(us) -> Column:
    """The inverse of ``micros``: a timestamp_ntz, independent of the session zone."""
    return F.timestamp_add("MICROSECOND", _col(us), F.expr(_EPOCH_NTZ))
