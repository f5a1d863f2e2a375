"""Seeded uniform numbers, so runs repeat (the reference seeds from the clock)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed value: the generator draws ints in 0..99999
INT_RANGE = 100_000


def uniform_ints(df: DataFrame, seed: int, out: str = "v") -> DataFrame:
    """One int in ``0..INT_RANGE-1`` per row of ``df``."""
    return df.withColumn(out, F.floor(F.rand(seed) * INT_RANGE).cast("int"))


def uniform_floats(df: DataFrame, seed: int, out: str = "x") -> DataFrame:
    """One float32 in ``[0, 1]`` per row of ``df``."""
    return df.withColumn(out, F.rand(seed).cast("float"))


def synthetic_vector(spark: SparkSession, n: int, seed: int, kind: str = "int") -> DataFrame:
    """``(idx, v)`` with ``n`` rows from ``spark.range`` (for tests and demos)."""
    base = spark.range(n).withColumnRenamed("id", "idx")
    return uniform_ints(base, seed) if kind == "int" else uniform_floats(base, seed, "v")
