"""Element-wise vector add, copy and copy verification (V1-V5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import chunk_id
from ..session import materialize


def vector_add(dst: DataFrame, src: DataFrame, idx: str = "idx", x: str = "x", y: str = "y",
               out: str = "z") -> DataFrame:
    """V1: ``z[i] = x[i] + y[i]`` for two vectors stored as ``(idx, value)`` rows.

    Element-wise, not a reduction. Both vectors must cover the same indexes;
    a row on one side only raises (the reference requires equal lengths).
    float + float stays float, as in the reference.
    """
    d = dst.select(F.col(idx).alias("_i"), F.col(x).alias("_x"), F.lit(True).alias("_dl"))
    s = src.select(F.col(idx).alias("_i"), F.col(y).alias("_y"), F.lit(True).alias("_sl"))
    j = d.join(s, "_i", "full_outer")
    z = F.when(F.col("_dl").isNull() | F.col("_sl").isNull(),
               F.raise_error(F.lit("vector_add: vectors differ in length"))).otherwise(F.col("_x") + F.col("_y"))
    return j.select(F.col("_i").alias(idx), z.cast(j.schema["_x"].dataType).alias(out))


def array_add(a: Column | str, b: Column | str) -> Column:
    """V2: element-wise sum of two array columns; different lengths raise."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.when(F.size(a) != F.size(b),
                  F.raise_error(F.lit("array_add: arrays differ in length"))
                  ).otherwise(F.zip_with(a, b, lambda p, q: p + q))


def vector_add_chunked(dst: DataFrame, src: DataFrame, k: int, idx: str = "idx", x: str = "x",
                       y: str = "y") -> DataFrame:
    """V3: the add done by ``k`` workers over contiguous chunks; per-chunk row counts.

    Chunk sizes follow O7 (remainder to the last chunk). The count of
    elements is a scalar subquery, never a driver round trip.
    """
    z = vector_add(dst, src, idx, x, y)
    n = z.select(F.count(F.lit(1))).scalar()
    return (z.withColumn("chunk", chunk_id(F.col(idx), n, k))
             .groupBy("chunk")
             .agg(F.count(F.lit(1)).alias("n"), F.min(idx).alias("lo"), F.max(idx).alias("hi")))


def copy_table(df: DataFrame, path: str) -> DataFrame:
    """V4: write ``df`` unchanged to ``path`` (parquet) and read the copy back.

    The copy is written by all partitions in parallel and committed by the
    file committer; a lost executor only redoes its own tasks.
    """
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.parquet(path)


def copy_digest(df: DataFrame) -> DataFrame:
    """Cheap one-pass fingerprint: row count and the sum of row hashes.

    Order-insensitive and a multiset property; equal digests make equal
    tables very likely, not certain, and floats compare by bits (-0.0 differs
    from 0.0 here). ``verify_copy`` is the exact, by-value check.
    """
    h = F.xxhash64(*[F.col(c) for c in df.columns]).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(h).alias("digest"))


FANOUT = 1024                # buckets of each level of the hash tree
BROADCAST_LEAVES = 200_000


def _plain_zero(c: Column, t: T.DataType) -> Column:
    """``c`` with -0.0 as 0.0, also inside arrays and structs, so that equal values hash alike."""
    if isinstance(t, (T.FloatType, T.DoubleType)):
        return c + F.lit(0).cast(t)
    if isinstance(t, T.ArrayType):
        return F.transform(c, lambda x: _plain_zero(x, t.elementType))
    if isinstance(t, T.StructType) and t.fields:
        return F.when(c.isNotNull(), F.struct(*[_plain_zero(c[f.name], f.dataType).alias(f.name) for f in t.fields]))
    return c


def _tree_digests(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per bucket: rows of either side, and the signed sums of two hashes, which are 0 where the sides agree."""
    signed = [F.sum(F.col(h).cast("decimal(38,0)") * F.col("_d")).alias(h) for h in ("_h", "_g")]
    return rows.groupBy(*keys).agg(F.count_if(F.col("_d") > 0).alias("_ns"), F.count_if(F.col("_d") < 0).alias("_nc"),
                                   *signed)


def verify_copy(src: DataFrame, copy: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """V5: multiset equality of two tables, by value (-0.0 equals 0.0).

    A hash tree of two levels. Rows fall into ``fanout`` buckets by their hash; per bucket, counts and
    signed sums of two 64-bit hashes are compared. Only rows of buckets that differ are digested again in ``fanout``
    finer ones each, and only in those that still differ full rows are compared: one aggregate that gives each
    distinct row its copies in ``src`` less those in ``copy``, pre-aggregated in each task. Equal tables
    shuffle digests alone. Buckets that differ with equal counts and two equal hash sums (128 bits) go unseen.
    """
    cols = src.columns
    schema_equal = [(f.name, f.dataType) for f in src.schema.fields] == \
                   [(f.name, f.dataType) for f in copy.schema.fields]
    u = (src.select(*cols, F.lit(1).alias("_d"))
            .unionByName(copy.select(*cols, F.lit(-1).alias("_d"))))
    values = [_plain_zero(F.col(f"`{f.name}`"), f.dataType) for f in u.schema.fields[:-1]]
    hashed = u.withColumns({"_h": F.xxhash64(*values), "_g": F.xxhash64(F.lit("second"), *values)})
    hashed = hashed.withColumns({"_top": F.pmod("_h", F.lit(fanout)).cast("int"),
                                 "_leaf": F.pmod(F.shiftright("_h", 32), F.lit(fanout)).cast("int")})
    tops = _tree_digests(hashed.select("_top", "_d", "_h", "_g"), ["_top"]).collect()      # ``fanout`` rows at most
    differ = [r["_top"] for r in tops if r["_ns"] != r["_nc"] or r["_h"] or r["_g"]]
    n_source, n_copy = sum(r["_ns"] for r in tops), sum(r["_nc"] for r in tops)
    if differ:
        some = hashed.where(F.col("_top").isin(differ)) if len(differ) < fanout else hashed
        leaves = _tree_digests(some.select("_top", "_leaf", "_d", "_h", "_g"), ["_top", "_leaf"])
        leaves = materialize(leaves.where("_ns <> _nc or _h <> 0 or _g <> 0").select("_top", "_leaf"), "differing-leaves")
        small = F.broadcast(leaves) if leaves.count() <= BROADCAST_LEAVES else leaves
        per_row = some.join(small, ["_top", "_leaf"], "left_semi").groupBy(*cols).agg(F.sum("_d").alias("_net"))
        res = per_row.agg(
            F.coalesce(F.sum(F.greatest(F.col("_net"), F.lit(0))), F.lit(0)).cast("long").alias("missing"),
            F.coalesce(F.sum(F.greatest(-F.col("_net"), F.lit(0))), F.lit(0)).cast("long").alias("extra"))
    else:
        res = src.sparkSession.sql("select 0L as missing, 0L as extra")
    return res.select(F.lit(n_source).cast("long").alias("n_source"), F.lit(n_copy).cast("long").alias("n_copy"),
                      "missing", "extra", ((F.col("missing") == 0) & (F.col("extra") == 0) & F.lit(schema_equal))
                      .alias("equal"), F.lit(schema_equal).alias("schema_equal"))


def verify_digest(src: DataFrame, copy: DataFrame) -> DataFrame:
    """V5, cheap mode: one pass over each side, no shuffle of rows."""
    a = copy_digest(src).select(F.col("n").alias("n_source"), F.col("digest").alias("_ds"))
    b = copy_digest(copy).select(F.col("n").alias("n_copy"), F.col("digest").alias("_dc"))
    both = a.unionByName(b, allowMissingColumns=True).agg(
        F.max("n_source").alias("n_source"), F.max("n_copy").alias("n_copy"),
        F.max("_ds").alias("_ds"), F.max("_dc").alias("_dc"))
    return both.select("n_source", "n_copy",
                       ((F.col("n_source") == F.col("n_copy")) & F.col("_ds").eqNullSafe(F.col("_dc")))
                       .alias("digest_equal"))
