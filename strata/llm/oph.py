"""Document fingerprints: one-permutation MinHash of word shingles, densified, a few bits a bin.

Every distinct shingle of ``WIDTH`` words is hashed once to 64 bits: the leading bits name its bin, the rest
compete for the bin's minimum. An empty bin takes the minimum of another one, drawn by a hash of (bin, attempt) until
an occupied bin is met (optimal densification: every occupied bin is equally likely, in each empty bin anew).
The fingerprint packs the ``BITS`` low-order bits of all ``BINS`` minima, as hex. Two bins of different
shingles agree by chance with probability 2^-BITS, so the likeness of two fingerprints is
(share of equal bins - 2^-BITS) / (1 - 2^-BITS), held to 0..1: an estimate of the shingle sets' Jaccard similarity with a
standard error of about sqrt(J (1 - J) / BINS).

``fingerprints`` is a map over documents. ``edited_neighbours`` also compares each document with the next by
ascending id and with a text edited by it. There whole texts move once, through one range exchange on the
id; inside a partition a row's successor is the next row. A partition's last row is completed from the first row
of the next partition that has rows (after the last: the first): two rows per partition, joined by partition number.

Defined results: words are parted by the six ASCII white space characters, A-Z lower-cased; a text of fewer
than ``WIDTH`` words is one shingle; a text without words, or null, has the empty fingerprint, which is like another
empty one (1) and like no other (0). Null ids come first; rows of one id follow by a hash of their text,
equal rows in any order (they give equal results); in a table of one row, that row is its own
successor; an empty table gives no rows; extra columns of ``edited_neighbours``'s input are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import default_partitions, materialize
from .common import annotate, slices

WIDTH = 5
BINS = 512
BITS = 4
SEED = 17
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
PROBES = 64              # attempts drawn at a time


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    x = x + _M1
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The 64-bit hash of every shingle (repeats included)."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    w = np.fromiter((digest(x, SEED) for x in words), np.uint64, len(words))
    k = min(width, len(w))
    h = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        h = _mix(h ^ w[i:len(w) - k + 1 + i])
    return h


@lru_cache(maxsize=64)
def _probes(bins: int, attempt: int) -> np.ndarray:
    """(bins, PROBES): where each empty bin looks at attempts ``attempt`` and following."""
    i = np.arange(bins, dtype=np.uint64)[:, None] << np.uint64(32)
    return (_mix(i + np.arange(attempt, attempt + PROBES, dtype=np.uint64)[None, :]) % np.uint64(bins)).astype(np.int64)


def minima(hashes: np.ndarray, bins: int = BINS) -> np.ndarray:
    """The densified minimum of each bin; ``bins`` is a power of two, ``hashes`` is not empty."""
    shift = np.uint64(64 - (bins.bit_length() - 1))
    ranked = np.sort(hashes)
    at = (ranked >> shift).astype(np.int64) if bins > 1 else np.zeros(len(ranked), np.int64)
    lead = np.concatenate(([True], at[1:] != at[:-1]))
    out = np.zeros(bins, np.uint64)
    full = np.zeros(bins, bool)
    out[at[lead]], full[at[lead]] = ranked[lead], True
    empty, attempt = np.flatnonzero(~full), 0
    while len(empty):
        looked = _probes(bins, attempt)[empty]
        hit = full[looked]
        found = hit.any(1)
        out[empty[found]] = out[looked[found, hit[found].argmax(1)]]
        empty, attempt = empty[~found], attempt + PROBES
    return out


def packed(values: np.ndarray, bits: int = BITS) -> bytes:
    """The low-order ``bits`` of every value, in bin order."""
    at = np.arange(bits - 1, -1, -1, dtype=np.uint64)
    return np.packbits(((values[:, None] >> at) & np.uint64(1)).astype(np.uint8)).tobytes()


def fingerprint(text: str | None, width: int = WIDTH, bins: int = BINS, bits: int = BITS) -> bytes:
    """The fingerprint of one text; empty without words."""
    hashes = shingle_hashes(text, width)
    return packed(minima(hashes, bins), bits) if len(hashes) else b""


def likeness(a: bytes, b: bytes, bits: int = BITS) -> float:
    """The estimated Jaccard similarity of two fingerprints of the same ``bits``, chance agreements taken off."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    x, y = (np.unpackbits(np.frombuffer(f, np.uint8)).reshape(-1, bits) for f in (a, b))
    chance = 2.0 ** -bits
    share = float((x == y).all(1).mean())
    return min(1.0, max(0.0, (share - chance) / (1 - chance)))


def _check(bins: int, bits: int) -> None:
    if bins < 8 or bins & (bins - 1) or not 1 <= bits <= 32:
        raise ValueError("bins is a power of two from 8, bits 1 to 32")


def fingerprints(docs: DataFrame, text_col: str = "text", width: int = WIDTH, bins: int = BINS, bits: int = BITS,
                 out: str = "fingerprint") -> tuple[DataFrame, str]:
    """``docs`` plus the fingerprint of ``text_col``; the new column's name. No shuffle."""
    _check(bins, bits)

    def make():
        return lambda texts: [[fingerprint(t, width, bins, bits).hex() for t in texts]]

    found, names = annotate(docs, text_col, make, [(out, T.StringType())])
    return found, names[0]


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


FIELDS = [("n_chars", T.LongType()), ("edited_sha256", T.BinaryType()), ("fingerprint", T.BinaryType()),
          ("edited_fingerprint", T.BinaryType()), ("near_edited", T.DoubleType()), ("near_next", T.DoubleType())]
#: of partitions: number, is this its first or last row, and that row's text
EDGE = [("part", T.IntegerType()), ("is_first", T.BooleanType()), ("is_last", T.BooleanType()),
        ("text", T.StringType())]


def _compared(text: str, fp: str, following: str, next_fp: str, make, bits: int) -> tuple:
    new = edited(text, following)
    new_fp = fp if new == text else make(new)
    return (len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).digest(), fp, new_fp,
            likeness(fp, new_fp, bits), likeness(fp, next_fp, bits))


def edited_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                      bins: int = BINS, bits: int = BITS, partitions: int | None = None) -> DataFrame:
    """(id, ``FIELDS``, digests and fingerprints as hex): each document's fingerprint, that of its text edited by the
    next document, and likenesses."""
    _check(bins, bits)
    n = partitions or default_partitions(docs.sparkSession)
    id_type = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # equal rows are dealt apart by a number drawn per row, so that copies of one row fill no partition
    tie = [F.xxhash64("text").alias("h"), F.rand(SEED).alias("r")]
    order = ["id", "h", "r"]
    ordered = rows.select("*", *tie).repartitionByRange(n, *order).sortWithinPartitions(*order).select("id", "text")
    schema = T.StructType([T.StructField("id", id_type), *(T.StructField(f, t) for f, t in [*FIELDS, *EDGE])])
    arrow = _arrow_schema(schema)

    def make(text):
        return fingerprint(text, width, bins, bits)

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        held = None                              # (id, text, fingerprint, is_first) of the row before
        for whole in batches:
            for b in slices(whole, 1):
                out = []
                for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    fp = make(text)
                    if held is not None:
                        was, before, its, first = held
                        out.append((was, *_compared(before, its, text, fp, make, bits), part, first, False,
                                    before if first else None))
                    held = (key, text, fp, held is None)
                yield _batch(out, arrow)
        if held is not None:
            key, text, fp, first = held
            yield _batch([(key, len(text), None, fp, None, None, None, part, first, True, text)], arrow)

    found = materialize(ordered.mapInArrow(run, schema), "edited-neighbours")
    # one first and one last row per partition; the next partition with rows follows, after the last the first
    w = Window.orderBy("part")
    firsts = found.where("is_first").select("part", F.col("text").alias("following"), F.col("fingerprint").alias("fp"))
    parts = firsts.select("part").withColumn("follower", F.coalesce(F.lead("part").over(w),
                                                                    F.first("part").over(w)))
    lasts = found.where("is_last").select("id", "text", "fingerprint", "part").join(parts, "part").join(
        firsts.withColumnRenamed("part", "follower"), "follower")

    def complete(batches):
        for whole in batches:
            for b in slices(whole, 1):
                yield _batch([(key, *_compared(text, fp, following, its, make, bits)) for key, text, fp, following, its
                              in zip(*(c.to_pylist() for c in b.columns))], pa.schema(list(arrow)[:7]))

    done = lasts.select("id", "text", "fingerprint", "following", "fp").mapInArrow(
        complete, T.StructType(schema.fields[:7]))
    whole = found.where("not is_last").select(*done.columns).unionByName(done)
    return whole.select(F.col("id").alias(id_col), *(F.lower(F.hex(f)).alias(f) if isinstance(t, T.BinaryType)
                                                     else F.col(f) for f, t in FIELDS))


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
