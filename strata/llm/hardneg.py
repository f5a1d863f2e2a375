"""Hard negatives by Kronecker-packed inner products.

Components are biased to be non-negative, and those of several candidates are put side by side, as
fields, into one wide integer. Multiplying such a word by an anchor's biased component multiplies all its
fields at once; summed over the components, each field holds the biased inner product of one candidate, as no
field can overflow into the next. Taking the biases off again gives the exact scores:

    sum (c + B)(a + A) = sum ca + A sum c + B sum a + dAB

The field width follows from the two blocks at hand. While two fields or more fit into 53 bits, words are carried as
doubles (whole numbers up to 2^53 are exact, and the product is one matrix product); else as Python integers
of any length, ``WIDE_FIELDS`` fields each.

Candidates and anchors are dealt into blocks of bounded bytes by a hash of id and vector. A (candidate
block, anchor block) pair is one group, and every pair is worked: the anchors are a stated query set against all rows. The
first pass finds each anchor's best rows of its own label (only rows of anchors' labels are multiplied), the second
each positive's best rows of other labels whose score lies between ``low`` and ``high`` hundredths of the
positive's score. Each group returns only its best, and those are ranked over all blocks.

Defined results: rows with a null id or label, a null vector or a null or non-finite component take no
part; vectors of different lengths are never compared, empty vectors score 0 with each other; a row's own id is no
candidate; repeated rows are candidates as often as they occur, repeated anchors are answered once for each distinct
(label, vector); ties go to the smaller id; a positive without fitting negatives, and an anchor without positives,
have no rows; components and scores beyond 64 bits saturate; extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

BLOCK_BYTES = 2 << 20            # of candidates, as 8-byte components
ANCHOR_BYTES = 4 << 20
STEP = 256                       # anchors whose scores a task holds at a time
EXACT_BITS = 53                  # whole numbers that a double holds
WIDE_FIELDS = 64
LOW, HIGH = -(1 << 63), (1 << 63) - 1


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as long; null for a null vector or one with an odd component."""
    x = vector.cast("array<double>")
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(x.isNotNull() & ~odd, F.transform(x, lambda v: F.floor(v * scale).cast("long")))


def pack(candidates: np.ndarray, bias: int, width: int, fields: int, dtype) -> np.ndarray:
    """(words, components): ``fields`` candidates, biased, in each word; the last word may have empty fields."""
    n, d = candidates.shape
    words = -(-n // fields)
    biased = np.zeros((words * fields, d), object if dtype is object else np.int64)
    biased[:n] = candidates
    biased[:n] += bias
    packed = np.zeros((words, d), biased.dtype)
    for f in range(fields):
        packed += biased[f::fields] << (f * width) if dtype is not object else biased[f::fields] * (1 << f * width)
    return packed.astype(dtype)


def unpack(words: np.ndarray, width: int, fields: int, n: int) -> np.ndarray:
    """(n, anchors): the fields of (words, anchors)."""
    whole = words if words.dtype == object else words.astype(np.int64)
    mask = (1 << width) - 1
    out = np.empty((len(words) * fields, words.shape[1]), whole.dtype)
    for f in range(fields):
        out[f::fields] = (whole >> (f * width)) & mask
    return out[:n]


def products(candidates: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """(candidates, anchors): exact inner products of two int64 matrices, saturated to 64 bits."""
    n, d = candidates.shape
    if not n or not len(anchors) or not d:
        return np.zeros((n, len(anchors)), np.int64)
    cb, ab = -int(candidates.min()), -int(anchors.min())
    c_most, a_most = int(candidates.max()) + cb, int(anchors.max()) + ab
    width = max(1, (d * c_most * a_most).bit_length())
    fields, dtype = EXACT_BITS // width, np.float64
    # also what the biases add must fit into a machine word
    if fields < 2 or d * (abs(cb) + c_most) * (abs(ab) + a_most) >= 1 << 61:
        fields, dtype = WIDE_FIELDS, object
    packed = pack(candidates, cb, width, fields, dtype)
    a = anchors.astype(object) if dtype is object else anchors
    biased = (a + ab).astype(dtype)
    fields_of = unpack(packed @ biased.T, width, fields, n)
    c_sum = candidates.astype(object).sum(1) if dtype is object else candidates.sum(1)
    scores = fields_of - (ab * c_sum)[:, None] - (cb * a.sum(1))[None, :] - d * cb * ab
    return scores if dtype is not object else np.clip(scores, LOW, HIGH).astype(np.int64)


def band(score: int, low: int, high: int) -> tuple[int, int]:
    """Scores s with low * score <= 100 * s <= high * score: from, to."""
    return -(-low * score // 100), high * score // 100


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Row numbers of the ``k`` highest scores, ties to the smaller id."""
    if len(scores) > k:
        rows = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        rows = np.arange(len(scores))
    return rows[np.lexsort((ids[rows], ~scores[rows]))[:k]]        # ~x falls as x rises, without overflow


def block_positives(block: dict, anchors: dict, k: int) -> list[tuple]:
    """(anchor number, id, score): the ``k`` best rows of a block for each anchor, of its label and another id."""
    out = []
    for label in np.intersect1d(block["label"], anchors["label"]):
        rows, same = np.flatnonzero(block["label"] == label), np.flatnonzero(anchors["label"] == label)
        ids, points = block["id"][rows], block["v"][rows]
        for cols in (same[at:at + STEP] for at in range(0, len(same), STEP)):
            scores = products(points, anchors["v"][cols])
            for j, col in enumerate(cols):
                others = np.flatnonzero(ids != anchors["id"][col])
                mine = scores[others, j]
                out += [(col, ids[others[r]], mine[r]) for r in _best(mine, ids[others], k)]
    return out


def block_negatives(block: dict, anchors: dict, positives: list, k: int, low: int, high: int) -> list[tuple]:
    """(anchor number, positive number, id, score): the ``k`` best rows of other labels within the positive's band."""
    out = []
    for col, of_anchor in enumerate(positives):
        if col % STEP == 0:
            scores = products(block["v"], anchors["v"][col:col + STEP])
        bands = [band(int(s), low, high) for s in of_anchor]
        bands = [(i, lo, hi) for i, (lo, hi) in enumerate(bands) if lo <= hi]
        if not bands:
            continue
        s = scores[:, col % STEP]
        fit = (s >= min(b[1] for b in bands)) & (s <= max(b[2] for b in bands))
        rows = np.flatnonzero(fit & (block["label"] != anchors["label"][col]) & (block["id"] != anchors["id"][col]))
        for i, lo, hi in bands:
            inside = rows[(s[rows] >= lo) & (s[rows] <= hi)]
            out += [(col, i, block["id"][inside[r]], s[inside[r]])
                    for r in _best(s[inside], block["id"][inside], k)]
    return out


def _matrix(pdf: pd.DataFrame) -> dict:
    return {"id": pdf["id"].to_numpy(np.int64), "label": pdf["label"].to_numpy(np.int64),
            "v": np.stack(pdf["v"].to_numpy()).astype(np.int64)}


def _dealt(rows: DataFrame, name: str, limit: int) -> DataFrame:
    """``rows`` with a block number of their length: blocks of about ``limit`` bytes, by a hash of id, label and vector."""
    sizes = rows.groupBy("dim").agg(F.count("*").alias("n"))
    sizes = sizes.select(F.col("dim").alias("d"), F.greatest(
        F.lit(1), F.ceil(F.col("n") * F.greatest("dim", F.lit(1)) * 8 / limit)).cast("int").alias("blocks"))
    return rows.join(sizes, rows["dim"] == sizes["d"]).select(
        *rows.columns, F.pmod(F.xxhash64("id", "label", "v", "copy"), F.col("blocks")).cast("int").alias(name))


def _each_pair(blocks: DataFrame, anchors: DataFrame, pairs: DataFrame, run, schema: str) -> DataFrame:
    keys = ["dim", "block", "part"]
    return blocks.join(pairs, ["dim", "block"]).groupBy(*keys).cogroup(
        anchors.join(pairs, ["dim", "part"]).groupBy(*keys)).applyInPandas(run, schema)


def mine(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
         label_col: str = "label", positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         scale: int = 256, block_bytes: int = BLOCK_BYTES, anchor_bytes: int = ANCHOR_BYTES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor and each of its
    ``positives`` best rows of its label, the first ``negatives`` rows of another label whose score is
    at least ``low`` and at most ``high`` hundredths of the positive's."""
    if not 0 <= low <= high:
        raise ValueError("low and high are hundredths with 0 <= low <= high")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                          quantised(F.col(vector_col), scale).alias("v"),
                          F.coalesce(is_anchor, F.lit(False)).alias("a"))
    rows = rows.where("id is not null and label is not null and v is not null")
    # identical rows are counted as one; no more copies than are asked for can be among the best
    rows = rows.groupBy("id", "label", "v").agg(F.max("a").alias("a"), F.count("*").alias("n"))
    rows = materialize(rows.withColumn("dim", F.size("v")), "hard-negative-rows")
    most = max(positives, negatives)
    copies = rows.select("id", "label", "v", "dim", F.explode(
        F.sequence(F.lit(1), F.least("n", F.lit(most)).cast("int"))).alias("copy"))
    blocks = materialize(_dealt(copies, "block", block_bytes).select("id", "label", "v", "dim", "block"),
                         "hard-negative-blocks")
    anchors = rows.where("a").select("id", "label", "v", "dim", F.lit(0).alias("copy"))
    anchors = materialize(_dealt(anchors, "part", anchor_bytes).select(
        "id", "label", "v", "dim", "part", F.xxhash64("label", "v").alias("version")), "anchors")
    # every (block, part) pair of one vector length is a group; the pairs come from key columns alone
    pairs = materialize(blocks.select("dim", "block").distinct().join(
        anchors.select("dim", "part").distinct(), "dim"), "block-pairs")

    def find_positives(block: pd.DataFrame, some: pd.DataFrame) -> pd.DataFrame:
        found = block_positives(_matrix(block), _matrix(some), positives) if len(block) and len(some) else []
        at, ids, scores = (np.array(x, np.int64) for x in (zip(*found) if found else ([], [], [])))
        return pd.DataFrame({"id": some["id"].to_numpy()[at], "version": some["version"].to_numpy()[at],
                             "positive_id": ids, "positive_score": scores})

    schema = "id long, version long, positive_id long, positive_score long"
    best = Window.partitionBy("id", "version").orderBy(F.col("positive_score").desc(), "positive_id")
    chosen = _each_pair(blocks, anchors, pairs, find_positives, schema).withColumn(
        "place", F.row_number().over(best)).where(F.col("place") <= positives)
    lists = chosen.groupBy("id", "version").agg(F.sort_array(F.collect_list(
        F.struct("place", "positive_id", "positive_score"))).alias("positives"))      # ``positives`` rows at most
    asked = materialize(anchors.join(lists, ["id", "version"]), "anchors-with-positives")

    def find_negatives(block: pd.DataFrame, some: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(block) and len(some):
            found = block_negatives(_matrix(block), _matrix(some),
                                    [[p["positive_score"] for p in ps] for ps in some["positives"]],
                                    negatives, low, high)
        at, which, ids, scores = (np.array(x, np.int64) for x in (zip(*found) if found else ([], [], [], [])))
        chosen = [some["positives"].iloc[i][j] for i, j in zip(at, which)]
        return pd.DataFrame({
            "anchor_id": some["id"].to_numpy()[at], "version": some["version"].to_numpy()[at],
            "place": np.array([p["place"] for p in chosen], np.int32),
            "positive_id": np.array([p["positive_id"] for p in chosen], np.int64),
            "positive_score": np.array([p["positive_score"] for p in chosen], np.int64),
            "negative_id": ids, "negative_score": scores})

    schema = ("anchor_id long, version long, place int, positive_id long, positive_score long, negative_id long, "
              "negative_score long")
    first = Window.partitionBy("anchor_id", "version", "place").orderBy(F.col("negative_score").desc(), "negative_id")
    ranked = _each_pair(blocks, asked, pairs, find_negatives, schema).withColumn("rank", F.row_number().over(first))
    return ranked.where(F.col("rank") <= negatives).select("anchor_id", "positive_id", "rank", "negative_id",
                                                           "positive_score", "negative_score")
