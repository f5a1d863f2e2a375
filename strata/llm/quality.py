"""Compression classifier of text quality.

Two zstandard dictionaries are built from labelled texts, one from the good and
one from the bad. A text is compressed in blocks against both; the difference
of the sizes, divided by the text's bytes, is its evidence, and a logistic
curve fitted on other labelled rows turns that into a score from 0 to 1. The
blocks cover the whole text; their size keeps the dictionaries, not the text
itself, the main source of matches.

Bounds of the fit (parameters): ``sample_rows`` rows of each label, chosen by
a hash of their key, give one piece of ``DICTIONARY_BYTES / sample_rows``
bytes each to the dictionary; ``calibration_rows`` further rows of each label are scored whole on the
executors, and only (evidence, label) pairs reach the driver.

Defined results: null and empty texts have evidence 0; without rows of both
labels every score is 0.5; labels other than 0 and 1 teach nothing; repeated rows
are scored alike; extra columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import annotate, bounded_sample, held_out, join_small, materialize

DICTIONARY_BYTES = 400 << 10
BLOCK = 128
LEVEL = 4
SAMPLE_ROWS = 1000
CALIBRATION_ROWS = 1500
#: part of the labelled rows, by hash of the key, that calibrates instead of building dictionaries
CALIBRATION_SHARE = 0.3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    slope: float
    offset: float

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * evidence + self.offset, -500, 500)))


class Evidence:
    """Bytes saved by the good dictionary over the bad one, per byte of text."""

    def __init__(self, good: bytes, bad: bytes):
        import zstandard as z

        def compressor(content):
            if len(content) < 8:
                return z.ZstdCompressor(level=LEVEL, write_content_size=False)
            d = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            return z.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False)

        self.good, self.bad = compressor(good), compressor(bad)

    def __call__(self, text: str | None) -> float:
        if not text:
            return 0.0
        raw = text.encode()
        good, bad, saved = self.good.compress, self.bad.compress, 0
        for at in range(0, len(raw), BLOCK):
            block = raw[at:at + BLOCK]
            saved += len(bad(block)) - len(good(block))
        return saved / len(raw)


def _fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Weighted logistic regression on one feature by Newton steps, slightly damped."""
    scale = float(np.abs(x).max(initial=0)) or 1.0
    a = np.stack([x / scale, np.ones_like(x)], 1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (weight * (y - p)) - 1e-3 * w
        hess = (a * (weight * p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def _evidence_of(df: DataFrame, text_col: str, good: bytes, bad: bytes) -> tuple[DataFrame, str]:
    shared = df.sparkSession.sparkContext.broadcast((good, bad))

    def make():
        of = Evidence(*shared.value)
        return lambda texts: [[of(t) for t in texts]]

    out, (name,) = annotate(df, text_col, make, [("evidence", T.DoubleType())])
    return out, name


def train(labelled: DataFrame, text_col: str = "text", label_col: str = "label", key_col: str = "key",
          sample_rows: int = SAMPLE_ROWS, calibration_rows: int = CALIBRATION_ROWS,
          counts: dict[int, int] | None = None) -> Model:
    """Fit on rows with a text, a label (1 good, 0 bad) and a key that the samples are chosen by.

    ``counts``: rows of each label where they come from, if ``labelled`` is itself a sample.
    """
    rows = labelled.select(F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label"),
                           F.col(key_col).alias("key")).where("text is not null and label in (0, 1)")
    counts = counts or _counts(rows)
    if set(counts) != {0, 1}:
        return Model(b"", b"", 0.0, 0.0)
    share = F.pmod(F.xxhash64(F.lit("calibrate"), "key"), F.lit(1000)) < int(1000 * CALIBRATION_SHARE)
    # one piece of each text, as long as its share of the dictionary, from a place that the key's hash picks
    per = F.lit(max(64, DICTIONARY_BYTES // max(1, sample_rows)))
    at = F.pmod(F.xxhash64("key"), F.greatest(F.lit(1), F.length("text") - per + 1)).cast("int") + 1
    pieces = bounded_sample(rows.where(~share).select("label", "key", F.substring("text", at, per).alias("piece")),
                            F.col("label"), F.col("key"), sample_rows)
    got = sorted((r["label"], r["piece"]) for r in pieces.select("label", "piece").collect())
    good, bad = (("\n".join(p for k, p in got if k == label)).encode()[-DICTIONARY_BYTES:] for label in (1, 0))
    few = bounded_sample(rows.where(share), F.col("label"), F.col("key"), calibration_rows)
    scored, name = _evidence_of(few, "text", good, bad)
    pairs = np.array([(r[0], r[1]) for r in scored.select(name, "label").collect()], float).reshape(-1, 2)
    if len(set(pairs[:, 1])) < 2:
        return Model(good, bad, 0.0, 0.0)
    x, y = pairs[:, 0], pairs[:, 1]
    # the sample holds as many rows of either label; weights restore the share that each has
    weight = np.where(y == 1, counts[1] / (y == 1).sum(), counts[0] / (y == 0).sum())
    slope, offset = _fit_curve(x, y, weight * len(y) / weight.sum())
    return Model(good, bad, slope, offset)


def _counts(rows: DataFrame) -> dict[int, int]:
    return {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}


def train_on_labels(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "quality", keep_out: Column | None = None) -> Model:
    """Join ``labels`` to ``docs`` by id (held-out ids excluded) and fit.

    Rows that can be chosen are found on ids and labels alone, so only chosen
    texts meet a shuffle: at most a few thousand rows.
    """
    out = held_out(F.col(id_col)) if keep_out is None else keep_out
    ids = labels.where(~out & F.col(label_col).isin(0, 1)).groupBy(id_col).agg(F.max(label_col).alias("label"))
    known = docs.where(F.col(text_col).isNotNull()).select(id_col).distinct().join(ids, id_col)
    # a margin over the two samples, as either half is chosen by hash
    most = 4 * max(SAMPLE_ROWS, CALIBRATION_ROWS)
    chosen = bounded_sample(known, F.col("label"), F.col(id_col), most)
    rows = join_small(docs.select(F.col(id_col), F.col(text_col).alias("text")), chosen, [id_col])
    # one row of each chosen id, however often it is repeated
    rows = rows.groupBy(id_col, "label").agg(F.min("text").alias("text"))
    return train(materialize(rows.select(F.col(id_col).alias("key"), "text", "label"), "quality-sample"), counts=_counts(known))


def score(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.3) -> tuple[DataFrame, list[str]]:
    """``docs`` plus (score, predicted), under names that no column has; second result: those names."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value
        of = Evidence(m.good, m.bad)

        def run(texts):
            s = m.score(np.array([of(t) for t in texts], float))
            return [s.tolist(), [int(v >= threshold) for v in s]]
        return run

    return annotate(docs, text_col, make, [("score", T.DoubleType()), ("predicted", T.IntegerType())])


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` whose score reaches ``threshold``."""
    out, (_, predicted) = score(docs, model, text_col, threshold)
    return out.where(F.col(predicted) == 1).select(*docs.columns)
