"""Language identification by rank-order n-gram profiles.

A profile lists a language's most frequent letter n-grams (1 to 3 letters,
with one space before and after words) by rank. A document's own most frequent
n-grams are ranked the same way, and its out-of-place distance to a language is
the sum over them of how far their rank is from the profile's; an n-gram that the
profile lacks costs the profile's size. The least distance names the language,
and 1 minus that distance over the greatest possible one is the score.

Profiles are fitted on at most ``sample_rows`` rows of each language (those with
the smallest key hash), counted whole on the executors; every language is learned, and the driver and each
task hold one rank table of languages by n-grams. Documents are ranked over their whole text.

Defined results: null texts and texts without a letter are ``und`` with score 0;
so is everything if no language was learned; equal distances go to the smaller
language name, equal counts to the smaller n-gram; extra columns pass through.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import annotate, bounded_sample, held_out, join_small, slices

PROFILE = 300
SAMPLE_ROWS = 1000
UNKNOWN = "und"
_BITS = 21          # a code point


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of the 1-, 2- and 3-letter n-grams of a text, codes ascending."""
    empty = np.empty(0, np.int64)
    if not text:
        return empty, empty
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    # a space before the text, one for each run of other characters, and one after
    padded = np.concatenate(([32], np.where(letter, points, 32), [32])).astype(np.int64)
    is_letter = np.concatenate(([False], letter, [False]))
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    keep[:-1] |= is_letter[1:]
    # of two kept spaces in a row (end of one word, start of the next) one stays
    keep[1:] &= ~(keep[:-1] & ~is_letter[:-1] & ~is_letter[1:])
    s, w = padded[keep], is_letter[keep]
    if not w.any():
        return empty, empty
    two = s[:-1] << _BITS | s[1:]
    three = (two[:-1] << _BITS | s[2:])[w[1:-1]]
    codes = np.concatenate((s[w], two, three))
    codes.sort()
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    return codes[first], np.diff(np.append(first, len(codes)))


def ranked(codes: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The ``size`` most frequent codes, most frequent first."""
    return codes[np.argsort(-counts, kind="stable")[:size]]


class Profiles:
    """Profiles of all languages as one rank table."""

    def __init__(self, profiles: dict[str, list[int]], size: int = PROFILE):
        self.size = size
        self.names = sorted(profiles)
        self.codes = np.array(sorted({c for p in profiles.values() for c in p}), np.int64)
        self.rank = np.full((len(self.names), len(self.codes) + 1), -1, np.int64)    # last: in no profile
        for i, name in enumerate(self.names):
            self.rank[i, np.searchsorted(self.codes, profiles[name])] = np.arange(len(profiles[name]))

    def distances(self, top: np.ndarray) -> np.ndarray:
        """Out-of-place distance of ranked codes to each language."""
        at = np.searchsorted(self.codes, top)
        known = at < len(self.codes)
        known[known] = self.codes[at[known]] == top[known]
        rank = self.rank[:, np.where(known, at, len(self.codes))]
        return np.where(rank < 0, self.size, np.abs(rank - np.arange(len(top)))).sum(1)

    def predict(self, text: str | None) -> tuple[str, float]:
        top = ranked(*grams(text), self.size)
        if not len(top) or not self.names:
            return UNKNOWN, 0.0
        d = self.distances(top)
        best = int(np.argmin(d))
        return self.names[best], max(0.0, 1 - float(d[best]) / (len(top) * self.size))


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE) -> Profiles:
    """Profiles of the languages of ``labelled`` (null languages and texts teach nothing)."""
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")) \
        .where("lang is not null and text is not null")

    def count(batches):
        # one pass per task; what is held is the n-grams of a slice, not its texts
        for whole in batches:
            for b in slices(whole, 1):
                by: dict[str, list] = {}
                for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    by.setdefault(lang, []).append(grams(text))
                for lang, parts in by.items():
                    codes = np.concatenate([c for c, _ in parts])
                    n = np.concatenate([k for _, k in parts])
                    u, inv = np.unique(codes, return_inverse=True)
                    total = np.bincount(inv, n, len(u)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(u), pa.string()), pa.array(u),
                                                      pa.array(total)], ["lang", "code", "n"])

    counted = rows.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("lang").orderBy(F.col("n").desc(), "code")
    top = counted.withColumn("r", F.row_number().over(w)).where(F.col("r") <= size).select("lang", "r", "code").collect()
    profiles: dict[str, list[int]] = {}
    for r in sorted(top, key=lambda r: (r["lang"], r["r"])):
        profiles.setdefault(r["lang"], []).append(r["code"])
    return Profiles(profiles, size)


def train_on_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                       sample_rows: int = SAMPLE_ROWS) -> Profiles:
    """Fit on at most ``sample_rows`` documents of each language outside the held-out fold.

    They are chosen on ids and languages, each pair once; only their texts are read on, one of each.
    """
    open_ = docs.where(~held_out(F.col(id_col)) & F.col(lang_col).isNotNull()).select(id_col, lang_col).distinct()
    chosen = bounded_sample(open_, F.col(lang_col), F.col(id_col), sample_rows)
    rows = join_small(docs.select(id_col, lang_col, text_col), chosen, [id_col, lang_col], "left_semi")
    return train(rows.groupBy(id_col, lang_col).agg(F.min(text_col).alias(text_col)), text_col, lang_col)


def predict(docs: DataFrame, profiles: Profiles, text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """``docs`` plus (lang_pred, score), under names that no column has; second result: those names."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    def make():
        p = shared.value
        return lambda texts: list(map(list, zip(*(p.predict(t) for t in texts)))) or [[], []]

    return annotate(docs, text_col, make, [("lang_pred", T.StringType()), ("score", T.DoubleType())])
