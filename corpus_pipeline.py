"""A training corpus from ``documents``: quality, language, near duplicates, benchmark leaks, tokens.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and reread as the next one's
``docs``. All but the last return the columns of ``documents``; what a stage
rejects is gone for the next. Every stage tolerates nulls, empty tables and
extra columns as its operator defines.
"""

from __future__ import annotations

import os
import sys

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import functions as F  # noqa: E402

from strata.llm import bpe, decontam, langid, quality, simhash  # noqa: E402
from strata.llm.common import place  # noqa: E402
from strata.llm.queries import vocabulary  # noqa: E402
from strata.session import materialize, ship_package  # noqa: E402
from strata.sources.tables import table  # noqa: E402


def good_quality(spark, docs, sf_dir):
    """Documents that the compression classifier accepts (score at least 0.3)."""
    ship_package(spark)
    model = quality.train_on_labels(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def known_language(spark, docs, sf_dir):
    """Documents with letters, but for those whose text contradicts their tag, if that is a learned language."""
    ship_package(spark)
    profiles = langid.train_on_documents(docs)
    found, (lang, _) = langid.predict(docs, profiles)
    # without a learned language every text is unknown, also those with letters
    letters = (F.col(lang) != langid.UNKNOWN) | F.col("text").rlike(r"\p{L}")
    contradicted = F.col("lang").isin(profiles.names) & (F.col(lang) != F.col("lang"))
    return found.where(letters & ~F.coalesce(contradicted, F.lit(False))).select(*docs.columns)


def one_of_near_duplicates(spark, docs, sf_dir):
    """The smallest id of each group of near duplicates: shingles of 3 words, at most 3 bits apart."""
    ship_package(spark)
    return simhash.deduplicate(docs, "doc_id", "text", width=3, max_bits=3, key=place(docs))


def without_benchmark(spark, docs, sf_dir):
    """Documents that hold no 10-word window of a benchmark item."""
    ship_package(spark)
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark, docs, sf_dir):
    """Per document: tokens, digest of the ids, digest of the decoded text."""
    ship_package(spark)
    out, names = bpe.round_trip(docs, vocabulary("byte_bpe_50k.json"))
    return out.select("doc_id", *(F.col(c).alias(n) for c, n in
                                  zip(names, ("n_tokens", "ids_sha256", "decoded_sha256"))))


STAGES = [
    ("quality classifier", good_quality),
    ("language ID", known_language),
    ("SimHash near-dedup", one_of_near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("BPE encoding and decoding", tokens),
]

#: compression sizes, n-gram profiles, XXH64 and merges can't be stated in SQL; tests/llm compares
#: the stages with plain versions instead
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; each stage's result is written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
