"""Token counts through a digest cache.

The cache is a Parquet folder of (digest, n_tokens) for each tokenizer version.
A content's digest is the SHA-256 of its normalised text; a version's is that
of the tokenizer file, the library's version and the normalisation. Documents join the
stored counts by digest. Only distinct misses are encoded (one row stands for all copies
of a content), appended to the cache, and joined back.

A row is named by its file and its number there. The row that stands for a digest is found by a
partial minimum of those keys, so repeated rows are one miss as well, and a hot content is spread. Texts
move once, and only those of misses; every other join carries digests. The digest is taken again from the
text that is encoded, so a clash of keys costs one more encoding and never a wrong count. Counts go back to
the rows of frequent contents by a broadcast (each holds over 1/10,000 of all rows, so they are fewer
than 10,000 at every size) and to all others by a join.

Defined results: null counts as the empty text; repeated rows each get a row, as do rows
with a null id; texts of any length are encoded whole; an append that ran twice
leaves equal rows, which the reader reduces to one; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import broadcast_bytes, materialize, placed, slices

CACHE_SCHEMA = "digest binary, n_tokens long"
FREQUENT_SHARE = 10_000  # a content with over this share of all rows gets its count by broadcast


def normalised(text: Column, drops_white_space: bool) -> Column:
    """Null as empty; for tokenizers that drop white space, its ASCII runs as one space (same counts)."""
    text = F.coalesce(text, F.lit(""))
    return F.regexp_replace(text, r"[ \t\n\x0B\f\r]+", " ") if drops_white_space else text


def version(path: str, drops_white_space: bool) -> str:
    """Digest of the tokenizer file, library version and normalisation."""
    import sentencepiece
    import tokenizers

    h = hashlib.sha256(f"{tokenizers.__version__} {sentencepiece.__version__} {drops_white_space} ".encode())
    with open(path, "rb") as f:
        h.update(f.read())
    return h.hexdigest()


def counter(raw: bytes, kind: str):
    """A function from texts to token counts; ``kind``: json (tokenizers) or model (sentencepiece)."""
    if kind == "model":
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=raw)
        return lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)] if texts else []
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"      # the task's one core
    from tokenizers import Tokenizer

    t = Tokenizer.from_buffer(raw)
    t.no_padding()
    t.no_truncation()
    return lambda texts: [len(e) for e in t.encode_batch_fast(texts, add_special_tokens=False)]


REMEMBERED = 400_000     # words whose counts a task keeps


def by_words(count):
    """Counts of texts from counts of their words, for tokenizers that drop white space: no token spans it,
    so a text's count is the sum over its words, and a task encodes each distinct word once while it remembers it."""
    known: dict[str, int] = {}

    def run(texts):
        split = pc.ascii_split_whitespace(pa.array(texts, pa.string()))
        words = split.flatten().dictionary_encode()
        distinct = words.dictionary.to_pylist()
        new = [w for w in distinct if w not in known]
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = distinct
        for at in range(0, len(new), 10_000):
            known.update(zip(new[at:at + 10_000], count(new[at:at + 10_000])))
        each = np.fromiter(map(known.__getitem__, distinct), np.int64, len(distinct))
        sums = np.concatenate(([0], np.cumsum(each[words.indices.to_numpy()])))
        return np.diff(sums[split.offsets.to_numpy()]).tolist()

    return run


def _encode(misses: DataFrame, path: str, drops_white_space: bool = False) -> DataFrame:
    """(digest, n_tokens) of rows (digest, text)."""
    shared = broadcast_bytes(misses.sparkSession, path)
    kind = path.rsplit(".", 1)[-1]

    def run(batches):
        count = counter(shared.value, kind)
        count = by_words(count) if drops_white_space else count
        for whole in batches:
            for b in slices(whole, 1, (8 if drops_white_space else 1) << 20):
                got = count(b.column(1) if drops_white_space else b.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.int64())], ["digest", "n_tokens"])

    return misses.mapInArrow(run, CACHE_SCHEMA)


def open_cache(spark: SparkSession, cache: str, tokenizer_version: str) -> tuple[str, DataFrame]:
    """The folder of one version and what it holds; the folder is made if it is not there."""
    folder = f"{cache.rstrip('/')}/version={tokenizer_version}"
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(folder)
    return folder, spark.read.schema(CACHE_SCHEMA).parquet(folder)


def count_tokens(docs: DataFrame, path: str, cache: str, id_col: str = "doc_id", text_col: str = "text",
                 drops_white_space: bool = False, key: Column | None = None) -> DataFrame:
    """(id, n_bytes, n_tokens) of every row; misses are appended to ``cache``. ``key`` is ``place(docs)`` where
    that holds; without it ids and texts are written once."""
    spark = docs.sparkSession
    docs, key = placed(docs if key is not None else docs.select(id_col, text_col), key, "token-rows")
    digest = F.unhex(F.sha2(normalised(F.col(text_col), drops_white_space), 256))
    narrow = materialize(docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
        digest.alias("digest"), key.alias("key")), "token-digests")
    folder, stored = open_cache(spark, cache, version(path, drops_white_space))
    contents = materialize(narrow.groupBy("digest").agg(F.min("key").alias("key"), F.count("*").alias("n")),
                           "token-contents")
    misses = contents.join(stored, "digest", "left_anti").select("key")
    # always by a merge join: the smaller side is a share of all rows, not a bounded table
    texts = docs.select(key.alias("key"), F.col(text_col).alias("raw")) \
        .join(misses.hint("merge"), "key", "left_semi") \
        .select(normalised(F.col("raw"), drops_white_space).alias("text"))
    texts = texts.select(F.unhex(F.sha2("text", 256)).alias("digest"), "text")
    _encode(texts, path, drops_white_space).write.mode("append").parquet(folder)
    counts = spark.read.schema(CACHE_SCHEMA).parquet(folder).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    return _give_back(narrow, contents, counts).select(F.col("id").alias(id_col), "n_bytes", "n_tokens")


def _give_back(narrow: DataFrame, contents: DataFrame, counts: DataFrame) -> DataFrame:
    """``narrow`` with the count of each digest; the rows of frequent digests stay where they are."""
    rows = contents.agg(F.sum("n")).first()[0] or 0
    frequent = F.broadcast(contents.where(F.col("n") * FREQUENT_SHARE > rows).select("digest"))
    few = F.broadcast(counts.join(frequent, "digest", "left_semi"))
    return narrow.join(few, "digest").unionByName(narrow.join(frequent, "digest", "left_anti").join(counts, "digest"))
