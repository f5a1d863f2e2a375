import re

import pytest

from strata.llm import tokencount as C
from strata.llm.common import place
from strata.llm.queries import vocabulary
from strata.session import fresh_dir

SCHEMA = "doc_id long, text string, n_tokens string, digest int"
ROWS = [(1, "Hello  World", "x", 1), (2, "Hello World", None, None), (3, None, None, None), (4, "", "", 0),
        (2, "Hello World", None, None), (None, "hello world <|endoftext|> a", None, None), (5, "don't  STOP" * 3000, None, 9)]


def expected(path, rows):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    return sorted(((d, len((x or "").encode()), len(t.encode(x or "", add_special_tokens=False).ids))
                   for d, x, *_ in rows), key=str)


@pytest.mark.parametrize("drops", [True, False])
def test_counts_and_cache(spark, drops):
    path, cache = vocabulary("word_bpe_49k.json"), fresh_dir(spark, "cache")
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = sorted((tuple(r) for r in C.count_tokens(df, path, cache, drops_white_space=drops).collect()), key=str)
    assert got == expected(path, ROWS)
    _, stored = C.open_cache(spark, cache, C.version(path, drops))
    contents = {re.sub(r"\s+", " ", x or "") if drops else x or "" for _, x, *_ in ROWS}
    assert stored.select("digest").distinct().count() == len(contents)


def test_only_misses_are_encoded(spark, monkeypatch):
    path, cache = vocabulary("word_bpe_49k.json"), fresh_dir(spark, "cache")
    df = spark.createDataFrame(ROWS, SCHEMA)
    first = sorted(map(str, C.count_tokens(df, path, cache).collect()))
    seen = []
    real = C._encode
    monkeypatch.setattr(C, "_encode", lambda misses, *a: seen.append(misses.count()) or real(misses, *a))
    assert sorted(map(str, C.count_tokens(df, path, cache).collect())) == first
    more = df.unionByName(spark.createDataFrame([(9, "new text", None, None), (10, "new text", None, None)], SCHEMA))
    assert C.count_tokens(more, path, cache).count() == len(ROWS) + 2
    assert seen == [0, 1]


def test_an_append_that_ran_twice(spark):
    path, cache = vocabulary("word_bpe_49k.json"), fresh_dir(spark, "cache")
    df = spark.createDataFrame(ROWS, SCHEMA)
    want = sorted(map(str, C.count_tokens(df, path, cache).collect()))
    folder, stored = C.open_cache(spark, cache, C.version(path, False))
    spark.createDataFrame(stored.collect(), C.CACHE_SCHEMA).write.mode("append").parquet(folder)
    assert sorted(map(str, C.count_tokens(df, path, cache).collect())) == want


def test_versions_and_empty(spark):
    cache = fresh_dir(spark, "cache")
    a, b = vocabulary("word_bpe_49k.json"), vocabulary("byte_bpe_50k.json")
    assert len({C.version(a, True), C.version(a, False), C.version(b, False)}) == 3
    df = spark.createDataFrame([], SCHEMA)
    assert C.count_tokens(df, a, cache).collect() == []


def test_sentencepiece_model(spark):
    import sentencepiece
    path = vocabulary("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = {(r.doc_id, r.n_bytes): r.n_tokens for r in C.count_tokens(df, path, fresh_dir(spark, "cache")).collect()}
    assert got == {(d, len((t or "").encode())): len(sp.encode(t or "")) for d, t, *_ in ROWS}


def test_counts_by_words_equal_whole_texts(monkeypatch):
    import random

    with open(vocabulary("word_bpe_49k.json"), "rb") as f:
        whole = C.counter(f.read(), "json")
    rng = random.Random(4)
    parts = list(" \t\n\x0b\f\rsredtlvm'SLΣσς12²٣é中\u0301\u00a0\u3000😀ǅİ#$.,-_\x00\x1c\x85\u200b\u2028") + [
        "<|endoftext|>", "<|startoftext|>", "'s", "'LL", "  ", "the", "<|"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(8000)]
    folded = [re.sub("[ \t\n\x0b\f\r]+", " ", t) for t in texts]
    monkeypatch.setattr(C, "REMEMBERED", 1000)
    run = C.by_words(whole)
    got = [n for i in range(0, len(folded), 500) for n in run(folded[i:i + 500])]
    assert got == whole(texts)


@pytest.mark.parametrize("from_files", [True, False])
def test_repeated_rows_are_one_encoding(spark, from_files):
    """3,000 rows, of which 1,000 repeat one row: 2,001 contents, 2,001 cache rows."""
    path, cache = vocabulary("word_bpe_49k.json"), fresh_dir(spark, "cache")
    df = spark.range(3000).selectExpr("if(id < 1000, 0, id) AS doc_id", "concat('text ', if(id < 1000, 0, id)) AS text",
                                      "id AS extra").repartition(7)
    if from_files:
        df = C.materialize(df, "docs")
    got = C.count_tokens(df, path, cache, key=place(df))
    assert got.count() == 3000 and got.where("n_tokens IS NULL").count() == 0
    assert C.open_cache(spark, cache, C.version(path, False))[1].count() == 2001


@pytest.mark.parametrize("share", [2, 10_000])
def test_frequent_and_rare_contents(spark, monkeypatch, share):
    monkeypatch.setattr(C, "FREQUENT_SHARE", share)
    path = vocabulary("word_bpe_49k.json")
    rows = ROWS + [(7, "Hello World", None, None)] * 6
    got = C.count_tokens(spark.createDataFrame(rows, SCHEMA), path, fresh_dir(spark, "cache"), drops_white_space=True)
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(path, rows)


def test_clashing_row_keys_give_right_counts(spark):
    from pyspark.sql import functions as F

    path = vocabulary("word_bpe_49k.json")
    got = C.count_tokens(spark.createDataFrame(ROWS, SCHEMA), path, fresh_dir(spark, "cache"), key=F.lit(1).cast("long"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(path, ROWS)
