import random

import numpy as np
import pytest

from strata.llm import bpe as B
from strata.llm.queries import vocabulary


@pytest.fixture(scope="module")
def path():
    return vocabulary("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def own(path):
    with open(path, "rb") as f:
        return B.ByteBPE(f.read())


@pytest.fixture(scope="module")
def library(path):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def same(own, library, texts):
    for t, raw, e in zip(texts, own.encode_all(texts), library.encode_batch(texts, add_special_tokens=False)):
        assert raw == np.array(e.ids, "<u4").tobytes(), t
        assert own.decode(raw) == library.decode(e.ids, skip_special_tokens=False)


def test_random_texts(own, library):
    rng = random.Random(5)
    parts = [*" \t\n\r'’sredtlvmSLab1²٣é中  　😀ǅ#$.,-_\x00\x1c\x85​", "<|endoftext|>", "'s", "'ll",
             "  ", "\n\n", "the", "<|", "aaaa"]
    same(own, library, ["".join(rng.choices(parts, k=rng.randint(0, 50))) for _ in range(8000)])


def test_long_pieces(own, library):
    same(own, library, ["a" * 3000, "ab" * 2000, " " * 900 + "é", "中文" * 500, "x'" * 300, "<|endoftext|>" * 5, "#" * 999,
                        "The quick brown fox. " * 5000])


def test_forgetting_changes_nothing(own, library, monkeypatch):
    monkeypatch.setattr(B, "REMEMBERED", 3)
    same(own, library, ["one two three four", "five six seven", "one two", ""])


def test_cuts_are_certain(own):
    tokens = own.token_bytes.tobytes()
    for i, (at, size) in enumerate(zip(own.token_at[:-1].tolist(), own.token_size[:-1].tolist())):
        t = tokens[at:at + size]
        assert not any(own.cut[a * 256 + b] for a, b in zip(t, t[1:])), i


def test_decode_odd_ids(own):
    assert own.decode(np.array([10 ** 6, 64], "<u4").tobytes()) == "a"         # unknown ids are skipped
    half = own.encode("é")[:4] if len(own.encode("é")) > 4 else np.array([127], "<u4").tobytes()
    assert isinstance(own.decode(half), str)
    assert own.decode(b"") == ""


def test_edge_rows(spark, path, library):
    rows = [(1, None, 5, "x"), (2, "", None, None), (3, "Hello, world's", 1, None), (3, "Hello, world's", 1, None),
            (None, "a\n\n b", 0, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int, n_tokens string")
    enc, ids = B.encode(df, path)
    assert enc.columns[:4] == df.columns and ids not in df.columns
    got = {(r.doc_id, r.text): list(r[ids]) for r in enc.collect()}
    assert got == {(d, t): library.encode(t or "", add_special_tokens=False).ids for d, t, _, _ in rows}
    dec, text = B.decode(enc, path, ids)
    assert all(r[text] == (r.text or "") for r in dec.collect())
    out, names = B.round_trip(df, path)
    assert out.count() == 5 and sorted(r[names[0]] for r in out.collect())[:2] == [0, 0]
    assert B.round_trip(df.limit(0), path)[0].collect() == []


def test_large_files_are_refused(spark, path):
    from strata.llm.common import broadcast_bytes
    with pytest.raises(ValueError):
        broadcast_bytes(spark, path, limit=10)
