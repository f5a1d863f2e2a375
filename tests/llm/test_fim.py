"""Fill-in-middle: the Arrow pipeline against plain slicing, and exact round trips."""

import hashlib
import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import fim

LONG = "é<é\n b" * 3000


def units(text, unit):
    if unit == "char":
        return list(text)
    if unit == "line":
        return text.splitlines(keepends=True) if "\r" not in text else re.findall(r"[^\n]*\n|[^\n]+", text)
    return re.findall(r"[^ \t-\r]+[ \t-\r]*|[ \t-\r]+", text)


def plain(key, text, unit="char", rate=90, spm_rate=20, seed=1):
    x = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(x[i:i + 8], 16) for i in range(0, 32, 8)]
    text = text or ""
    u = units(text, unit)
    n = len(u)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(s in text for s in fim.SENTINELS) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    pre, mid, suf = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if h[3] % 100 < spm_rate:
        return n, "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}"


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aé<>PSM 🤦\n\t‍漢"), max_size=40), max_size=8),
       st.sampled_from(fim.UNITS), st.sampled_from([3, 17, 1 << 20]), st.integers(0, 1 << 30))
def test_batches_match_plain_slicing(texts, unit, limit, base):
    keys = [base + i for i in range(len(texts))]
    digests = [hashlib.sha256(f"1:{k}".encode()).hexdigest() for k in keys]
    h = [pa.array([int(x[8 * i:8 * i + 8], 16) for x in digests], pa.int64()) for i in range(4)]
    got = fim.rearranged(pa.array(texts, pa.string()), h, unit, limit=limit)
    if unit != "line":          # "\x0b" and such are no line ends
        assert list(zip(*(c.to_pylist() for c in got))) == [plain(k, t, unit) for k, t in zip(keys, texts)]
    assert fim.restored(got[4], got[1]).to_pylist() == texts


ROWS = [(1, "one two three", 0), (2, "", 0), (3, None, 0), (4, "has <S> inside", 0), (5, LONG, 1), (5, LONG, 1),
        (None, "no key", 2), (6, "<", 3), (7, "<P", 3), (8, "é" * 50, 3)] + [(i, f"text {i} " * 9, 9) for i in range(20, 60)]


@pytest.mark.parametrize("unit", fim.UNITS)
def test_frame(spark, unit):
    df = spark.createDataFrame([(k, t, x, "kept") for k, t, x in ROWS], "doc_id long, text string, n int, form string")
    out, at = fim.rearrange(df, unit=unit, block_bytes=1000)
    assert out.columns[:4] == df.columns and at["n"] != "n" and at["form"] != "form"
    back, text = fim.restore(out, at["output"], at["form"])
    rows = back.collect()
    want = sorted((str(k), *map(str, plain(k, t, unit))) for k, t, _ in ROWS)
    assert sorted((str(r.doc_id), *(str(r[at[f]]) for f, _ in fim.FIELDS)) for r in rows) == want
    assert all(r[text] == (r["text"] or "") and r["n"] in (0, 1, 2, 3, 9) and r["form"] == "kept" for r in rows)


def test_empty_table_and_rates(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert fim.rearrange(empty)[0].count() == 0
    df = spark.createDataFrame([(i, f"text {i}") for i in range(200)], "doc_id long, text string")
    out, at = fim.rearrange(df, rate=100, spm_rate=100, seed=5)
    assert {r[at["form"]] for r in out.collect()} == {"spm"}
    out, at = fim.rearrange(df, rate=0)
    assert {r[at["form"]] for r in out.collect()} == {"plain"}
    with pytest.raises(ValueError, match="unit"):
        fim.rearrange(df, unit="page")
    with pytest.raises(ValueError, match="sentinels"):
        fim.rearrange(df, sentinels=("<P>", "<P>", "<M>"))
