"""Hard negatives: packed products against plain ones, mining against brute force."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import hardneg as H


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 40), st.integers(0, 20), st.integers(0, 9), st.sampled_from([1, 90, 1 << 12, 1 << 29, 1 << 61]),
       st.integers(0, 99))
def test_products_are_exact(n, m, d, most, seed):
    rng = np.random.default_rng(seed)
    c, a = rng.integers(-most, most + 1, (n, d)), rng.integers(-most // 2 - 1, most, (m, d))
    want = np.clip(c.astype(object) @ a.astype(object).T if d else np.zeros((n, m), object), H.LOW, H.HIGH)
    got = H.products(c, a)
    assert got.dtype == np.int64 and got.shape == (n, m) and (got == want).all()


def test_several_fields_share_a_word():
    c = np.arange(-30, 30).reshape(12, 5)
    words = H.pack(c, 30, 20, 2, np.float64)
    assert words.shape == (6, 5)
    assert (H.unpack(words, 20, 2, 12) == c + 30).all()


def brute(rows, positives=5, negatives=3, low=50, high=95):
    rows = [(i, tuple(int(np.floor(256 * x)) for x in v), y) for i, v, y in rows
            if i is not None and y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, v, y in {r for r in rows if r[0] % 50 == 0}:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, z) for j, w, z in rows if j != i and len(w) == len(v))
        for s, j, _ in [r for r in scored if r[2] == y][:positives]:
            fit = [(t, k) for t, k, z in scored if z != y and low * -s <= 100 * -t <= high * -s]
            out += [(i, j, r + 1, k, -s, -t) for r, (t, k) in enumerate(fit[:negatives])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("rank", F.lit("x"))


@pytest.mark.parametrize("block", [200, 4000, 2 << 20])
def test_mining_matches_brute_force(spark, block):
    rng = np.random.default_rng(5)
    base = rng.normal(0, .2, (6, 8))
    rows = [(int(i), [float(x) for x in np.float32(base[i % 6] + rng.normal(0, .08, 8))], int(i % 4)) for i in range(300)]
    rows += [(300 + i, rows[0][1], 1) for i in range(100)]                       # a third of all rows is one vector
    rows += [rows[7]] * 9 + [rows[50]] * 3                                      # repeated rows, one of them an anchor
    rows += [(50, rows[3][1], 2), (400, None, 1), (401, rows[2][1], None), (None, rows[2][1], 1),
             (402, [float("nan")] * 8, 1), (403, [None] * 8, 1), (450, [0.5, 0.25], 0), (451, [0.5, 0.2], 0),
             (452, [0.4, 0.25], 1), (500, [], 0), (501, [], 0), (502, [], 3), (550, [3e30] * 8, 2), (553, [2e30] * 8, 2),
             (554, [1e30] * 8, 1)]
    got = sorted(tuple(r) for r in H.mine(frame(spark, rows), F.col("vec_id") % 50 == 0, block_bytes=block,
                                          anchor_bytes=block).collect())
    big = [r for r in got if r[0] in (550,)]
    assert got and [r for r in got if r not in big] == [r for r in brute(rows) if r[0] != 550]
    assert all(r[4] <= H.HIGH for r in big)


def test_empty_table(spark):
    assert H.mine(frame(spark, []), F.col("vec_id") % 50 == 0).count() == 0
    assert H.mine(frame(spark, [(1, [0.5], 0)]), F.col("vec_id") % 50 == 0).count() == 0
