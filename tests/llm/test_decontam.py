import random

import pytest

from strata.llm import decontam as D

WORDS = ["a", "b", "c", "d", "É", "x1"]


def plain(text, items, window):
    w, hit, names = D.words_of(text), set(), set()
    for name, t in items:
        q = D.words_of(t)
        size = min(window, len(q))
        for j in range(len(q) - size + 1) if q else ():
            for p in range(len(w) - size + 1):
                if w[p:p + size] == q[j:j + size]:
                    hit |= set(range(p, p + size))
                    names.add(name)
    return len(w), sorted(hit), sorted(names)


def longest(text, items, window):
    w, best = D.words_of(text), 0
    for _, t in items:
        q = D.words_of(t)
        for j in range(len(q)):
            for p in range(len(w)):
                k = 0
                while j + k < len(q) and p + k < len(w) and q[j + k] == w[p + k]:
                    k += 1
                if k >= min(window, len(q)):
                    best = max(best, k)
    return best


@pytest.mark.parametrize("seed", range(60))
def test_scan_equals_plain(seed):
    rng = random.Random(seed)
    window = rng.choice([2, 3, 10])
    items = [(str(i), rng.choice([None, "", " ".join(rng.choices(WORDS, k=rng.randint(1, 14)))]))
             for i in range(rng.randint(0, 5))]
    docs = [rng.choice([None, "", ". ".join(rng.choices([*WORDS, "zz"], k=rng.randint(0, 40)))]) for _ in range(6)]
    if items:
        docs[0] = "zz " + (items[0][1] or "") + " zz " + (items[-1][1] or "")
    out = D.scan(docs, D.TestSet(items, window))
    for i, text in enumerate(docs):
        hit = [k for s, e in zip(out[1][i], out[2][i]) for k in range(s, e)]
        assert (out[0][i], hit, out[3][i]) == plain(text, items, window)
        m = out[4][i]
        assert (m[0] if m else 0) == longest(text, items, window)
        if m:
            q = D.words_of(dict(items)[m[1]])
            assert D.words_of(text)[m[3]:m[3] + m[0]] == q[m[2]:m[2] + m[0]]


@pytest.mark.parametrize("block_bytes", [1, 1 << 20])
def test_blocks_agree(spark, block_bytes):
    items = [(1, "one two three four"), (2, "three four five"), (2, "three four five"), (None, "six"), (4, None), (5, "")]
    docs = [(1, "ONE two, three four five", 3, "x"), (2, None, None, None), (3, "", 0, ""), (4, "nothing here", 1, "y"),
            (1, "ONE two, three four five", 3, "x"), (None, "six and one two three six", 0, None)]
    d = spark.createDataFrame(docs, "doc_id long, text string, n_words long, items string")
    b = spark.createDataFrame(items, "item_id long, text string")
    found, at = D.find_matches(d, b, window=3, block_bytes=block_bytes)
    got = sorted((str(r.doc_id), r[at["n_words"]], r[at["hit_starts"]], r[at["hit_ends"]], r[at["items"]],
                  r[at["longest"]].words if r[at["longest"]] else None) for r in found.collect())
    one = ("1", 5, [0], [5], ["1", "2"], 4)
    assert got == [one, one, ("2", 0, [], [], [], None), ("3", 0, [], [], [], None), ("4", 2, [], [], [], None),
                   ("None", 6, [0, 2], [1, 6], ["", "1"], 3)]
    clean = D.decontaminate(d, b, window=3)
    assert clean.columns == d.columns
    assert sorted(r.doc_id for r in clean.collect()) == [2, 3, 4]


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert D.decontaminate(d, b.limit(0)).count() == 1
    assert D.decontaminate(d.limit(0), b).count() == 0
    assert D.decontaminate(d, b).count() == 0


def test_long_text():
    items = [("q", " ".join(f"w{i}" for i in range(30)))]
    text = "w1 w2 " * 100_000 + items[0][1] + " w3" * 1000
    out = D.scan([text], D.TestSet(items))
    assert (out[1][0], out[2][0], out[4][0][0]) == ([200_000], [200_030], 30)
