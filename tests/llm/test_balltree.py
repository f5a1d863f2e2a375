import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import balltree as B

SCHEMA = "vec_id long, embedding array<float>, score int, dim string"


def plain(rows, k, is_query):
    ok = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v, *_ in rows
          if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, a in {(i, tuple(v)) for i, v in ok if is_query(i)}:
        found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q and len(a) == len(b))
        out |= {(q, r, i, -s) for r, (s, i) in enumerate(found[:k], 1)}
    return out


def rows_of(rng, n, dim, spread):
    centres = rng.normal(size=(5, dim))
    return [(i, [float(np.float32(x)) for x in centres[i % 5] * spread + rng.normal(size=dim) * 0.1], 0, "x")
            for i in range(n)]


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_equals_plain(spark, spread, monkeypatch):
    rng = np.random.default_rng(4)
    rows = rows_of(rng, 600, 8, spread)
    same = rows[3][1]
    rows += [(1000 + i, same, 0, None) for i in range(200)]                     # one very common vector
    df = spark.createDataFrame(rows, SCHEMA)
    got = B.top_k(df, F.col("vec_id") % 50 == 0, 5, shard_bytes=8 * 8 * 150, block_bytes=8 * 8 * 4)
    assert {tuple(r) for r in got.collect()} == plain(rows, 5, lambda i: i % 50 == 0)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1, "a"), (50, [1.0, 2.0], 1, "a"), (50, [1.0, 2.0], 1, "a"), (3, None, None, None),
            (4, [], None, None), (5, [nan, 1.0], None, None), (6, [inf, 1.0], None, None), (7, [None, 1.0], None, None),
            (None, [5.0, 5.0], None, None), (8, [1.0, 2.0, 3.0], None, None), (100, [3.0], None, None),
            (9, [-0.001, 0.001], None, None), (10, [1e30, 1.0], None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {tuple(r) for r in B.top_k(df, F.col("vec_id") % 50 == 0, 5).collect()}
    assert {g[:3] for g in got if g[0] == 0} == {(0, 1, 10), (0, 2, 50), (0, 3, 50), (0, 4, 9)}
    assert max(s for *_, s in got) == (1 << 63) - 1                             # saturates
    assert {g for g in got if g[0] == 0 and g[2] != 10} == {(0, 2, 50, 256 * 256 * 5), (0, 3, 50, 256 * 256 * 5),
                                                            (0, 4, 9, -256)}
    assert {g[:3] for g in got if g[0] == 50} == {(50, 1, 10), (50, 2, 0), (50, 3, 9)}
    assert not any(g[0] == 100 for g in got)
    low = spark.createDataFrame([(0, [1e30], 0, ""), (1, [-1e30], 0, ""), (2, [-1e29], 0, "")], SCHEMA)
    assert {tuple(r) for r in B.top_k(low, F.col("vec_id") == 0, 5).collect()} == {(0, 1, 1, -(1 << 63)),
                                                                                 (0, 2, 2, -(1 << 63))}
    assert B.top_k(df.limit(0), F.col("vec_id") % 50 == 0, 5).collect() == []
    assert B.top_k(df, F.lit(False), 5).collect() == []


def test_search_prunes_and_stays_exact():
    rng = np.random.default_rng(1)
    points = np.floor(256 * (rng.normal(size=(20, 16))[rng.integers(0, 20, 4000)] + rng.normal(size=(4000, 16)) * 0.02))
    tree = B.BallTree.loads(B.BallTree(points.astype(np.int64), np.arange(4000)).dumps())
    q = points[::400].astype(np.int64)
    ids = np.arange(0, 4000, 400)
    best = B.search(tree, q, ids, 5, np.full(len(q), np.iinfo(np.int64).min))
    all_scores = q @ points.astype(np.int64).T
    for r, i in enumerate(ids):
        want = sorted((-int(s), j) for j, s in enumerate(all_scores[r]) if j != i)[:5]
        assert list(zip((-best.score[r]).tolist(), best.id[r].tolist())) == want
    # the shared bound leaves out whole subtrees
    floor = best.score[:, -1].copy()
    seen = []
    real = B._scores
    B._scores = lambda a, b: seen.append(len(a) * len(b)) or real(a, b)
    try:
        again = B.search(tree, q, ids, 5, floor)
    finally:
        B._scores = real
    assert (again.score == best.score).all() and (again.id == best.id).all()
    assert sum(seen) < 0.5 * len(q) * 4000


def test_copies_and_hot_ids_are_spread(spark, monkeypatch):
    rows = [(1, [1.0, 2.0])] * 3000 + [(2, [float(i), 1.0]) for i in range(500)] + [(i, [0.5, 0.25]) for i in range(3, 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    dealt, trees, blocks = [], B._trees, B._blocks

    def watched_trees(points, size):
        dealt.append(points.groupBy("id", "v").count().agg(F.max("count")).first()[0])
        return trees(points, size)

    def watched_blocks(queries, size):
        out = blocks(queries, 1000)
        dealt.append(out.where("id = 2").select("block").distinct().count())
        return out

    monkeypatch.setattr(B, "_trees", watched_trees)
    monkeypatch.setattr(B, "_blocks", watched_blocks)
    got = B.top_k(df, F.col("vec_id") == 3, k=5).collect()
    # 256 * 0.5 * 256 * 499 and so on: the last vectors of id 2 score highest
    assert [(r.id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [
        (2, 128 * 256 * x + 64 * 256) for x in (499, 498, 497, 496, 495)]
    got = B.top_k(df.where("vec_id <> 2"), F.col("vec_id") == 3, k=4).collect()
    assert [r.id for r in sorted(got, key=lambda r: r["rank"])] == [1] * 4
    B.top_k(df, F.col("vec_id") == 2, k=5)
    assert max(dealt[0::2]) <= 5 and dealt[-1] > 1


def test_pairs_out_of_reach_are_dropped_and_a_common_vector_is_cut(spark, monkeypatch):
    rng = np.random.default_rng(7)
    # far groups of different directions, a third of all rows one vector, and a second length
    groups = [[40.0 * (j == g) for j in range(8)] for g in range(8)]
    rows = [(i, [float(x) for x in groups[i % 8] + rng.normal(size=8) * 0.05], 0, "x") for i in range(1600)]
    rows += [(10_000 + i, [-1.0] * 8, 0, "x") for i in range(800)]      # nearest to itself, so its queries reach few shards
    rows += [(20_001 + i, [float(x) for x in rng.normal(size=3)], 0, "x") for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    seen = {}
    trees, reach = B._trees, B._within_reach

    def watched_trees(points, size):
        out = seen["trees"] = trees(points, size)
        return out

    def watched_reach(roots, queries):
        out = reach(roots, queries)
        seen["all"] = roots.join(queries.select("dim", "block").distinct(), "dim").count()
        seen["kept"] = out.count()
        return out

    monkeypatch.setattr(B, "_trees", watched_trees)
    monkeypatch.setattr(B, "_within_reach", watched_reach)
    got = B.top_k(df, F.col("vec_id") % 50 == 0, 5, shard_bytes=8 * 8 * 60, block_bytes=8 * 8 * 8, sample_rows=1000)
    assert {tuple(r) for r in got.collect()} == plain(rows, 5, lambda i: i % 50 == 0)
    assert 0 < seen["kept"] < 0.5 * seen["all"]
    sizes = [len(B.BallTree.loads(bytes(r.tree)).ids) for r in seen["trees"].collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 100      # 60 rows, as the hash deals them


def test_cells_number_near_rows_alike():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(8, 5)) * 100
    sample = centres[rng.integers(0, 8, 400)] + rng.normal(size=(400, 5))
    cells = B.Cells(sample, 8)
    of_centre = cells.of(centres)
    assert (cells.of(centres + 0.5) == of_centre).all() and len(set(of_centre)) >= 4
    assert cells.of(sample).min() >= 0 and cells.of(sample).max() < 8
    one = B.Cells(np.ones((5, 3)), 4)                         # equal rows: one cell
    assert len(one.centres) == 1 and set(one.of(np.ones((4, 3)))) == {0}
