"""Exact top-k inner-product search with a ball tree per shard.

Identical rows are first counted as one, of which no more than k copies can be among the k best.
Vectors get a cell of space, that of the nearest of some centres fitted on a bounded sample; centres are
numbered along a chain of nearest neighbours. A length has about as many cells as shards (up to ``CELLS``), and
a shard lies in one cell; blocks of queries are runs of cells. Both are of bounded bytes: a
larger cell (one very common vector, say) is cut by a hash of id and vector. A shard is built once into a ball tree and written, with its root ball. Queries are a stated set.

Search is branch and bound in two passes over the written trees. Each query first searches one shard, the one with the
highest upper bound (query . centre + |query| * radius) of its root: its k-th best score there is a bound that every
other shard then starts from. Root balls are then held against the queries of a block, and only the (shard, block) pairs
in which some query can still reach its bound are put together: other trees are never moved. A pair is one group, which expands,
for each query, the nodes whose upper bound reaches the current k-th score, and visits leaves in order of falling bound.
Scores are exact integers; bounds are widened by their rounding error, and a node that
ties the k-th score is visited, so ties go to the smaller id in every case. The cells only decide which
rows share a shard, never what is found.

Cells are fitted for the ``LENGTHS`` most frequent vector lengths that fill more than one shard and have at most
``MOST_COMPONENTS`` components, on ``SAMPLE_ROWS`` rows of each; vectors of other lengths are dealt by hash alone.

Defined results: vectors that are null, empty or hold a null or non-finite
component, and rows with a null id, take no part; vectors of different lengths are
never compared; a query meets every row with another id; repeated rows are
candidates as often as they occur, repeated queries are answered once for each distinct vector;
fewer candidates than k give fewer results; components and scores beyond 64
bits saturate; extra columns are ignored.
"""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SLICE_BYTES, bounded_sample, join_small, materialize

SHARD_BYTES = 8 << 20
BLOCK_BYTES = 4 << 20
ROOT_BYTES = 1 << 20             # of root centres that a task holds against a block
LEAF_ROWS = 256
SAMPLE_ROWS = 4096               # rows of one vector length that the cells are fitted on
CELLS = 256                      # of one vector length, at most
ROUNDS = 5                       # in which centres move to the mean of their rows
LENGTHS = 16
MOST_COMPONENTS = 4096
LEAST = -(1 << 63)


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as long; null unless every component is finite."""
    x = vector.cast("array<double>")
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when((F.size(x) > 0) & ~odd, F.transform(x, lambda v: F.floor(v * scale).cast("long")))


class Cells:
    """Centres of cells of space, each row belonging to the nearest one."""

    def __init__(self, sample: np.ndarray, cells: int = CELLS):
        rng = np.random.default_rng(0)
        centres = sample[:1]
        far = ((sample - centres[0]) ** 2).sum(1)
        while len(centres) < cells and far.max() > 0:           # far rows are the likelier next centres
            centres = np.vstack((centres, sample[rng.choice(len(sample), p=far / far.sum())]))
            far = np.minimum(far, ((sample - centres[-1]) ** 2).sum(1))
        self.centres = centres
        for _ in range(ROUNDS):
            cell = self.of(sample)
            n = np.bincount(cell, minlength=len(self.centres))
            sums = np.zeros_like(self.centres)
            np.add.at(sums, cell, sample)
            self.centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], self.centres)
        chain, left = [0], set(range(1, len(self.centres)))
        while left:
            rest = np.array(sorted(left))
            gaps = ((self.centres[rest] - self.centres[chain[-1]]) ** 2).sum(1)
            chain.append(int(rest[gaps.argmin()]))
            left.remove(chain[-1])
        self.centres = self.centres[chain]

    def of(self, points: np.ndarray) -> np.ndarray:
        """The cell number of each row."""
        return ((self.centres ** 2).sum(1) - 2 * (points @ self.centres.T)).argmin(1)


class BallTree:
    """A binary tree of balls over the rows of an integer matrix; leaves hold up to ``LEAF_ROWS`` rows."""

    def __init__(self, points: np.ndarray, ids: np.ndarray):
        order = np.arange(len(points))
        wide = points.astype(np.float64)
        nodes: list[list] = []           # first row, last row, left child (-1: leaf)
        centres, radii = [], []

        def add(lo, hi):
            part = wide[order[lo:hi]]
            c = part.mean(0)
            nodes.append([lo, hi, -1])
            centres.append(c)
            radii.append(float(np.sqrt(((part - c) ** 2).sum(1).max())))
            return len(nodes) - 1

        todo = [add(0, len(points))]
        while todo:
            at = todo.pop()
            lo, hi, _ = nodes[at]
            if hi - lo <= LEAF_ROWS or radii[at] == 0:
                continue
            rows = order[lo:hi]
            part = wide[rows]
            one = part[((part - centres[at]) ** 2).sum(1).argmax()]
            two = part[((part - one) ** 2).sum(1).argmax()]
            order[lo:hi] = rows[np.argsort(part @ (two - one), kind="stable")]
            mid = (lo + hi) // 2
            left = add(lo, mid)
            nodes[at][2] = left
            todo += [left, add(mid, hi)]
        self.points, self.ids = points[order], ids[order]
        self.nodes = np.array(nodes, np.int64)
        self.centres, self.radii = np.array(centres), np.array(radii)

    def dumps(self) -> bytes:
        out = io.BytesIO()
        most = int(np.abs(self.points).max(initial=0))
        kind = np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64
        np.savez(out, points=self.points.astype(kind), ids=self.ids, nodes=self.nodes, centres=self.centres,
                 radii=self.radii)
        return out.getvalue()

    @classmethod
    def loads(cls, raw: bytes) -> BallTree:
        t = cls.__new__(cls)
        with np.load(io.BytesIO(raw)) as z:
            t.points, t.ids, t.nodes = z["points"].astype(np.int64), z["ids"], z["nodes"]
            t.centres, t.radii = z["centres"], z["radii"]
        return t


def _scores(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact inner products as int64, saturated."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(points).max(initial=0)) * queries.shape[1]
    if most < 2 ** 52:
        return (queries.astype(np.float64) @ points.astype(np.float64).T).astype(np.int64)
    exact = queries.astype(object) @ points.astype(object).T
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


class _Best:
    """The k best (score, id) of each query so far."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor
        self.score = np.full((n, k), np.iinfo(np.int64).min)
        self.id = np.full((n, k), np.iinfo(np.int64).max)
        self.have = np.zeros((n, k), bool)

    def bound(self, rows: np.ndarray) -> np.ndarray:
        """What a score of each of these queries must reach to matter."""
        own = np.where(self.have[rows, -1], self.score[rows, -1], LEAST)
        return np.maximum(own, self.floor[rows])

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, ok: np.ndarray) -> None:
        s = np.concatenate((self.score[rows], np.where(ok, scores, np.iinfo(np.int64).min)), 1)
        i = np.concatenate((self.id[rows], np.broadcast_to(ids, scores.shape)), 1)
        h = np.concatenate((self.have[rows], ok), 1)
        i = np.where(h, i, np.iinfo(np.int64).max)
        at = np.lexsort((i, -s.astype(np.float64), ~h), axis=1) if np.abs(s[h]).max(initial=0) < 2 ** 52 else \
            np.array([sorted(range(s.shape[1]), key=lambda c, r=r: (not h[r, c], -int(s[r, c]), int(i[r, c])))
                      for r in range(len(s))])
        at = at[:, :self.k]
        self.score[rows] = np.take_along_axis(s, at, 1)
        self.id[rows] = np.take_along_axis(i, at, 1)
        self.have[rows] = np.take_along_axis(h, at, 1)


def _upper(queries: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """(queries, balls): what no inner product with a point of the ball exceeds, rounding included."""
    norm = np.sqrt((queries ** 2).sum(1))[:, None]
    dot = queries @ centres.T
    slack = 1e-9 * (np.abs(dot) + norm * (radii + np.sqrt((centres ** 2).sum(1)))) + 1e-6
    return np.maximum(dot + norm * radii + slack, float(LEAST))         # scores saturate there


def search(tree: BallTree, vectors: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray) -> _Best:
    """The k best rows of a shard for each query, without rows of the query's own id.

    ``floor``: a score of each query that its k-th best is known to reach;
    rows below it may be left out.
    """
    best = _Best(len(vectors), k, floor)
    wide = vectors.astype(np.float64)
    norm = np.sqrt((wide ** 2).sum(1))

    def upper(rows, node):
        c, r = tree.centres[node], tree.radii[node]
        dot = np.einsum("ij,ij->i", wide[rows], c)
        slack = 1e-9 * (np.abs(dot) + norm[rows] * (r + np.sqrt((c ** 2).sum(1)))) + 1e-6
        return np.maximum(dot + norm[rows] * r + slack, float(LEAST))

    # branch: for every query the leaves whose bound reaches the floor
    rows, node = np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
    leaf_rows, leaf_node, leaf_bound = [], [], []
    while len(rows):
        bound = upper(rows, node)
        live = bound >= floor[rows]
        rows, node, bound = rows[live], node[live], bound[live]
        left = tree.nodes[node, 2]
        leaf = left < 0
        leaf_rows.append(rows[leaf])
        leaf_node.append(node[leaf])
        leaf_bound.append(bound[leaf])
        rows, left = rows[~leaf], left[~leaf]
        node = np.concatenate((left, left + 1))        # ``add`` makes the two children in a row
        rows = np.concatenate((rows, rows))
    rows, node, bound = map(np.concatenate, (leaf_rows, leaf_node, leaf_bound))
    # bound: each query's leaves by falling upper bound, one of each query per round
    order = np.lexsort((node, -bound, rows))
    rows, node, bound = rows[order], node[order], bound[order]
    begins = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1]))) if len(rows) else rows
    ends = np.append(begins[1:], len(rows))
    at = begins.copy()
    while len(at):
        live = (at < ends)
        at, ends = at[live], ends[live]
        if not len(at):
            break
        live = bound[at] >= best.bound(rows[at])
        at, ends = at[live], ends[live]         # the rest of a dropped query's leaves is lower still
        by = np.argsort(node[at], kind="stable")
        cuts = np.flatnonzero(np.diff(node[at[by]])) + 1
        for group in np.split(at[by], cuts) if len(at) else ():
            lo, hi, _ = tree.nodes[node[group[0]]]
            q = rows[group]
            for start in range(0, int(hi - lo), 4096):      # equal points make one large leaf
                part = slice(lo + start, min(hi, lo + start + 4096))
                found = tree.ids[part]
                step = max(1, (1 << 20) // len(found))
                for some in (q[i:i + step] for i in range(0, len(q), step)):
                    scores = _scores(vectors[some], tree.points[part])
                    ok = (scores >= best.bound(some)[:, None]) & (found[None, :] != ids[some][:, None])
                    hit = ok.any(1)
                    if hit.any():
                        best.add(some[hit], scores[hit], found, ok[hit])
        at = at + 1
    return best


def _with_cells(points: DataFrame, shard_bytes: int, sample_rows: int) -> DataFrame:
    """``points`` (id, v, q, n, dim) plus ``cell``, see the module text."""
    sizes = points.groupBy("dim").agg(F.count("*").alias("n"))
    sizes = sizes.where((F.col("n") * F.col("dim") * 8 > shard_bytes) & (F.col("dim") <= MOST_COMPONENTS))
    cells = {r["dim"]: min(CELLS, -(-r["n"] * r["dim"] * 8 // shard_bytes))
             for r in sizes.orderBy(F.col("n").desc(), "dim").limit(LENGTHS).collect()}
    if not cells:
        return points.withColumn("cell", F.lit(0))
    sample = bounded_sample(points.where(F.col("dim").isin(list(cells))).select("id", "v", "dim"), F.col("dim"),
                            F.struct("id", "v"), sample_rows)

    def fit(key, pdf):
        made = Cells(np.stack(pdf["v"].to_numpy()).astype(np.float64), cells[int(key[0])])
        return pd.DataFrame({"dim": [key[0]], "centres": [made.centres.tobytes()]})

    # LENGTHS rows at most, each of CELLS * MOST_COMPONENTS doubles at most
    fitted = {}
    for r in sample.groupBy("dim").applyInPandas(fit, "dim int, centres binary").toLocalIterator():
        fitted[r["dim"]] = made = Cells.__new__(Cells)
        made.centres = np.frombuffer(r["centres"]).reshape(-1, r["dim"])
    shared = points.sparkSession.sparkContext.broadcast(fitted)

    def assign(batches):
        for b in batches:
            dims = b.column("dim").to_numpy()
            out = np.zeros(b.num_rows, np.int32)
            for dim, made in shared.value.items():
                rows = np.flatnonzero(dims == dim)
                step = max(1, SLICE_BYTES // (8 * dim))
                for some in (rows[i:i + step] for i in range(0, len(rows), step)):
                    flat = b.column("v").take(pa.array(some)).flatten().to_numpy()
                    out[some] = made.of(flat.reshape(len(some), dim).astype(np.float64))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out)], names=[*b.schema.names, "cell"])

    return points.mapInArrow(assign, T.StructType([*points.schema, T.StructField("cell", T.IntegerType())]))


def _in_cells(rows: DataFrame) -> DataFrame:
    """``rows`` plus ``in_cell``, the rows of their cell, and ``before``, those of the length's lower cells."""
    counts = rows.groupBy("dim", "cell").agg(F.count("*").alias("in_cell"))
    lower = Window.partitionBy("dim").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)    # CELLS rows
    counts = counts.withColumn("before", F.coalesce(F.sum("in_cell").over(lower), F.lit(0)))
    return join_small(rows, counts, ["dim", "cell"])


def _share() -> Column:
    """A number from 0 up to 1 by a hash of id and vector."""
    return F.pmod(F.xxhash64("id", "v"), F.lit(1 << 30)) / F.lit(float(1 << 30))


def _trees(points: DataFrame, shard_bytes: int) -> DataFrame:
    """(dim, shard, tree, centre, radius) from (id, v, dim, cell); the ball is that of the root."""

    def build(key, pdf):
        t = BallTree(np.stack(pdf["v"].to_numpy()).astype(np.int64), pdf["id"].to_numpy(np.int64))
        return pd.DataFrame({"dim": [key[0]], "shard": [key[1]], "tree": [t.dumps()], "centre": [t.centres[0]],
                             "radius": [t.radii[0]]})

    parts = F.ceil(F.col("in_cell") * F.col("dim") * 8 / shard_bytes)
    shard = F.col("cell") * F.lit(1 << 32) + F.floor(_share() * parts)
    return _in_cells(points).select("id", "v", "dim", shard.alias("shard")).groupBy("dim", "shard").applyInPandas(
        build, "dim int, shard long, tree binary, centre array<double>, radius double")


def _blocks(queries: DataFrame, block_bytes: int) -> DataFrame:
    """(id, v, dim, block): queries dealt into blocks of bounded bytes, near ones together."""
    place = F.col("before") + _share() * F.col("in_cell")
    return _in_cells(queries).select("id", "v", "dim", F.floor(place * F.col("dim") * 8 / block_bytes).alias("block"))


def _against_roots(roots: DataFrame, queries: DataFrame, run, schema: str) -> DataFrame:
    """``run(roots, queries, bounds)`` for every chunk of root balls and every block of queries of one length;
    ``bounds`` gives upper bounds of some of the queries at a time: (their numbers, (queries, balls))."""
    chunks = F.greatest(F.lit(1), F.ceil(F.col("shards") * F.col("dim") * 8 / ROOT_BYTES)).cast("int")
    sizes = roots.groupBy("dim").agg(F.count("*").alias("shards")).select("dim", chunks.alias("chunks"))
    roots = roots.join(sizes, "dim").withColumn("chunk", F.pmod(F.xxhash64("shard"), F.col("chunks")).cast("int"))
    pairs = roots.select("dim", "chunk").distinct().join(queries.select("dim", "block").distinct(), "dim")
    pairs = materialize(pairs, "root-pairs")
    keys = ["dim", "chunk", "block"]

    def meet(balls: pd.DataFrame, qs: pd.DataFrame) -> pd.DataFrame:
        def bounds():
            centres, radii = np.stack(balls["centre"].to_numpy()), balls["radius"].to_numpy(np.float64)
            wide = np.stack(qs["v"].to_numpy()).astype(np.float64)
            step = max(1, (1 << 20) // len(balls))
            for at in range(0, len(wide), step):
                yield np.arange(at, min(len(wide), at + step)), _upper(wide[at:at + step], centres, radii)

        return run(balls, qs, bounds() if len(balls) and len(qs) else ())

    return roots.select("dim", "shard", "centre", "radius", "chunk").join(pairs, ["dim", "chunk"]).groupBy(
        *keys).cogroup(queries.join(pairs, ["dim", "block"]).groupBy(*keys)).applyInPandas(meet, schema)


def _home(roots: DataFrame, queries: DataFrame) -> DataFrame:
    """(id, version, shard): the shard whose root has the highest upper bound for the query."""

    def run(balls, qs, bounds):
        best = [(row, col, up[r, col]) for rows, up in bounds for r, (row, col) in enumerate(zip(rows, up.argmax(1)))]
        row, col, bound = (np.array(x) for x in (zip(*best) if best else ((), (), ())))
        row, col = row.astype(np.int64), col.astype(np.int64)
        return pd.DataFrame({"id": qs["id"].to_numpy(np.int64)[row], "version": qs["version"].to_numpy(np.int64)[row],
                             "shard": balls["shard"].to_numpy(np.int64)[col], "bound": bound.astype(np.float64)})

    found = _against_roots(roots, queries, run, "id long, version long, shard long, bound double")
    return found.groupBy("id", "version").agg(F.max_by("shard", F.struct("bound", "shard")).alias("shard"))


def _within_reach(roots: DataFrame, queries: DataFrame) -> DataFrame:
    """(dim, shard, block) where the root's upper bound reaches the ``floor`` of some query of the block
    that has not been there (``home``)."""

    def run(balls, qs, bounds):
        floor, home = qs["floor"].to_numpy(np.int64), qs["home"].to_numpy(np.int64)
        shards, hit = balls["shard"].to_numpy(np.int64), np.zeros(len(balls), bool)
        for rows, up in bounds:
            hit |= ((up >= floor[rows][:, None]) & (home[rows][:, None] != shards)).any(0)
        shards = shards[hit]
        return pd.DataFrame({"dim": np.full(len(shards), balls["dim"].iloc[0] if len(balls) else 0, np.int32),
                             "shard": shards,
                             "block": np.full(len(shards), qs["block"].iloc[0] if len(qs) else 0, np.int64)})

    return _against_roots(roots, queries, run, "dim int, shard long, block long")


def _searched(trees: DataFrame, queries: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """(query_id, version, id, score): the best rows of each (dim, shard, block) group of ``pairs``, for the
    queries whose ``home`` is another shard."""

    def run(trees: pd.DataFrame, qs: pd.DataFrame) -> pd.DataFrame:
        if len(trees):
            qs = qs[qs["home"] != trees["shard"].iloc[0]]
        if not len(trees) or not len(qs):
            return pd.DataFrame({"query_id": [], "version": [], "id": [], "score": []}, dtype=np.int64)
        ids = qs["id"].to_numpy(np.int64)
        b = search(BallTree.loads(trees["tree"].iloc[0]), np.stack(qs["v"].to_numpy()).astype(np.int64), ids, k,
                   qs["floor"].to_numpy(np.int64))
        q, _ = np.nonzero(b.have)
        return pd.DataFrame({"query_id": ids[q], "version": qs["version"].to_numpy(np.int64)[q], "id": b.id[b.have],
                             "score": b.score[b.have]})

    keys = ["dim", "shard", "block"]
    trees = trees.join(pairs, ["dim", "shard"]).select(*keys, "tree")
    return trees.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(
        run, "query_id long, version long, id long, score long")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = 256, shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES,
          sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(query_id, rank, id, score): for each query row the ``k`` highest integer inner products of
    quantised vectors over all other rows, ties to the smaller id."""
    points = vectors.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("v"),
                            F.coalesce(is_query, F.lit(False)).alias("q")).where("id is not null and v is not null")
    points = points.groupBy("id", "v").agg(F.max("q").alias("q"), F.count("*").alias("n"))
    points = materialize(points.withColumn("dim", F.size("v")), "vectors")
    points = materialize(_with_cells(points, shard_bytes, sample_rows), "cells")
    # no more than k of a row's copies can be among the k best
    copies = points.select("id", "v", "dim", "cell", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)).cast("int"))))
    trees = materialize(_trees(copies.select("id", "v", "dim", "cell"), shard_bytes), "ball-trees")
    roots = trees.select("dim", "shard", "centre", "radius")
    queries = _blocks(points.where("q").select("id", "v", "dim", "cell"), block_bytes)
    queries = materialize(queries.withColumn("version", F.xxhash64("v")), "query-blocks")
    per_query = Window.partitionBy("query_id", "version").orderBy(F.col("score").desc(), "id")
    homes = materialize(queries.join(_home(roots, queries), ["id", "version"]), "home-shards")
    start = homes.withColumns({"floor": F.lit(LEAST), "home": F.lit(-1).cast("long")})
    pairs = materialize(homes.select("dim", "shard", "block").distinct(), "home-pairs")
    seeds = materialize(_searched(trees, start, pairs, k), "home-results")         # k rows of a query at most
    floors = seeds.groupBy(F.col("query_id").alias("id"), "version").agg(
        F.min("score").alias("floor"), F.count("*").alias("found")).where(F.col("found") == k).drop("found")
    bounded = homes.withColumnRenamed("shard", "home").join(floors, ["id", "version"], "left")
    bounded = materialize(bounded.withColumn("floor", F.coalesce("floor", F.lit(LEAST))), "query-floors")
    pairs = materialize(_within_reach(roots, bounded), "shard-blocks")
    found = seeds.unionByName(_searched(trees, bounded.join(pairs, ["dim", "block"]), pairs, k))
    best = found.withColumn("rank", F.row_number().over(per_query)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "id", "score")
