"""Near duplicates by SimHash fingerprints and a byte-position inverted index.

Signature: ASCII-lower-cased words, shingles of ``width`` words (repeats
count), XXH64 with seed 42 of each; a fingerprint bit is 1 if it is set in over
half of the hashes.

Search: fingerprints at most ``max_bits`` bits apart share at least
``8 - max_bits`` of their 8 bytes at equal positions. Posting lists of single
bytes would hold 1/256 of all rows each, so the index posts byte positions four
at a time, for a family of position sets such that any ``8 - max_bits`` shared
positions contain one of the sets. Each posting list tallies the shared
positional bytes of its pairs, drops pairs below the guaranteed minimum, and
verifies the bit distance of the rest. A list gives the edges of a spanning
forest of its verified pairs, fewer than it has members, so the links of a
large group of near copies are never written out pair by pair, and no
connection is lost. Copies are one posting: the index holds distinct
fingerprints. A departure: in a list of more than ``PAIRWISE_ROWS`` rows partners are
looked up by flipping bits outside the list's shared bytes instead of by tallying pairs, which would grow with the square of
the list; the links are the same.

Defined results: null and wordless texts have fingerprint 0 and are linked like
any other; repeated rows each get a row; rows with a null id take part, and a
component's id is its smallest non-null id; an empty table gives an empty table;
columns beyond id and text are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import join_small, map_batches, materialize, placed, unused
from .components import connected_components

SEED = 42
BYTES = 8
CHUNK = 1 << 16          # shingle hashes held at a time for one text
PAIRWISE_ROWS = 1 << 15  # posting lists beyond this are probed by bit masks, which grows linearly


def fingerprint(text: bytes | str | None, width: int = 3) -> int:
    """The 64-bit SimHash of one text, unsigned."""
    import xxhash

    if text is None:
        return 0
    if isinstance(text, str):
        text = text.encode()
    words = text.lower().split()     # bytes: A-Z only, and the six ASCII white space characters
    n = len(words)
    if n == 0:
        return 0
    joined = b" ".join(words)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    begins = np.concatenate(([0], stops[:-1] + 1))
    k = min(width, n)
    begins, stops = begins[:n - k + 1].tolist(), stops[k - 1:].tolist()
    digest = xxhash.xxh64_digest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(begins), CHUNK):
        raw = b"".join([digest(joined[s:e], SEED) for s, e in zip(begins[at:at + CHUNK], stops[at:at + CHUNK])])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, BYTES), axis=1)
        counts += np.add.reduce(bits, axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * counts > len(begins)).tobytes(), "big")


def signatures(docs: DataFrame, text_col: str, width: int = 3, out: str = "fp") -> DataFrame:
    """``docs`` plus a signed 64-bit fingerprint column (named ``out``)."""

    def make():
        def run(texts):
            got = [fingerprint(t, width) for t in texts]
            return [[x - (1 << 64) if x >> 63 else x for x in got]]
        return run

    return map_batches(docs, text_col, make, [(out, T.LongType())])


def position_sets(max_bits: int) -> list[tuple[int, ...]]:
    """Sets of byte positions of which any ``8 - max_bits`` positions contain one.

    Up to 3 bits: the 14 four-sets of positions 0..7 whose exclusive or is 0.
    Three positions that differ fix a fourth by exclusive or; the complement of
    those four also has exclusive or 0 and lies in the five that agree.
    Beyond: all sets of ``8 - max_bits`` positions.
    """
    if not 0 <= max_bits < BYTES:
        raise ValueError("max_bits must be 0 to 7")
    if max_bits <= 3:
        return [c for c in combinations(range(BYTES), 4) if c[0] ^ c[1] ^ c[2] ^ c[3] == 0]
    return list(combinations(range(BYTES), BYTES - max_bits))


def _postings(fps: DataFrame, max_bits: int) -> DataFrame:
    """(key, fp): one row for each position set; the key holds the set's number and its bytes."""
    byte = [F.shiftrightunsigned("fp", 8 * (BYTES - 1 - i)).bitwiseAND(F.lit(255)) for i in range(BYTES)]
    keys = []
    for no, positions in enumerate(position_sets(max_bits)):
        key = F.lit(no).cast("long")
        for p in positions:
            key = F.shiftleft(key, 8).bitwiseOR(byte[p])
        keys.append(key)
    return fps.select(F.explode(F.array(*keys)).alias("key"), "fp")


def _tally(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Shared positional bytes of each pair."""
    return (a.view(np.uint8).reshape(-1, BYTES) == b.view(np.uint8).reshape(-1, BYTES)).sum(1)


class _Forest:
    """Union-find over row numbers that returns the pairs that joined two trees."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def _root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def add(self, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        for _ in range(2):
            self.up = self.up[self.up]
        apart = self.up[a] != self.up[b]
        out = []
        for x, y in zip(a[apart].tolist(), b[apart].tolist()):
            rx, ry = self._root(x), self._root(y)
            if rx != ry:
                self.up[max(rx, ry)] = min(rx, ry)
                out.append((x, y))
        return out


def _pairs(fps: np.ndarray, a: np.ndarray, b: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the candidate row pairs those that pass the count filter and the distance check."""
    ok = _tally(fps[a], fps[b]) >= BYTES - max_bits
    a, b = a[ok], b[ok]
    near = np.bitwise_count(fps[a] ^ fps[b]) <= max_bits
    return a[near], b[near]


def _small_lists(keys: np.ndarray, fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Edges of all lists at once: rows 1 apart, 2 apart, ... while any still share a key."""
    forest, edges, step = _Forest(len(keys)), [], 1
    left = np.flatnonzero(keys[:-1] == keys[1:])
    while len(left):
        for at in range(0, len(left), 1 << 20):
            a = left[at:at + (1 << 20)]
            edges += forest.add(*_pairs(fps, a, a + step, max_bits))
        step += 1
        left = left[left + step < len(keys)]
        left = left[keys[left] == keys[left + step]]
    return edges


def _long_list(fps: np.ndarray, free: list[int], max_bits: int) -> list[tuple[int, int]]:
    """Edges of one long list: every row looks up each change of up to ``max_bits`` of its free
    bits among the sorted rows, so the work grows with the rows and not with their pairs."""
    order = np.argsort(fps)
    ranked, forest, edges = fps[order], _Forest(len(fps)), []
    for k in range(1, max_bits + 1):
        for bits in combinations(free, k):
            wanted = ranked ^ np.uint64(sum(1 << b for b in bits))
            at = np.minimum(np.searchsorted(ranked, wanted), len(ranked) - 1)
            a = np.flatnonzero((ranked[at] == wanted) & (ranked < wanted))
            edges += [(int(order[x]), int(order[y])) for x, y in forest.add(*_pairs(ranked, a, at[a], max_bits))]
    return edges


def _link_lists(max_bits: int):
    """Task function: Arrow batches sorted by key -> edges (a, b) between fingerprints."""
    sets = position_sets(max_bits)

    def edges_of(keys, fps):
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        sizes = np.diff(np.append(starts, len(keys)))
        out, rest = [], np.ones(len(keys), bool)
        for s, n in zip(starts[sizes > PAIRWISE_ROWS].tolist(), sizes[sizes > PAIRWISE_ROWS].tolist()):
            rest[s:s + n] = False
            used = sets[int(keys[s]) >> (8 * len(sets[0]))]
            free = [8 * (BYTES - 1 - p) + i for p in range(BYTES) if p not in used for i in range(8)]
            out += [(s + a, s + b) for a, b in _long_list(fps[s:s + n], free, max_bits)]
        many = rest & np.repeat(sizes > 1, sizes)
        rows = np.flatnonzero(many)
        out += [(int(rows[a]), int(rows[b])) for a, b in _small_lists(keys[rows], fps[rows], max_bits)]
        return out

    def run(batches):
        held_k, held_f = np.empty(0, np.int64), np.empty(0, np.uint64)

        def emit(keys, fps):
            if len(keys) > 1 and (e := edges_of(keys, fps)):
                a, b = (fps[np.array(x)].view(np.int64) for x in zip(*e))
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        for b in batches:
            if not b.num_rows:
                continue
            keys = np.concatenate((held_k, b.column(0).to_numpy(zero_copy_only=False)))
            fps = np.concatenate((held_f, b.column(1).to_numpy(zero_copy_only=False).view(np.uint64)))
            cut = int(np.searchsorted(keys, keys[-1]))      # the last list may go on
            yield from emit(keys[:cut], fps[:cut])
            held_k, held_f = keys[cut:], fps[cut:]
        yield from emit(held_k, held_f)

    return run


def link(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """Edges (a, b), a < b, that connect what is connected among distinct fingerprints ``fp``."""
    posted = _postings(fps, max_bits).repartition("key").sortWithinPartitions("key", "fp")
    return posted.mapInArrow(_link_lists(max_bits), "a long, b long").distinct()


def components(signed: DataFrame, id_col: str, max_bits: int = 3) -> DataFrame:
    """(fp, component_id, component_key) for every distinct ``fp`` of ``signed``, which has ``fp`` and
    ``id_col``. component_key names the component by a fingerprint and is never null."""
    fps = materialize(signed.groupBy("fp").agg(F.min(id_col).alias("least")), "simhash-fps")
    labels = connected_components(materialize(link(fps.select("fp"), max_bits), "simhash-edges"))
    named = fps.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
    named = named.withColumn("component_key", F.coalesce("component", "fp"))
    least = named.where(F.col("component").isNotNull()).groupBy("component_key") \
        .agg(F.min("least").alias("of_all"))
    return (named.join(least, "component_key", "left")
            .select("fp", F.coalesce("of_all", "least").alias("component_id"), "component_key"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                    max_bits: int = 3) -> DataFrame:
    """One row for each row of ``docs``: id, fingerprint (16 hex digits), component_id (the smallest
    id reachable over links of at most ``max_bits`` differing bits)."""
    signed = materialize(signatures(docs.select(F.col(id_col), F.col(text_col)), text_col, width, "fp")
                         .select(F.col(id_col).alias("id"), "fp"), "simhash-signed")
    found = signed.join(components(signed, "id", max_bits), "fp", "left")
    return found.select(F.col("id").alias(id_col),
                        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                max_bits: int = 3, key: Column | None = None) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id (nulls last), then the
    smallest text hash; of repeated rows, one.

    Decided on (id, hash, row key) alone; then the rejected rows' keys leave ``docs``: by a broadcast if
    their counted number allows, so that texts stay where they are, else by a join on the unique key.
    ``key`` is ``place(docs)`` where that holds; without it ``docs`` is written once.
    """
    docs, key = placed(docs, key, "simhash-rows")
    fp, k, h = (unused(docs, n) for n in ("_fp", "_key", "_hash"))
    names = {k: key, h: F.xxhash64(text_col)}
    signed = signatures(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                                    *(c.alias(n) for n, c in names.items())), "text", width, fp)
    signed = materialize(signed.select("id", F.col(h).alias("hash"), F.col(k).alias("key"), F.col(fp).alias("fp")),
                         "simhash-signed")
    fps = components(signed, "id", max_bits).select("fp", "component_key")
    best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "hash", "key"))
    # least row of each fingerprint, then of each component: copies are reduced before they move
    first = (signed.groupBy("fp").agg(best.alias("s")).join(fps, "fp")
             .groupBy("component_key").agg(F.min("s").alias("s")))
    keep = first.select(F.col("s.key").alias("key"), F.col("s.hash").alias("hash"))
    gone = signed.select("key", "hash").join(keep, ["key", "hash"], "left_anti") \
        .select(F.col("key").alias(k), F.col("hash").alias(h))
    # two hashes of 64 bits name a row: of its place and of its text
    return join_small(docs.withColumns(names), gone, [k, h], "left_anti").select(*docs.columns)
