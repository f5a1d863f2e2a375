"""Benchmark decontamination with suffix arrays over the training shards.

A shard is one slice of an Arrow batch of training documents. Its suffix array
holds the suffixes that can match at all: runs of words that occur in the
benchmark, at least as long as the shortest window. Every benchmark suffix is
binary-searched in each shard, one word deeper per step, which gives its longest
verbatim match and the places of it. The places of windows (``window``
consecutive words of an item, or a whole shorter item) mark the words hit.

The benchmark is a stated query set: it is collected in blocks of at most
``block_bytes`` text bytes, each block is broadcast and searched against all
documents, and beyond one block the documents pass through a written table
between blocks. Documents are never shuffled, so hot sources, copies and ids
have no effect on the balance of tasks.

Defined results: a null or wordless document has no words and no hits; an item
without words has no windows; items with equal texts are all named; repeated
item ids count once and a null item id reads as the empty text; an empty
benchmark leaves everything clean; extra columns pass through.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches, materialize, unused

WINDOW = 10
BLOCK_BYTES = 32 << 20
#: ASCII bytes: digits and letters (lower-cased) stay, the rest divides words; bytes from 0x80 on are word bytes
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
              for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """ASCII-lower-cased runs of letters, digits and non-ASCII characters."""
    return [] if text is None else text.encode().translate(_FOLD).split()


class TestSet:
    """One block of benchmark items as word numbers: all suffixes, and the distinct windows."""

    __test__ = False

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        split = [(name, w) for name, text in items if (w := words_of(text))]
        self.vocab = {w: i + 1 for i, w in enumerate(sorted({w for _, ws in split for w in ws}))}
        self.names = [name for name, _ in split]
        rows = [[self.vocab[w] for w in ws] for _, ws in split]
        self.sizes = np.array([len(r) for r in rows], np.int64)
        self.depth = int(self.sizes.max(initial=0))
        self.words = np.array([w for r in rows for w in [*r, 0]], np.int32)
        ends = np.cumsum(self.sizes + 1) - 1
        starts = ends - self.sizes
        self.at = np.concatenate([np.arange(s, e) for s, e in zip(starts, ends)] or [np.empty(0, np.int64)])
        self.item = np.repeat(np.arange(len(rows)), self.sizes)
        self.offset = self.at - np.repeat(starts, self.sizes)
        self.left = np.repeat(self.sizes, self.sizes) - self.offset        # words from here to the item's end
        need = np.minimum(self.sizes, window)[self.item]
        self.need = np.where(self.left >= need, need, 0)                  # a window starts here, of so many words
        self.shortest = int(np.minimum(self.sizes, window).min(initial=window))


class Shard:
    """Suffix array over the parts of a word sequence that can match: runs of known words (> 0)."""

    def __init__(self, words: np.ndarray, shortest: int, depth: int):
        known = np.flatnonzero(words > 0)
        cut = np.flatnonzero(np.diff(known) > 1) + 1
        starts, ends = np.append(0, cut), np.append(cut, len(known))
        sizes = ends - starts if len(known) else np.empty(0, np.int64)
        keep = np.repeat(sizes >= shortest, sizes) if len(known) else np.empty(0, bool)
        pos = known[keep]
        # the kept runs, with one 0 after each and enough behind the last
        gap = np.append(np.diff(pos) > 1, True) if len(pos) else np.empty(0, bool)
        where = np.arange(len(pos)) + np.cumsum(np.append(0, gap[:-1])) if len(pos) else pos
        self.text = np.zeros((int(where[-1]) + 2 if len(pos) else 1), np.int32)
        self.text[where] = words[pos]
        self.source = np.zeros(len(self.text), np.int64)
        self.source[where] = pos
        rank = self.text.astype(np.int64)
        h = 1
        while h < depth and len(pos):
            both = rank * (int(rank.max()) + 1)
            both[:-h] += rank[h:]
            both[self.text == 0] = 0
            values, rank = np.unique(both, return_inverse=True)
            h *= 2
        self.order = where[np.argsort(rank[where], kind="stable")] if len(pos) else np.empty(0, np.int64)

    def narrow(self, lo, hi, t, word):
        """The parts of the ranges [lo, hi) of the suffix array whose suffixes have ``word`` at place ``t``."""

        def bound(above):
            a, b = lo.copy(), hi.copy()
            while (open_ := a < b).any():
                mid = (a + b) // 2
                at = self.order[np.minimum(mid, len(self.order) - 1)] + t
                w = self.text[np.minimum(at, len(self.text) - 1)]
                less = w <= word if above else w < word
                a, b = np.where(open_ & less, mid + 1, a), np.where(open_ & ~less, mid, b)
            return a

        return bound(False), bound(True)


def search(shard: Shard, test: TestSet) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every suffix of the test set against one shard.

    Returns the longest match of each suffix in words, and the range of rows of
    the suffix array that start with its window (empty if that does not occur).
    """
    n = len(test.at)
    length, wfirst, wlast = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    live = np.arange(n)
    lo, hi = np.zeros(n, np.int64), np.full(n, len(shard.order), np.int64)
    t = 0
    while len(live) and len(shard.order):
        more = test.left[live] > t
        live, lo, hi = live[more], lo[more], hi[more]
        lo, hi = shard.narrow(lo, hi, t, test.words[test.at[live] + t])
        some = lo < hi
        live, lo, hi = live[some], lo[some], hi[some]
        t += 1
        length[live] = t
        full = test.need[live] == t
        wfirst[live[full]], wlast[live[full]] = lo[full], hi[full]
    return length, wfirst, wlast


def _spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges [first, last): the number of its range and the row, for every row in any."""
    sizes = last - first
    which = np.repeat(np.arange(len(sizes)), sizes)
    return which, np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[which]


def _numbered(texts: list, test: TestSet) -> tuple[np.ndarray, np.ndarray]:
    """All words of ``texts`` as numbers of the test set's vocabulary (0: not in it), a 0 after each
    text; and each text's number of words."""
    get, parts, sizes = test.vocab.get, [], []
    for t in texts:
        w = words_of(t)
        sizes.append(len(w))
        parts.append(np.fromiter(map(get, w, repeat(0)), np.int32, len(w)))
        parts.append(np.zeros(1, np.int32))
    return np.concatenate(parts) if parts else np.zeros(0, np.int32), np.array(sizes, np.int64)


def scan(texts: list, test: TestSet) -> list[list]:
    """One shard of texts: words, hit ranges (flat starts and ends, in words), items, and the longest
    match as (words, item, place in item, place in text)."""
    words, sizes = _numbered(texts, test)
    begins = np.cumsum(sizes + 1) - sizes - 1
    shard = Shard(words, test.shortest, test.depth)
    _, wfirst, wlast = search(shard, test)
    marks = np.zeros(len(words) + 1, np.int32)
    items: dict[int, set[str]] = defaultdict(set)
    q = np.flatnonzero(wlast > wfirst)
    # several items may share a window: its places are marked once
    _, same = np.unique(wfirst[q] * (len(shard.order) + 1) + wlast[q], return_inverse=True)
    one = np.full(same.max(initial=-1) + 1, -1)
    one[same] = q
    named = defaultdict(set)
    for k, i in zip(same.tolist(), test.item[q].tolist()):
        named[k].add(test.names[i])
    which, row = _spread(wfirst[one], wlast[one])
    place = shard.source[shard.order[row]]
    np.add.at(marks, place, 1)
    np.add.at(marks, place + test.need[one][which], -1)
    doc = np.searchsorted(begins, place, "right") - 1
    for pair in np.unique(doc * max(1, len(one)) + which).tolist():
        items[pair // max(1, len(one))] |= named[pair % max(1, len(one))]
    hit = np.cumsum(marks[:-1]) > 0
    edge = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False]))))
    starts, ends = edge[::2], edge[1::2]
    of = np.searchsorted(begins, starts, "right") - 1
    ranges: dict[int, list[list[int]]] = defaultdict(lambda: [[], []])
    for d, s, e in zip(of.tolist(), (starts - begins[of]).tolist(), (ends - begins[of]).tolist()):
        ranges[d][0].append(s)
        ranges[d][1].append(e)
    size = _extended(words, place, test, one[which])
    at = np.lexsort((place, -size, doc))
    at = at[np.concatenate(([True], doc[at[1:]] != doc[at[:-1]]))] if len(at) else at
    longest = {d: (k, test.names[test.item[x]], int(test.offset[x]), p) for d, k, x, p in
               zip(doc[at].tolist(), size[at].tolist(), one[which[at]].tolist(), (place - begins[doc])[at].tolist())}
    n = len(texts)
    empty = ([], [])
    return [sizes.tolist(), [ranges[d][0] if d in ranges else empty[0] for d in range(n)],
            [ranges[d][1] if d in ranges else empty[1] for d in range(n)],
            [sorted(items[d]) if d in items else [] for d in range(n)],
            [longest.get(d) for d in range(n)]]


def _extended(words: np.ndarray, place: np.ndarray, test: TestSet, q: np.ndarray) -> np.ndarray:
    """Words that suffix ``q`` and the text from ``place`` share, from their common window on."""
    size = test.need[q]
    live = np.arange(len(q))
    while len(live):
        k = size[live]
        more = (test.left[q[live]] > k) & (words[place[live] + k] == test.words[test.at[q[live]] + k])
        live = live[more]
        size[live] += 1
    return size


_MATCH = T.StructType([T.StructField("words", T.LongType()), T.StructField("item_id", T.StringType()),
                       T.StructField("item_at", T.LongType()), T.StructField("text_at", T.LongType())])
_FIELDS = [("n_words", T.LongType()), ("hit_starts", T.ArrayType(T.LongType())),
           ("hit_ends", T.ArrayType(T.LongType())), ("items", T.ArrayType(T.StringType())), ("longest", _MATCH)]


def blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple]]:
    """The items in lists of at most ``block_bytes`` text bytes (or one item), one list at a time."""
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col)).toLocalIterator()
    block, size = [], 0
    for name, text in rows:
        k = 64 + len(text.encode()) if text else 64
        if block and size + k > block_bytes:
            yield block
            block, size = [], 0
        block.append((name, text))
        size += k
    yield block


def find_matches(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                 item_text_col: str = "text", window: int = WINDOW,
                 block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` plus, under unused names (second result: field -> column):

    ``n_words``; ``hit_starts``/``hit_ends`` (word ranges inside any window's
    occurrence, ascending, disjoint); ``items`` (ids, ascending); ``longest``
    (of the verbatim matches that cover a window's occurrence the longest:
    words, item_id, its place in the item and in the text; null without one).
    """
    spark = docs.sparkSession
    names = {n: unused(docs, n) for n, _ in _FIELDS}
    fields = [(names[n], t) for n, t in _FIELDS]
    done = None
    for block in blocks(benchmark, item_id_col, item_text_col, block_bytes):
        shared = spark.sparkContext.broadcast(block)

        def make(shared=shared):
            test = TestSet(shared.value, window)
            return lambda texts: [[_as_match(m) for m in col] if i == 4 else col
                                  for i, col in enumerate(scan(texts, test))]

        if done is None:
            done = map_batches(docs, text_col, make, fields)
        else:       # the earlier blocks' result is written once, so their search is not run again
            done = materialize(done, "decontam-blocks")
            new = [(unused(done, n), t) for n, t in _FIELDS]
            done = _merged(map_batches(done, text_col, make, new), names, [n for n, _ in new])
    return done, names


def _as_match(m):
    return None if m is None else dict(zip(("words", "item_id", "item_at", "text_at"), m))


def _merged(df: DataFrame, names: dict[str, str], new: list[str]) -> DataFrame:
    """Results of one more block merged into the earlier ones, row by row."""
    old = [F.col(names[n]) for n, _ in _FIELDS]
    add = [F.col(n) for n in new]
    spans = F.array_sort(F.concat(F.arrays_zip(old[1].alias("s"), old[2].alias("e")),
                                  F.arrays_zip(add[1].alias("s"), add[2].alias("e"))))
    empty = F.array().cast("array<struct<s:bigint,e:bigint>>")

    def step(acc, x):
        s, e = x.getField("s"), x.getField("e")
        top = F.element_at(acc, -1)
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1),
                          F.array(F.struct(top["s"].alias("s"), F.greatest(top["e"], e).alias("e"))))
        single = F.array(F.struct(s.alias("s"), e.alias("e")))
        return F.when(F.size(acc) == 0, single).when(top["e"] >= s, joined).otherwise(F.concat(acc, single))

    merged = F.aggregate(spans, empty, step)
    longer = F.when(old[4].isNull() | (add[4]["words"] > old[4]["words"]), F.coalesce(add[4], old[4])) \
        .otherwise(old[4])
    out = {names["hit_starts"]: F.transform(merged, lambda x: x["s"]),
           names["hit_ends"]: F.transform(merged, lambda x: x["e"]),
           names["items"]: F.array_sort(F.array_union(old[3], add[3])), names["longest"]: longer}
    return df.withColumns(out).drop(*new)


def n_hit(starts, ends):
    """Words inside the ranges."""
    return F.aggregate(F.zip_with(starts, ends, lambda s, e: e - s), F.lit(0).cast("long"), lambda a, x: a + x)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` without the documents that hold a window of any item."""
    found, names = find_matches(docs, benchmark, text_col, item_id_col, item_text_col, window)
    return found.where(F.size(names["items"]) == 0).select(*docs.columns)
