"""Byte-level BPE encoding and decoding with forced boundaries.

A pair of neighbouring bytes that occurs inside no vocabulary token cannot be
merged over, so a cut between the two is certain. Documents are cut there,
every fragment is encoded by itself (each distinct fragment once per task while
it is remembered, all new ones of a batch together), and the ids are concatenated.

The vocabulary also splits text by a pattern before merging. A cut is used on
the document only where the pattern cannot look across it: between characters,
not after white space (a run of it is divided by what follows), and not next to an
apostrophe (contractions). Inside a piece of the pattern every forbidden
byte pair cuts again before the merges run.

Special tokens in a text are matched first, as the library does by default.
The vocabulary file is read on the driver (its size is checked) and broadcast,
so executors need no copy of it.

Defined results: null and empty texts have no tokens and decode to the empty
text; texts of any length are encoded whole; extra columns pass through.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from itertools import pairwise

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import annotate, broadcast_bytes

#: fixed value: the split pattern of byte-level vocabularies of this family
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
REMEMBERED = 400_000      # fragments kept in a task
HEAP_ABOVE = 48           # bytes; longer pieces merge through a heap
NONE = 1 << 40            # rank of a pair that no merge joins


def _letters() -> dict[str, int]:
    """The printable characters that stand for bytes in a vocabulary file: printable Latin-1 bytes
    stand for themselves, the others for the code points from 256 on in byte order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class ByteBPE:
    """One vocabulary file (JSON with a BPE model, byte-level letters and added tokens)."""

    def __init__(self, raw: bytes):
        import regex

        spec = json.loads(raw)
        model, byte_of = spec["model"], _letters()
        as_bytes = {t: bytes(byte_of[c] for c in t) for t in model["vocab"]}
        token = {i: as_bytes[t] for t, i in model["vocab"].items()}
        self.first = [model["vocab"][c] for c, _ in sorted(byte_of.items(), key=lambda x: x[1])]
        self.first_ids = np.array(self.first, np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        vocab = model["vocab"]
        self.merge = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(merges)}
        self.special = {t["content"].encode(): t["id"] for t in spec.get("added_tokens", [])}
        token.update({i: s for s, i in self.special.items()})
        in_order = [token.get(i, b"") for i in range(max(token, default=-1) + 1)]
        self.token_size = np.array([len(t) for t in in_order], np.int64)
        self.token_at = np.cumsum(self.token_size) - self.token_size
        self.token_bytes = np.frombuffer(b"".join(in_order), np.uint8)
        self.special_re = regex.compile(b"|".join(
            regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.pattern = regex.compile(PATTERN)
        inside = np.zeros((256, 256), bool)
        for t in as_bytes.values():
            for a, b in pairwise(t):
                inside[a, b] = True
        self.inside = inside
        cut = ~inside
        cut[list(b" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f'"), :] = False      # white space or apostrophe before
        cut[128:, :] = False           # may end a non-ASCII space; such characters are cut in their pieces
        cut[:, ord("'")] = False
        cut[:, 0x80:0xC0] = False      # inside a character
        self.cut = cut.ravel()
        self.known: dict[bytes, bytes] = {}
        self._index_merges()

    def _index_merges(self) -> None:
        """The merges as a sparse hash table that whole arrays of pairs are looked up in."""
        code = np.array([a << 32 | b for a, b in self.merge], np.int64)
        self.rank_id = np.array([new for _, new in self.merge.values()], np.int64)     # by rank
        rank = np.array([r for r, _ in self.merge.values()], np.int64)
        self.mask = (1 << max(4, int(len(code) * 8).bit_length())) - 1
        self.slot_code = np.full(self.mask + 1, -1, np.int64)
        self.slot_rank = np.full(self.mask + 1, NONE, np.int64)
        self.rank_id[rank] = self.rank_id.copy()
        left, at = np.arange(len(code)), self._slot(code)
        while len(left):
            _, one = np.unique(at, return_index=True)
            one = one[self.slot_code[at[one]] == -1]
            self.slot_code[at[one]], self.slot_rank[at[one]] = code[left[one]], rank[left[one]]
            rest = np.ones(len(left), bool)
            rest[one] = False
            left, at = left[rest], (at[rest] + 1) & self.mask

    def _slot(self, code: np.ndarray) -> np.ndarray:
        x = (code ^ (code >> 29)) * np.int64(0x5851F42D4C957F2D)
        return (x >> 40) & self.mask

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge rank of each pair; NONE where there is none."""
        code = a << 32 | b
        at = self._slot(code)
        found = self.slot_code[at]
        out = np.where(found == code, self.slot_rank[at], NONE)
        left = np.flatnonzero((found != code) & (found != -1))
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            found = self.slot_code[at[left]]
            hit = found == code[left]
            out[left[hit]] = self.slot_rank[at[left[hit]]]
            left = left[~hit & (found != -1)]
        return out

    def _merge_all(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All pieces at once: their ids one after the other, and the number of ids of each.

        Every part (a piece, or what a forbidden byte pair cuts off it) takes one merge in each
        round, its lowest rank, the leftmost of equals; only ranks beside a merge are looked up again.
        """
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum(sizes)
        start = np.ones(len(raw), bool)
        start[1:] = ~self.inside[raw[:-1], raw[1:]]
        start[ends[:-1]] = True
        ids, origin = self.first_ids[raw], np.arange(len(raw))
        done_at, done_ids = [], []
        rank = np.full(len(raw), NONE, np.int64)
        inner = np.flatnonzero(~start)
        rank[inner - 1] = self._ranks(ids[inner - 1], ids[inner])
        while len(ids):
            heads = np.flatnonzero(start)
            part = np.cumsum(start) - 1
            low = np.minimum.reduceat(rank, heads)
            busy = (low < NONE)[part]
            if not busy.all():
                done_at.append(origin[~busy])
                done_ids.append(ids[~busy])
                ids, origin, rank, start, part = ids[busy], origin[busy], rank[busy], start[busy], part[busy]
                if not len(ids):
                    break
            at = np.flatnonzero(rank == low[part])
            at = at[np.concatenate(([True], part[at[1:]] != part[at[:-1]]))]
            ids[at] = self.rank_id[rank[at]]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids, origin, rank, start = ids[keep], origin[keep], rank[keep], start[keep]
            at -= np.arange(len(at))
            rank[at] = NONE
            last = np.append(start[1:], True)
            ahead = at[~last[at]]
            rank[ahead] = self._ranks(ids[ahead], ids[ahead + 1])
            behind = at[~start[at]] - 1
            rank[behind] = self._ranks(ids[behind], ids[behind + 1])
        at = np.concatenate([*done_at, np.empty(0, np.int64)])
        ids = np.concatenate([*done_ids, np.empty(0, np.int64)])
        order = np.argsort(at, kind="stable")
        return ids[order], np.bincount(np.searchsorted(ends, at, "right"), minlength=len(pieces))

    def _learn(self, fragments: list[bytes]) -> dict[bytes, bytes]:
        """Ids of distinct fragments, as little-endian 32-bit integers."""
        findall, short, counts, long = self.pattern.findall, [], [], {}
        for f in fragments:
            text = f.decode()
            if text.isalpha() or text[0] == " " and text[1:].isalpha():
                pieces = (f,)               # an optional space and letters are one piece
            else:
                pieces = [p.encode() for p in findall(text)]
            if len(f) > HEAP_ABOVE and max(map(len, pieces)) > HEAP_ABOVE:
                long[f] = pieces
                counts.append(0)
            else:
                short += pieces
                counts.append(len(pieces))
        out = {f: np.array([i for p in ps for i in self._long_piece(p)], "<u4").tobytes() for f, ps in long.items()}
        if short:
            ids, sizes = self._merge_all(short)
            raw = ids.astype("<u4").tobytes()
            ends = np.append(0, 4 * np.cumsum(sizes))[np.append(0, np.cumsum(counts))].tolist()
            out.update((f, raw[a:b]) for f, a, b, k in zip(fragments, ends, ends[1:], counts) if k)
        return out

    def _long_piece(self, raw: bytes) -> list[int]:
        cuts = [i for i, (a, b) in enumerate(pairwise(raw), 1) if not self.inside[a, b]]
        out = []
        for a, b in pairwise([0, *cuts, len(raw)]):
            out += self._merged_long([self.first[c] for c in raw[a:b]])
        return out

    def _merged_long(self, ids: list[int]) -> list[int]:
        merge, n = self.merge, len(ids)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], i, p, m[1]) for i, p in enumerate(pairwise(ids)) if (m := merge.get(p))]
        heapq.heapify(heap)
        while heap:
            _, i, pair, new = heapq.heappop(heap)
            j = nxt[i] if ids[i] is not None else n
            if j >= n or (ids[i], ids[j]) != pair:
                continue
            ids[i], ids[j] = new, None
            nxt[i] = nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
                if m := merge.get((new, ids[nxt[i]])):
                    heapq.heappush(heap, (m[0], i, (new, ids[nxt[i]]), m[1]))
            if prv[i] >= 0 and (m := merge.get((ids[prv[i]], new))):
                heapq.heappush(heap, (m[0], prv[i], (ids[prv[i]], new), m[1]))
        return [x for x in ids if x is not None]

    def _cut(self, raw: bytes) -> list[bytes]:
        """The fragments between certain cuts."""
        b = np.frombuffer(raw, np.uint8)
        at = (np.flatnonzero(self.cut[b[:-1].astype(np.int32) * 256 + b[1:]]) + 1).tolist()
        return [raw[s:e] for s, e in zip([0, *at], [*at, len(raw)])]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers."""
        known, cut = self.known, []
        for t in texts:
            parts, start = [], 0
            raw = t.encode() if t else b""
            for m in self.special_re.finditer(raw) if self.special_re else ():
                if m.start() > start:
                    parts += self._cut(raw[start:m.start()])
                parts.append(m[0])
                start = m.end()
            if start < len(raw):
                parts += self._cut(raw[start:])
            cut.append(parts)
        new = {f for parts in cut for f in parts if f not in known}
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = {f for parts in cut for f in parts}
        specials = {f for f in new if f in self.special}
        known.update(self._learn(list(new - specials)))
        known.update((f, np.array([self.special[f]], "<u4").tobytes()) for f in specials)
        return [b"".join([known[f] for f in parts]) for parts in cut]

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are not UTF-8 become replacement characters. Unknown ids are skipped."""
        i = np.frombuffer(ids, "<u4")
        if len(i) and i.max() >= len(self.token_size):
            i = i[i < len(self.token_size)]
        size = self.token_size[i]
        at = np.repeat(self.token_at[i] - np.cumsum(size) + size, size)
        at += np.arange(len(at))
        return self.token_bytes[at].tobytes().decode("utf-8", "replace")


_LOADED: dict[str, ByteBPE] = {}


def _load(raw: bytes) -> ByteBPE:
    key = hashlib.sha256(raw).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = ByteBPE(raw)
    return _LOADED[key]


def encode(docs: DataFrame, vocabulary: str, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` plus the ids of every text as an array column; second result: that column's name."""
    shared = broadcast_bytes(docs.sparkSession, vocabulary)

    def make():
        bpe = _load(shared.value)
        return lambda texts: [[np.frombuffer(x, "<u4").astype(np.int32) for x in bpe.encode_all(texts)]]

    df, (name,) = annotate(docs, text_col, make, [("ids", T.ArrayType(T.IntegerType()))])
    return df, name


def decode(encoded: DataFrame, vocabulary: str, ids_col: str = "ids") -> tuple[DataFrame, str]:
    """``encoded`` plus the text of its ids; a null array decodes to the empty text."""
    shared = broadcast_bytes(encoded.sparkSession, vocabulary)

    def make():
        bpe = _load(shared.value)
        return lambda rows: [[bpe.decode(np.array([] if r is None else r, "<u4").tobytes()) for r in rows]]

    df, (name,) = annotate(encoded, ids_col, make, [("decoded", T.StringType())])
    return df, name


def round_trip(docs: DataFrame, vocabulary: str, text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """``docs`` plus (n_tokens, ids_sha256, decoded_sha256), encoded and decoded in one pass, so the
    ids are not carried through Arrow."""
    shared = broadcast_bytes(docs.sparkSession, vocabulary)
    sha = hashlib.sha256

    def make():
        bpe = _load(shared.value)

        def run(texts):
            n, a, b = [], [], []
            for ids in bpe.encode_all(texts):
                n.append(len(ids) // 4)
                a.append(sha(ids).hexdigest())
                b.append(sha(bpe.decode(ids).encode()).hexdigest())
            return [n, a, b]
        return run

    return annotate(docs, text_col, make, [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()),
                                           ("decoded_sha256", T.StringType())])
