"""Fill-in-middle documents: prefix, suffix and middle in another order, with sentinels between them.

One pass of ``pyarrow.compute`` per Arrow batch, rows stay in their partition. A batch's texts are split
into units (code points, words or lines) as one list array; it is flattened with the parent index
of every unit; a unit's ordinal compared with its text's two cuts gives its role; each role's units are
filtered out and rebuilt as lists, which are joined to the pieces; ``binary_join_element_wise`` puts
pieces and sentinels together. Texts beyond ``BLOCK_BYTES`` go through these steps in blocks whose pieces
are joined again, so a task holds the units of about one block, however long a text is.

The cuts and the form depend on the row's key and a seed alone: h1 to h4 are the first four 8-digit
groups of the hex SHA-256 of ``<seed>:<key>``. With n units, the prefix ends after the smaller of
h1 % (n + 1) and h2 % (n + 1), the middle after the larger. A row is left plain if h3 % 100 is
``rate`` or more, if its text is empty, or if it holds a sentinel (it could not be restored); else
suffix first (``spm``) if h4 % 100 is below ``spm_rate``, prefix first (``psm``) otherwise.

Defined results: a null text counts as empty; a null key is the empty string in the hash; repeated rows
give equal rows; an empty table gives none; all input columns stay, and a new column whose name is
taken gets a suffix (the names are returned).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, unused

BLOCK_BYTES = 1 << 20
SENTINELS = ("<P>", "<S>", "<M>")
UNITS = ("char", "word", "line")
FIELDS = [("n", T.LongType()), ("form", T.StringType()), ("prefix_units", T.LongType()),
          ("middle_units", T.LongType()), ("output", T.StringType())]
PLAIN, PSM, SPM = "plain", "psm", "spm"


def draws(key: Column, seed: int = 1) -> Column:
    """[h1, h2, h3, h4] as longs."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)])


def _unit_starts(data: np.ndarray, begins: np.ndarray, unit: str) -> np.ndarray:
    """Byte positions at which a unit starts; ``begins`` are those of the non-empty texts."""
    if unit == "char":
        return np.flatnonzero((data & 0xC0) != 0x80)
    starts = np.zeros(len(data), bool)
    if unit == "line":
        starts[1:] = data[:-1] == 10
    else:        # a word with the ASCII white space behind it; what a text begins with is a unit of its own
        space = (data == 32) | ((data >= 9) & (data <= 13))
        starts[1:] = space[:-1] & ~space[1:]
    starts[begins] = True
    return np.flatnonzero(starts)


def split_units(texts: pa.Array, unit: str = "char") -> pa.ListArray:
    """A list array of the units of every text; concatenated they are the text. No bytes are copied."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    lo, hi = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(body, np.uint8)[lo:hi] if body is not None else np.empty(0, np.uint8)
    full = offsets[:-1] < offsets[1:]
    starts = _unit_starts(data, offsets[:-1][full] - lo, unit) + lo
    edges = np.append(starts, hi).astype(np.int32)
    units = pa.StringArray.from_buffers(len(starts), pa.py_buffer(edges), body if body is not None else pa.py_buffer(b""))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(starts, offsets).astype(np.int32)), units)


def _modulo(x, y):
    return pc.subtract(x, pc.multiply(pc.divide(x, y), y))


def _rebuilt(units: pa.Array, mask: pa.Array, counts: np.ndarray) -> pa.Array:
    """The units that ``mask`` keeps as lists of ``counts`` units each, joined to strings."""
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), pc.filter(units, mask)), "")


def _pieces(texts: pa.Array, first: np.ndarray, second: np.ndarray, unit: str) -> list[pa.Array]:
    """[prefix, middle, suffix] of every text, cut after ``first`` and ``second`` units."""
    lists = split_units(texts, unit)
    units, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    size = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    begin = pa.array(np.concatenate(([0], np.cumsum(size)))[:-1])
    ordinal = pc.subtract(pa.array(np.arange(len(units))), pc.take(begin, parent))
    in_prefix = pc.less(ordinal, pc.take(pa.array(first), parent))
    in_suffix = pc.greater_equal(ordinal, pc.take(pa.array(second), parent))
    a, b = np.clip(first, 0, size), np.clip(second, 0, size)
    in_middle = pc.invert(pc.or_(in_prefix, in_suffix))
    return [_rebuilt(units, in_prefix, a), _rebuilt(units, in_middle, b - a), _rebuilt(units, in_suffix, size - b)]


def _blocks(text: bytes, unit: str, limit: int):
    """(start ordinal, text) blocks of a long text, cut where a unit starts."""
    done = at = 0
    while at < len(text):
        end = min(len(text), at + limit)
        part = np.frombuffer(text, np.uint8, min(len(text), end + 1) - at, at)
        if end < len(text):
            starts = _unit_starts(part, np.array([0]), unit)
            while len(starts) < 2 and end < len(text):           # one unit is longer than a block
                end = min(len(text), end + limit)
                part = np.frombuffer(text, np.uint8, min(len(text), end + 1) - at, at)
                starts = _unit_starts(part, np.array([0]), unit)
            if end < len(text):
                end = at + int(starts[-1])
        piece = pa.array([text[at:end]], pa.binary()).cast(pa.string())
        yield done, piece
        done += len(split_units(piece, unit).values)
        at = end


def _long_pieces(text: pa.Scalar, first: int, second: int, unit: str, limit: int) -> list[pa.Array]:
    parts = [_pieces(block, np.array([first - at]), np.array([second - at]), unit)
             for at, block in _blocks(text.as_buffer().to_pybytes(), unit, limit)]
    return [pc.binary_join(pa.array([[p[i][0].as_py() for p in parts]], pa.list_(pa.string())), "") for i in range(3)]


def _count(texts: pa.Array, unit: str, limit: int) -> np.ndarray:
    if unit == "char":
        return pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros(len(texts), np.int64)
    for lo, hi, long in _ranges(texts, limit):
        if long:
            out[lo] = sum(len(split_units(b, unit).values)
                          for _, b in _blocks(texts[lo].as_buffer().to_pybytes(), unit, limit))
        else:
            out[lo:hi] = pc.list_value_length(split_units(texts.slice(lo, hi - lo), unit)).to_numpy(zero_copy_only=False)
    return out


def _ranges(texts: pa.Array, limit: int):
    """(first row, row after the last, is one long text): ranges of about ``limit`` bytes."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    lo = held = 0
    for i, size in enumerate(sizes.tolist()):
        if i > lo and held + size > limit:
            yield lo, i, held > limit
            lo, held = i, 0
        held += size
    if lo < len(texts):
        yield lo, len(texts), held > limit


def rearranged(texts: pa.Array, h: list[pa.Array], unit: str = "char", rate: int = 90, spm_rate: int = 20,
               sentinels=SENTINELS, limit: int = BLOCK_BYTES) -> list[pa.Array]:
    """The ``FIELDS`` of a batch of texts without nulls; ``h``: its four draws."""
    p, s, m = sentinels
    n = _count(texts, unit, limit)
    modulus = pa.array(n + 1)
    one, two = _modulo(h[0], modulus), _modulo(h[1], modulus)
    first = pc.min_element_wise(one, two).to_numpy(zero_copy_only=False)
    second = pc.max_element_wise(one, two).to_numpy(zero_copy_only=False)
    plain = pc.or_(pc.equal(pc.binary_length(texts), 0), pc.greater_equal(_modulo(h[2], pa.scalar(100)), rate))
    for mark in sentinels:
        plain = pc.or_(plain, pc.match_substring(texts, mark))
    suffix_first = pc.less(_modulo(h[3], pa.scalar(100)), spm_rate)
    form = pc.if_else(plain, PLAIN, pc.if_else(suffix_first, SPM, PSM))
    joined = []
    for lo, hi, long in _ranges(texts, limit):
        part = texts.slice(lo, hi - lo)
        prefix, middle, suffix = (_long_pieces(part[0], int(first[lo]), int(second[lo]), unit, limit) if long
                                  else _pieces(part, first[lo:hi], second[lo:hi], unit))
        joined.append(pc.choose(
            pc.if_else(plain.slice(lo, hi - lo), 0, pc.if_else(suffix_first.slice(lo, hi - lo), 1, 2)), part,
            pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, ""),
            pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, "")))
    output = pa.concat_arrays(joined) if joined else pa.array([], pa.string())
    null = pa.scalar(None, pa.int64())
    return [pa.array(n), form, pc.if_else(plain, null, pa.array(first)),
            pc.if_else(plain, null, pa.array(second - first)), output]


def rearrange(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text", unit: str = "char", rate: int = 90,
              spm_rate: int = 20, seed: int = 1, sentinels=SENTINELS, block_bytes: int = BLOCK_BYTES
              ) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with n, form, prefix_units, middle_units and the output text; their column names by field."""
    if unit not in UNITS:
        raise ValueError(f"unknown unit {unit!r}; use one of {UNITS}")
    if len({*sentinels}) != 3 or not all(len(x) > 1 and x[0] == "<" and x.find("<", 1) < 0 and x[-1] == ">"
                                         for x in sentinels):
        raise ValueError("sentinels must be three different texts like <P>")   # so that they overlap no piece's end
    names = {f: unused(docs, f) for f, _ in FIELDS}
    h, t = unused(docs, "_h"), unused(docs, "_t")
    drawn = docs.withColumns({t: F.coalesce(F.col(text_col), F.lit("")), h: draws(F.col(key_col), seed)})
    drawn = drawn.select(*docs.columns, t, *(F.col(h)[i].alias(f"{h}{i}") for i in range(4)))
    width = len(docs.columns)

    def run(batches):
        for whole in batches:
            for b in slices(whole, width):
                new = rearranged(b.column(width), [b.column(width + 1 + i) for i in range(4)], unit, rate, spm_rate,
                                 sentinels, block_bytes)
                yield pa.RecordBatch.from_arrays([*b.columns[:width], *new],
                                                 names=[*b.schema.names[:width], *names.values()])

    schema = T.StructType([*docs.schema.fields, *(T.StructField(names[f], t) for f, t in FIELDS)])
    return drawn.mapInArrow(run, schema), names


def _between(texts: pa.Array, skip: int, marks: list[str]) -> list[pa.Array]:
    """The three parts of every text after its first ``skip`` characters, parted by the two marks."""
    rest = pc.utf8_slice_codeunits(texts, skip)
    parts = []
    for mark in marks:
        lists = pc.split_pattern(rest, mark, max_splits=1)
        parts.append(pc.list_element(lists, 0))
        rest = pc.list_element(lists, 1)
    return [*parts, rest]


def restored(output: pa.Array, form: pa.Array, sentinels=SENTINELS) -> pa.Array:
    """The texts that were rearranged, from output and form alone."""
    p, s, m = sentinels
    order, texts = [], []
    for name in (PLAIN, PSM, SPM):
        rows = pc.indices_nonzero(pc.equal(form, name))
        if not len(rows):
            continue
        some = pc.take(output, rows)
        if name == PSM:
            prefix, suffix, middle = _between(some, len(p), [s, m])
        elif name == SPM:
            suffix, prefix, middle = _between(some, len(s), [p, m])
        order.append(rows)
        texts.append(some if name == PLAIN else pc.binary_join_element_wise(prefix, middle, suffix, ""))
    if not order:
        return pa.array([], pa.string())
    return pc.take(pa.concat_arrays(texts), pc.sort_indices(pa.concat_arrays(order)))


def restore(df: DataFrame, output_col: str, form_col: str, sentinels=SENTINELS, out: str = "restored"
            ) -> tuple[DataFrame, str]:
    """``df`` with the exact text behind each output of ``rearrange``; the new column's name."""
    name = unused(df, out)
    at, kind = df.columns.index(output_col), df.columns.index(form_col)

    def run(batches):
        for whole in batches:
            for b in slices(whole, at):
                yield pa.RecordBatch.from_arrays([*b.columns, restored(b.column(at), b.column(kind), sentinels)],
                                                 names=[*b.schema.names, name])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, T.StringType())])), name
