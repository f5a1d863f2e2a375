"""Document fingerprints: against a plain version, against true similarities, and the neighbour scan."""

import hashlib

import numpy as np
import pytest

from strata.llm import oph


def words_of(text):
    return (text or "").encode().lower().split()


def shingles(text, k=oph.WIDTH):
    w = words_of(text)
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def plain(text, bins=oph.BINS, bits=oph.BITS):
    """Bin by bin, attempt by attempt."""
    hashes = [int(h) for h in oph.shingle_hashes(text)]
    if not hashes:
        return ""
    per = 64 - (bins.bit_length() - 1)
    least = {}
    for h in hashes:
        least[h >> per] = min(h, least.get(h >> per, h))
    out = 0
    for i in range(bins):
        at = t = 0
        value = least.get(i)
        while value is None:
            at = int(oph._probes(bins, t - t % oph.PROBES)[i, t % oph.PROBES])
            value, t = least.get(at), t + 1
        out = out << bits | value & ((1 << bits) - 1)
    return f"{out:0{bins * bits // 4}x}"


def text(rng, n):
    return " ".join(f"w{x}" for x in rng.integers(0, 5000, n))


def test_fingerprints_match_the_plain_version():
    rng = np.random.default_rng(1)
    for n in (1, 2, 4, 5, 6, 7, 20, 300, 3000):
        t = text(rng, n)
        assert oph.fingerprint(t).hex() == plain(t)
    assert oph.fingerprint(None) == oph.fingerprint(" \n\t") == b""
    assert oph.fingerprint("One Two") == oph.fingerprint("one\ttwo ") != oph.fingerprint("two one")
    assert len(oph.fingerprint("a")) == oph.BINS * oph.BITS // 8
    assert oph.fingerprint("a b c d e f g", 5, 64, 3) == oph.packed(oph.minima(oph.shingle_hashes("a b c d e f g"), 64), 3)


@pytest.mark.parametrize("n", [12, 60, 400, 5000])
def test_likeness_estimates_jaccard(n):
    rng = np.random.default_rng(n)
    errors = []
    for _ in range(40):
        a, b = text(rng, n), text(rng, n)
        for keep in (0, n // 4, n // 2, n - n // 10):
            c = " ".join(a.split()[:keep] + b.split()[keep:])
            x, y = shingles(a), shingles(c)
            true = len(x & y) / len(x | y)
            errors.append(oph.likeness(oph.fingerprint(a), oph.fingerprint(c)) - true)
    assert abs(np.mean(errors)) < 0.012                  # chance agreements are taken off
    assert np.sqrt(np.mean(np.square(errors))) < (0.035 if n > 100 else 0.12)
    assert oph.likeness(b"", b"") == 1 and oph.likeness(b"", oph.fingerprint("a")) == 0


def expected(rows):
    """Rows of distinct ids."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for at, (i, t) in enumerate(rows):
        following = rows[(at + 1) % len(rows)][1]
        half = len(t) // 2
        new = t[:len(t) - half] + following[:half]
        a, b, c = (oph.fingerprint(x) for x in (t, new, following))
        out.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), a.hex(), b.hex(), oph.likeness(a, b), oph.likeness(a, c)))
    return out


@pytest.mark.parametrize("parts", [1, 3, 50])
def test_neighbours(spark, parts):
    rng = np.random.default_rng(3)
    rows = [(int(i), text(rng, int(rng.integers(0, 60))) + "é🤦") for i in rng.permutation(90) * 3]
    rows += [(1, None), (2, ""), (4, "word " * 40_000), (None, "no id here"), (5, "one")]
    df = spark.createDataFrame([(t, i, 7) for i, t in rows], "text string, doc_id long, fingerprint int")
    got = [tuple(r) for r in oph.edited_neighbours(df, partitions=parts).collect()]
    assert sorted(got, key=str) == sorted(expected(rows), key=str)


def test_repeated_rows_spread_and_single_rows(spark):
    rows = [(7, "the same text again and again")] * 600 + [(i, f"text number {i} of some") for i in range(10, 300)]
    got = oph.edited_neighbours(spark.createDataFrame(rows, "doc_id long, text string"), partitions=8).collect()
    assert len(got) == len(rows)
    copies = [r for r in got if r.doc_id == 7]
    assert sum(r.near_next == 1 for r in copies) == 599 and len({r.fingerprint for r in copies}) == 1
    one = spark.createDataFrame([(1, "abcd")], "doc_id long, text string")
    r = oph.edited_neighbours(one).collect()[0]
    assert (r.n_chars, r.near_next) == (4, 1) and r.edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    assert oph.edited_neighbours(one.where("doc_id = 0")).count() == 0


def test_map_keeps_columns(spark):
    df = spark.createDataFrame([("x y", 1), (None, 2)], "text string, fingerprint int")
    out, name = oph.fingerprints(df)
    assert [r[name] for r in out.orderBy("fingerprint").collect()] == [oph.fingerprint("x y").hex(), ""]
    with pytest.raises(ValueError, match="bins"):
        oph.fingerprints(df, bins=100)
