"""Periodic runs (operator 13) against a brute-force version."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest

from vacancia.llm import periodic, queries


def by_hand(w):
    """Every (start, length, smallest period) of max(6, 4 q) words or more: periods in rising order, so the first to give an extent has the smallest."""
    out = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                out.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def numbered(w):
    seen = {}
    return np.array([seen.setdefault(x, len(seen) + 1) for x in w], dtype=np.int64)


def repetitive(rng, n, words):
    """Text in which short passages, long ones and runs of runs are repeated."""
    out = []
    while len(out) < n:
        kind = rng.random()
        if kind < 0.4 or not out:
            out += [rng.randrange(words) for _ in range(rng.randint(1, 12))]
        elif kind < 0.8:
            part = [rng.randrange(words) for _ in range(rng.choice([1, 1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 33]))]
            out += (part * rng.randint(2, 9))[: rng.randint(1, 200)]
        else:
            at = rng.randrange(len(out))
            out += out[at : at + rng.randint(1, 80)] * rng.randint(1, 5)
    return out[:n]


def test_transform():
    rng = np.random.default_rng(1)
    for n in (1, 2, 8, 256):
        a, b = rng.integers(0, periodic.PRIME, (2, 3, n), dtype=np.uint64)
        assert (periodic.inverse_ntt(periodic.ntt(a)) == a).all()
        got = periodic.inverse_ntt(periodic.ntt(a) * periodic.ntt(b) % periodic.P)
        want = [[sum(int(a[r, i]) * int(b[r, (k - i) % n]) for i in range(n)) % periodic.PRIME for k in range(n)] for r in range(3)]
        assert got.tolist() == want


@pytest.mark.parametrize("block", [1, 2, 4, 8, 32])
def test_occurrences(block):
    rng = random.Random(block)
    x = numbered(repetitive(rng, 300, 3))
    starts = np.arange(0, len(x) - 2 * block + 1, block)
    want = {(s, d) for s in starts for d in range(block, 2 * block) if s + d + block <= len(x) and (x[s : s + block] == x[s + d : s + d + block]).all()}
    assert set(zip(*(a.tolist() for a in periodic.occurrences(x, starts, block)), strict=True)) == want


def test_runs_by_brute_force():
    rng = random.Random(2)
    for k in range(400):
        w = repetitive(rng, rng.randint(0, 260), rng.choice([1, 2, 3, 5, 40]))
        assert periodic.find_runs(numbered(w)) == by_hand(w), k


def test_runs_of_runs():
    for w in (["a"] * 500, ["a"] * 5, ["a"] * 6, (["a"] * 40 + ["b"]) * 12, ((["a"] * 9 + ["b"]) * 6 + ["c"]) * 7, (["a", "b"] * 20 + ["a"]) * 9, list("abcabcabcab"), list("abcabcabcabc")):
        assert periodic.find_runs(numbered(w)) == by_hand(w)


def test_long_texts():
    rng = random.Random(3)
    part = [rng.randrange(5000) for _ in range(30_011)]
    w = [rng.randrange(5000) for _ in range(777)] + part * 5 + [-1] * 100_000 + part[:100]
    assert periodic.find_runs(numbered(w)) == [(777, 5 * 30_011, 30_011), (777 + 5 * 30_011, 100_000, 1)]


def test_operator(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{x}" for x in repetitive(rng, rng.randint(0, 150), rng.choice([2, 50, 500])))) for i in range(200)]
    rows += [(300, None), (301, ""), (302, " \n\t"), (303, "é " * 9), (304, "x y\x0bx y " * 9), (None, "b " * 7), rows[5], (5, rows[6][1]), (305, "z" * 300_000)]
    df = spark.createDataFrame([(*r, 1, "q", 2) for r in rows], "doc_id long, text string, runs int, collapsed string, n_words int").repartition(3)

    def expected(i, t, rearrange):
        w = (t or "").encode().split()
        order = rearrange(i, len(w)) if rearrange else None
        w = w if order is None else [w[k] for k in order]
        runs = by_hand(w)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        return w, runs, b" ".join(x for k, x in enumerate(w) if k not in gone)

    for rearrange in (None, queries.planted_runs):
        want = collections.Counter()
        for i, t in rows:
            w, runs, left = expected(i, t, rearrange)
            want[i, len(w), tuple(runs), left] += 1
        got = collections.Counter((r.doc_id, r.n_words, tuple((x.start, x.length, x.period) for x in r.runs), r.collapsed.encode()) for r in periodic.periodic_runs(df, rearrange=rearrange).collect())
        assert got == want
    assert periodic.periodic_runs(df.limit(0)).count() == 0


def test_query_by_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries.op13_periodic_runs(spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(got) == len(docs)
    some = 0
    for d in docs:
        w = (d.text or "").encode().split()
        h, n = zlib.crc32(str(d.doc_id).encode()), len(w)
        if len(w) > 1500:
            continue  # too long for the quadratic version
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = by_hand(w)
        gone = {k for s, m, q in runs for k in range(s + q, s + m)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        r = got[d.doc_id]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest()
        some += len(runs)
    assert some > 10
