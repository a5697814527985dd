"""Periodic runs of words by block convolution at dyadic scales (operator 13)."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import emit, texts

PRIME, ROOT, TWOS = 15 * 2**27 + 1, 31, 27  # transforms of up to 2**27 numbers
P = np.uint64(PRIME)
GRAM = 4
CELLS = 1 << 20  # numbers transformed at once
NEVER = np.iinfo(np.int64).max


@lru_cache(maxsize=32)
def _twiddles(size: int, invert: bool) -> np.ndarray:
    """The first half of the powers of a root of unity of order ``size``, by doubling. Kept: a task needs the same ones for every text."""
    root = pow(ROOT, (PRIME - 1) // size, PRIME)
    root = pow(root, -1, PRIME) if invert else root
    out = np.ones(1, dtype=np.uint64)
    while len(out) < size // 2:
        out = np.concatenate([out, out * np.uint64(pow(root, len(out), PRIME)) % P])
    return out[: max(1, size // 2)]


def ntt(x: np.ndarray) -> np.ndarray:
    """Number-theoretic transform of each row (a power of two of numbers below PRIME), its entries in bit-reversed order."""
    rows, n = x.shape
    x, size = x.copy(), n
    while size > 1:
        parts = x.reshape(rows, -1, 2, size // 2)
        u, v = parts[:, :, 0], parts[:, :, 1]
        low, high = (u + v) % P, (u + (P - v)) % P * _twiddles(size, False) % P
        x = np.stack([low, high], axis=2).reshape(rows, n)
        size //= 2
    return x


def inverse_ntt(x: np.ndarray) -> np.ndarray:
    """Undoes ``ntt``."""
    rows, n = x.shape
    size = 2
    while size <= n:
        parts = x.reshape(rows, -1, 2, size // 2)
        u, v = parts[:, :, 0], parts[:, :, 1] * _twiddles(size, True) % P
        x = np.stack([(u + v) % P, (u + (P - v)) % P], axis=2).reshape(rows, n)
        size *= 2
    return x * np.uint64(pow(n, -1, PRIME)) % P


def occurrences(words: np.ndarray, starts: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance) of blocks of ``block`` words whose squared differences to the words ``distance`` later sum up to
    zero modulo PRIME, for the distances block .. 2 * block - 1: every true occurrence, and by rare chance another.

    sum (a - b)^2 = sum a^2 + sum b^2 - 2 sum ab; the last is a convolution of the window with the reversed block. Of a cyclic one
    of 2 * block numbers the entries wanted are free of what wraps round.
    """
    n, size = len(words), 2 * block
    padded = np.concatenate([words, np.zeros(2 * size, dtype=words.dtype)]).astype(np.uint64) % P
    squares = np.concatenate([np.zeros(1, np.uint64), np.cumsum(padded * padded % P)])
    at, distance = [], []
    for first in range(0, len(starts), max(1, CELLS // size)):
        own = starts[first : first + max(1, CELLS // size)]
        a = np.zeros((len(own), size), dtype=np.uint64)
        a[:, :block] = padded[own[:, None] + np.arange(block - 1, -1, -1)]
        b = padded[own[:, None] + block + np.arange(size)]
        b[:, -1] = 0
        both = inverse_ntt(ntt(a) * ntt(b) % P)[:, block - 1 : size - 1]
        offset = own[:, None] + block + np.arange(block)
        whole = (squares[own + block] - squares[own])[:, None] + squares[offset + block] - squares[offset]
        hit, o = np.nonzero((whole % P == 2 * both % P) & (offset + block <= n))
        at.append(own[hit])
        distance.append(o + block)
    return np.concatenate(at), np.concatenate(distance)


def _next(grams: np.ndarray) -> np.ndarray:
    """Distance to the next equal entry."""
    order = np.argsort(grams, kind="stable")
    out = np.full(len(grams), NEVER)
    same = grams[order[1:]] == grams[order[:-1]]
    out[order[:-1][same]] = np.diff(order)[same]
    return out


def _pairs(grams: np.ndarray, apart: int) -> np.ndarray:
    """Numbers for each entry together with the one ``apart`` later."""
    both = grams[:-apart] * (int(grams.max()) + 1) + grams[apart:]
    return np.unique(both, return_inverse=True)[1]


def _stretch(x: np.ndarray, start: int, end: int, d: int) -> tuple[int, int]:
    """The longest range around [start, end) in which every word equals the one d later; empty if that fails inside."""
    if not np.array_equal(x[start:end], x[start + d : end + d]):
        return start, start
    n, step = len(x), 64
    while end + d < n:
        m = min(step, n - d - end)
        other = x[end : end + m] != x[end + d : end + d + m]
        if other.any():
            end += int(other.argmax())
            break
        end, step = end + m, 2 * step
    step = 64
    while start > 0:
        m = min(step, start)
        other = (x[start - m : start] != x[start - m + d : start + d])[::-1]
        if other.any():
            start -= int(other.argmax())
            break
        start, step = start - m, 2 * step
    return start, end


def find_runs(x: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs among the numbers ``x`` (from 1 on), by start, then period.

    A run is a stretch of length max(6, 4 * period) or more with that smallest period, extended as far as it goes. At scale B
    its period is B to 2 B - 1, and the first aligned block of B words in it occurs again one period later. Only blocks are
    transformed of which every GRAM words occur again within 2 B words; of those inside a known run of smaller period, only
    occurrences that can reach beyond that run are extended.
    """
    n, block, runs = len(x), 1, set()
    if n < 6:
        return []
    grams, width = x.astype(np.int64), 1
    ahead = _next(grams)
    again = np.count_nonzero(ahead < NEVER)
    while 4 * block <= n:
        if width < min(block, GRAM):
            grams = _pairs(grams, width)
            width *= 2
            ahead = _next(grams)
            again = np.count_nonzero(ahead < NEVER)
        if again < block - width + 1:
            break  # no block of this or a larger size can occur again
        blocks = n // block - 1
        reach = ahead[: blocks * block].reshape(blocks, block)[:, : block - width + 1]
        near = reach.max(axis=1) < 2 * block
        if not near.any():
            block *= 2
            continue
        starts = np.flatnonzero(near) * block
        left, right = np.zeros(len(starts), dtype=np.int64), np.full(len(starts), -1, dtype=np.int64)  # the known run around a block
        for start, length, period in runs:
            if 2 * period <= block <= length:
                i, j = np.searchsorted(starts, [start, start + length - block + 1])
                left[i:j], right[i:j] = start, start + length
        open_ = starts + 3 * block > right
        if open_.any():
            at, distance = occurrences(x, starts[open_], block)
            place = np.searchsorted(starts, at)
            a, b = left[place], right[place]
            beyond = at + distance + block > b
            far = np.minimum(b + distance, n - 1)
            grows = (a > 0) & (x[np.maximum(a - 1, 0)] == x[np.minimum(np.maximum(a - 1, 0) + distance, n - 1)])
            grows |= (b + distance < n) & (x[np.minimum(b, n - 1)] == x[far])
            seeds = (b < 0) | (beyond & grows)
            at, distance = at[seeds], distance[seeds]
            order = np.lexsort((at, distance))
            at, distance = at[order], distance[order]
            i = 0
            while i < len(at):
                d = int(distance[i])
                start, end = _stretch(x, int(at[i]), int(at[i]) + block, d)
                if end - start >= max(3 * d, 5 if d == 1 else 0):
                    extent = (start, end - start + d)
                    if not any((*extent, p) in runs for p in _divisors(d)):
                        runs.add((*extent, d))
                same = np.searchsorted(distance, d, side="right")
                i = max(i + 1, int(i + np.searchsorted(at[i:same], end - block, side="right")))
        block *= 2
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _divisors(d: int) -> list[int]:
    """The divisors of d but itself."""
    small = [k for k in range(1, int(d**0.5) + 1) if d % k == 0]
    return [k for k in {*small, *(d // k for k in small)} if k < d]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text", rearrange: Callable[[int | None, int], np.ndarray | None] | None = None) -> DataFrame:
    """(id, n_words, runs, collapsed), one row per row of ``docs``: each text's runs as an array of (start, length, period) by
    start, then period, in words, and the text without what a run has after its first period, words joined by one space.

    Words stand between ASCII white space. Null and empty texts have no words and no runs, and collapse to an empty text.
    ``rearrange(id, n)`` may give the places of words to read instead of 0 .. n - 1. Runs may overlap; a word is dropped if
    any run has it after its first period. Every row is worked off by itself: repeated rows and null ids come out as they
    came in, other columns are not used. A text is searched in memory that grows with its own length only.
    """
    spans = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    schema = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("runs", spans), ("collapsed", pa.string())])

    def one(key: int | None, body: str | None) -> tuple[int, list[dict], str]:
        own = (body or "").encode("utf-8", "surrogatepass").split()
        order = rearrange(key, len(own)) if rearrange else None
        if order is not None:
            own = [own[i] for i in order]
        numbers: dict[bytes, int] = defaultdict(count(1).__next__)
        x = np.fromiter(map(numbers.__getitem__, own), np.int64, len(own))
        runs, kept = find_runs(x), np.ones(len(own), dtype=bool)
        for start, length, period in runs:
            kept[start + period : start + length] = False
        left = own if kept.all() else [own[i] for i in np.flatnonzero(kept)]
        return len(own), [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs], b" ".join(left).decode("utf-8", "surrogatepass")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                found = [one(k.as_py(), t) for k, t in zip(part.column(0), texts(part), strict=True)]
                yield emit(schema, [part.column(0), *zip(*found, strict=True)])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    out = rows.mapInArrow(run, "id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
    return out.withColumnRenamed("id", id_col)
