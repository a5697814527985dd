"""Benchmark decontamination: a BM25 index of the test items, queried by every passage with block-max bounds (operator 9)."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import emit, texts

PUNCTUATION = bytes.maketrans(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", b" " * 32)
K1, B = 1.2, 0.75
BLOCK_ITEMS, SHORTEST, LONGER = 4, 64, 4
PORTION = 32 << 20  # bytes of test items in one index


def words(text: str | None) -> list[bytes]:
    """A-Z in lower case, between ASCII white space and punctuation."""
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(PUNCTUATION).split()


def grams(some: Sequence[bytes], n: int) -> set[tuple[bytes, ...]]:
    return set(zip(*(some[i:] for i in range(n)), strict=False))


def share(part: Sequence[bytes], passage: Sequence[bytes], n: int = 3) -> float:
    """Of the part's word trigrams (of a shorter part, itself), how many stand in the passage. Nothing is there whole."""
    own = grams(part, min(n, len(part))) if part else set()
    return len(own & grams(passage, min(n, len(part)))) / len(own) if own else 1.0


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """The last sentence is the answer, what precedes it the question. One sentence alone is a question."""
    parts = [p for p in re.split(r"(?<=[.!?])\s+", text.strip()) if words(p)]
    return (words(" ".join(parts[:-1])), words(parts[-1])) if len(parts) > 1 else (words(text), [])


@dataclass
class Index:
    """Items of up to ``length`` words. impact[item][term] is BM25 as a share of what the item scores when queried
    with its own words, so one threshold holds for all. Items stand in blocks; ``most`` has a term's best impact anywhere,
    ``starts``, ``blocks`` and ``best`` list its best one in each block."""

    length: int
    ids: list[int]
    terms: dict[bytes, int]
    impact: list[dict[int, float]]
    parts: list[tuple[list[bytes], list[bytes]]]
    most: np.ndarray
    starts: np.ndarray
    blocks: np.ndarray
    best: np.ndarray

    @classmethod
    def build(cls, length: int, items: list[tuple[int, str]]) -> Index:
        df = Counter(w for _, t in items for w in set(words(t)))
        # items that share their most common words stand side by side: that keeps the blocks' bounds low
        items = sorted(items, key=lambda x: sorted(((-df[w], w) for w in set(words(x[1]))))[:4])
        bags = [Counter(words(t)) for _, t in items]
        sizes = [sum(b.values()) for b in bags]
        mean, terms = sum(sizes) / len(sizes), {t: i for i, t in enumerate(df)}
        impact, by_block = [], defaultdict(dict)
        for k, (bag, size) in enumerate(zip(bags, sizes, strict=True)):
            own = {}
            for t, tf in bag.items():
                idf = np.log(1 + (len(items) - df[t] + 0.5) / (df[t] + 0.5))
                own[terms[t]] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size / mean))
            total = sum(own.values())
            impact.append({t: v / total for t, v in own.items()})
            for t, v in impact[-1].items():
                by_block[t][k // BLOCK_ITEMS] = max(v, by_block[t].get(k // BLOCK_ITEMS, 0.0))
        lists = [by_block[t] for t in range(len(terms))]
        return cls(
            length, [i for i, _ in items], terms, impact, [question_and_answer(t) for _, t in items],
            np.array([max(x.values()) for x in lists]), np.cumsum([0, *map(len, lists)]),
            np.array([b for x in lists for b in x]), np.array([v for x in lists for v in x.values()]),
        )

    def search(self, docs: list[list[bytes]], threshold: float) -> Iterator[tuple[int, int, float, list[bytes]]]:
        """(document, item, score, passage) of all passages that score ``threshold`` or more.

        A passage is two neighbouring pieces of ``length`` words: wherever an item stands in a document, one holds it
        whole. Passages whose terms' best impacts don't add up to the threshold are left first, then blocks of items;
        only what remains is scored item by item.
        """
        pieces = [-(-len(d) // self.length) for d in docs]
        base = np.concatenate([[0], np.cumsum(pieces)])
        n, n_terms, n_blocks = int(base[-1]), len(self.terms), -(-len(self.ids) // BLOCK_ITEMS)
        if not n:
            return
        ids = np.fromiter((i for d in docs for i in map(self.terms.get, d, repeat(-1))), np.int64)
        piece = np.concatenate([b + np.arange(len(d)) // self.length for b, d in zip(base, docs, strict=False)])
        pairs = np.unique((piece * n_terms + ids)[ids >= 0])
        piece, term = pairs // n_terms, pairs % n_terms
        owner = np.repeat(np.arange(len(docs)), pieces)
        follows = np.append(owner[1:] == owner[:-1], False)
        alone = np.repeat(np.array(pieces) == 1, pieces)
        bound = np.bincount(piece, self.most[term], n)
        bound[:-1] += np.where(follows[:-1], bound[1:], 0)
        open_ = (bound >= threshold - 1e-9) & (follows | alone)
        if not open_.any():
            return
        needed = open_ | np.concatenate([[False], open_[:-1] & follows[:-1]])
        here = needed[piece]
        piece, term = piece[here], term[here]
        count = self.starts[term + 1] - self.starts[term]
        at = np.repeat(self.starts[term] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        rank = np.cumsum(needed) - 1
        sums = np.bincount(np.repeat(rank[piece], count) * n_blocks + self.blocks[at], self.best[at], int(needed.sum()) * n_blocks).reshape(-1, n_blocks)
        edges = np.searchsorted(piece, np.arange(n + 1))
        for p in np.flatnonzero(open_):
            total = sums[rank[p]] + (sums[rank[p + 1]] if follows[p] else 0)
            hot = np.flatnonzero(total >= threshold - 1e-9)
            if not len(hot):
                continue
            have = set(term[edges[p] : edges[p + 1 + follows[p]]].tolist())
            d, start = int(owner[p]), int(p - base[owner[p]]) * self.length
            for block in hot.tolist():
                for k in range(block * BLOCK_ITEMS, min(len(self.ids), (block + 1) * BLOCK_ITEMS)):
                    score = sum(v for t, v in self.impact[k].items() if t in have)
                    if score >= threshold:
                        yield d, k, score, docs[d][start : start + 2 * self.length]


def indexes(items: Iterable[tuple[int | None, str | None]]) -> list[Index]:
    """One index per range of item lengths, each LONGER times the one before. Items without id or words are left out."""
    by_length: dict[int, list] = defaultdict(list)
    for i, t in items:
        n = len(words(t))
        if i is not None and n:
            length = SHORTEST
            while length < n:
                length *= LONGER
            by_length[length].append((i, t))
    return [Index.build(length, own) for length, own in sorted(by_length.items())]


def portions(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple[int, str]]]:
    """The items in order of their ids, in lists of up to PORTION bytes (one longer item is a list of its own)."""
    held, size = [], 0
    for row in benchmark.select(F.col(item).alias("i"), F.col(text).alias("t")).distinct().orderBy("i", "t").toLocalIterator():
        size += len(row.t or "") * 4
        if held and size > PORTION:
            yield held
            held, size = [], len(row.t or "") * 4
        held.append((row.i, row.t))
    yield held


def hits(
    some: Iterable[str | None], found: list[Index], threshold: float, overlap: float, chars: int = 1 << 20
) -> Iterator[tuple[int, int, tuple[float, float, float]]]:
    """(position of the text, item, (score, question overlap, answer overlap)) of the best passage for each item found."""
    held: list[list[bytes]] = []
    first = size = 0

    def of_held() -> Iterator[tuple[int, int, tuple[float, float, float]]]:
        best: dict[tuple[int, int], tuple[float, float, float]] = {}
        for index in found:
            for d, k, score, passage in index.search(held, threshold):
                q, a = (share(x, passage) for x in index.parts[k])
                if q >= overlap and a >= overlap:
                    best[d, index.ids[k]] = max((float(score), q, a), best.get((d, index.ids[k]), (0.0, 0.0, 0.0)))
        for (d, i), v in sorted(best.items()):
            yield first + d, i, v

    for t in some:
        held.append(words(t))
        size += len(t or "")
        if size > chars:
            yield from of_held()
            first, held, size = first + len(held), [], 0
    yield from of_held()


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    item: str = "item_id",
    text: str = "text",
    threshold: float = 0.6,
    overlap: float = 0.5,
) -> DataFrame:
    """(key, item_id, score, question_overlap, answer_overlap): one row per row of ``docs`` and item that it holds.

    score is the best passage's BM25 as a share of the item's own; overlaps are the shares of the question's and the answer's
    word trigrams that stand in that passage. An item counts if all three reach their bounds (an item of one
    sentence has no answer: overlap 1). The index is sent to the tasks in portions of bounded size, one search
    of all documents per portion, so a larger benchmark takes more passes, not more memory. Null and empty
    texts hold nothing; equal items are reported each.
    """
    schema = pa.schema([("key", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())])
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))

    def searched(found: list[Index]) -> DataFrame:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys = batch.column(0).to_pylist()
                out = [(keys[r], i, *v) for r, i, v in hits(texts(batch), found, threshold, overlap)]
                yield emit(schema, list(zip(*out, strict=True)) or [[]] * 5)

        return rows.mapInArrow(run, "key long, item_id long, score double, question_overlap double, answer_overlap double")

    out = None
    for part in portions(benchmark, item, text):
        one = searched(indexes(part))
        out = one if out is None else out.union(one)
    return out.withColumnsRenamed({"key": key, "item_id": item})


def keep_clean(
    docs: DataFrame, benchmark: DataFrame, item: str = "item_id", text: str = "text", threshold: float = 0.6, overlap: float = 0.5
) -> DataFrame:
    """Rows of ``docs`` in which ``leaks`` finds no item, all columns as they are."""
    def clean(found: list[Index]):
        def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                dirty = {r for r, _, _ in hits(batch, found, threshold, overlap)}
                yield pd.Series([r not in dirty for r in range(len(batch))], dtype=bool)

        return F.pandas_udf(judge, "boolean")

    for part in portions(benchmark, item, text):
        docs = docs.where(clean(indexes(part))(F.col(text)))
    return docs
