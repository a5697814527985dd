"""SimHash near-duplicates through an index on byte positions (operator 8)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import connected, emit, stored, texts

BLOCK = 1 << 14  # shingles tallied at once
#: The eight bits of a byte, the highest first, in eight lanes of a 64-bit word: up to 255 of them add up without a carry.
LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64).ravel()


def shingle_hashes(text: str | None, shingle: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of all word shingles, in blocks. A-Z in lower case, words between ASCII white space."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return
    grams = [b" ".join(words)] if len(words) <= shingle else map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    left = max(1, len(words) - shingle + 1)
    digests = map(xxhash.xxh64_intdigest, grams, iter(lambda: 42, None))
    while left:
        n = min(left, BLOCK)
        yield np.fromiter(digests, np.uint64, n)
        left -= n


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64 bits; a bit is 1 if over half of the shingles (repeats count) have it. No words: zero."""
    tally, n = np.zeros(64, dtype=np.int64), 0
    for h in shingle_hashes(text, shingle):
        n += len(h)
        lanes = LANES[h.astype(">u8").view(np.uint8).reshape(-1, 8)]
        sums = np.add.reduceat(lanes, np.arange(0, len(h), 255), axis=0)
        tally += sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * tally > n).tobytes(), "big")


def fingerprints(docs: DataFrame, key: str, shingle: int = 3, text: str = "text") -> DataFrame:
    """(key, fp): one row per row of ``docs``, the fingerprint as a long."""
    schema = pa.schema([("key", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in texts(batch)], dtype=np.uint64)
            yield emit(schema, [batch.column(0), found.view(np.int64)])

    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(run, "key long, fp long")


def _masks(bits: int) -> list[int]:
    """Masks that keep all byte positions but ``bits`` of the 8, as signed longs."""
    out = []
    for gone in combinations(range(8), bits):
        m = (1 << 64) - 1
        for i in gone:
            m &= ~(0xFF << 8 * i)
        out.append(m - (1 << 64) if m >> 63 else m)
    return out


def link_group(fps: np.ndarray, bits: int) -> np.ndarray:
    """For fingerprints that share the positional bytes of one key: the least member of each one's component.

    Pairs at up to ``bits`` differing bits link. Groups over 512 have at most 256 ** bits members (``bits`` bytes are free);
    there each value looks up the values one or two bit flips away instead of being compared with all.
    """
    fps = np.unique(fps)
    n = len(fps)
    label = np.arange(n)
    if n <= 512:
        near = np.bitwise_count(fps.view(np.uint64)[:, None] ^ fps.view(np.uint64)[None, :]) <= bits
        steps = [lambda x: np.where(near, x[None, :], n).min(axis=1)]
    else:
        unsigned = fps.view(np.uint64)
        order = np.argsort(unsigned)
        ranked = unsigned[order]
        free = [b for b in range(64) if np.any((unsigned ^ unsigned[0]) >> np.uint64(b) & np.uint64(1))]
        steps = []
        for flips in range(1, bits + 1):
            for some in combinations(free, flips):
                other = unsigned ^ np.uint64(sum(1 << b for b in some))
                at = np.minimum(np.searchsorted(ranked, other), n - 1)
                mate = np.where(ranked[at] == other, order[at], np.arange(n))
                steps.append(lambda x, mate=mate: x[mate])
    while True:
        new = label
        for step in steps:
            new = np.minimum(new, step(new))
        new = np.minimum(new, new[new])
        if np.array_equal(new, label):
            return fps[label]
        label = new


def links(distinct: DataFrame, bits: int = 2) -> DataFrame:
    """Edges (a, b) that connect all fingerprints ``fp`` at up to ``bits`` differing bits; rows must be distinct.

    Such a pair shares at least 8 - bits of its 8 positional bytes. The posting lists are keyed by 8 - bits positions
    at once, so a pair meets in a list exactly if its tally of shared bytes reaches the guaranteed minimum. Lists of single
    bytes would hold 1/256 of all fingerprints each, and the pairs to tally would grow with their square. A list has at
    most 256 ** bits fingerprints. It is verified bit by bit and gives one edge per member, not all pairs.
    """
    masks = _masks(bits)
    posting = F.explode(F.array(*(F.struct(F.lit(c).alias("c"), F.col("fp").bitwiseAND(F.lit(m)).alias("kept")) for c, m in enumerate(masks))))
    spread = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # the table may be one small file, its lists are not
    lists = distinct.repartition(spread, "fp").select("fp", posting.alias("p")).groupBy("p.c", "p.kept").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for v in batch.column(0):
                fps = np.unique(v.values.to_numpy())
                root = link_group(fps, bits)
                a.append(fps[fps != root])
                b.append(root[fps != root])
            yield emit(schema, [np.concatenate(a or [[]]).astype(np.int64), np.concatenate(b or [[]]).astype(np.int64)])

    return lists.select("fps").mapInArrow(run, "a long, b long").distinct()


def components(rows: DataFrame, key: str, shingle: int = 3, bits: int = 2, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two stored tables: (key, fp) of every row, and (fp, root) of every distinct fingerprint, root naming its component.

    Fingerprints link at up to ``bits`` differing bits; copies meet as one fingerprint, whatever their number.
    """
    prints = stored(fingerprints(rows, key, shingle, text), "fingerprints")
    distinct = stored(prints.select("fp").distinct(), "distinct")
    star = stored(connected(stored(links(distinct, bits), "links")), "components")
    roots = distinct.join(star, distinct.fp == star.node, "left").select("fp", F.coalesce("root", "fp").alias("root"))
    return prints, stored(roots, "roots")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3, bits: int = 2) -> DataFrame:
    """(id, fingerprint, component_id) per row of ``docs``.

    Fingerprints link at up to ``bits`` (1 or 2) differing bits; component_id is the least id reachable. Null text is an
    empty one: fingerprint zero, linked like any other. A null id takes part but is nobody's component_id, unless a
    component has no other. Repeated rows come out as often as they came in; other columns of ``docs`` are not used.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    prints, roots = components(rows, "id", shingle, bits)
    least = prints.groupBy("fp").agg(F.min("key").alias("least")).join(roots, "fp").groupBy("root").agg(F.min("least").alias("component_id"))
    known = roots.join(least, "root").select("fp", "component_id")
    return prints.join(known, "fp").select(F.col("key").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3, bits: int = 2) -> DataFrame:
    """``docs`` without near copies: of each component of fingerprints the row with the least id stays, the first of equal ids.

    All columns stay as they are. Null texts count as empty, and empty ones are a group like any other; a row without id
    stays only where its component has no other.
    """
    keyed = stored(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    prints, roots = components(keyed, "__row", shingle, bits, text)
    named = prints.join(keyed.select(F.col("__row").alias("key"), F.col(id_col).alias("id")), "key")
    least = named.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("key"))).alias("first"))
    first = least.join(roots, "fp").groupBy("root").agg(F.min("first").alias("first"))
    return keyed.join(first.select(F.col("first.key").alias("__row")), "__row", "left_semi").drop("__row")
